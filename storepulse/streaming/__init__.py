"""Structured Streaming jobs of the live dashboard."""

from .runner import run_to_end, trigger_options
from .metrics import COUNTS_TABLE, BatchCounts, batch_counts, with_metrics
from .dau import DAU_TABLE, dau_batch, dau_stream, read_dau
from .devices import known_devices, known_devices_stream, new_device_card, new_device_days
from .orders import ORDERS_TABLE, order_batch, order_stream, read_orders
from .cdc import cdc_batch, cdc_stream_to_orders, read_ledger
from .logs import collect_batch, collect_logs

__all__ = [
    "run_to_end", "trigger_options", "with_metrics", "DAU_TABLE", "dau_batch", "dau_stream", "read_dau",
    "ORDERS_TABLE", "order_batch", "order_stream", "read_orders", "cdc_batch", "cdc_stream_to_orders", "read_ledger", "collect_batch",
    "collect_logs", "COUNTS_TABLE", "BatchCounts", "batch_counts", "known_devices", "known_devices_stream", "new_device_card",
    "new_device_days",
]
