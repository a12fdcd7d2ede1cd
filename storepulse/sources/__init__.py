"""Readers: message topics (Kafka or JSON-lines folders), change records, warehouse days."""

from .logs import (EVENT_TOPIC, STARTUP_TOPIC, kafka_options, log_stream, parse_event,
                   parse_logs, parse_startup, route, stamp_ts, topic_stream)
from .cdc import ORDER_TABLE, cdc_stream, cdc_to_messages, cdc_to_rows, inserts_only, parse_envelope
from .warehouse import DEFAULT_DT, conform, sale_scan
from .orders import enrich_order, parse_order

__all__ = [
    "EVENT_TOPIC", "STARTUP_TOPIC", "kafka_options", "log_stream", "parse_event", "parse_logs",
    "parse_startup", "route", "stamp_ts", "topic_stream", "ORDER_TABLE", "cdc_stream",
    "cdc_to_messages", "cdc_to_rows", "inserts_only", "parse_envelope", "DEFAULT_DT", "conform",
    "sale_scan", "enrich_order", "parse_order",
]
