"""Writers: replay-safe partitioned tables, topic publishing, raw log archive."""

from .tables import append_table, archive_logs, drop_republished, ensure_table, load_sale_day, publish, read_table
from .compact import COMPACTED, compact_partition
from .snapshot import read_snapshot

__all__ = ["append_table", "archive_logs", "drop_republished", "ensure_table", "load_sale_day", "publish", "read_table", "COMPACTED",
           "compact_partition", "read_snapshot"]
