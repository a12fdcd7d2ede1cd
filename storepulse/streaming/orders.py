"""Order stream: parse -> split create time -> mask phone -> append (stateless).

Exactly-once on replay: each micro-batch replaces its own (create_month, writer, batch_id)
partitions. Month partitions keep the file count sane when one batch spans years
(a backfill); rows are sorted by ``create_date`` inside the files, so a one-day query
reads one month folder and skips row groups by their min/max statistics. Messages whose create time cannot be split go to a quarantine table
instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ORDER_FIELDS, T
from ..sinks.snapshot import read_snapshot
from ..sinks.tables import append_table
from ..sources.orders import enrich_order, parse_order, snake
from .metrics import with_metrics
from .runner import DEFAULT_TRIGGER, start

ORDER_COLUMNS = [snake(n) for n in ORDER_FIELDS] + ["create_hour", "create_hour_minute"]
ORDERS_TABLE = T.StructType(
    [T.StructField(c, T.DoubleType() if c == "total_amount" else T.StringType(), True)
     for c in ORDER_COLUMNS]
    + [T.StructField("create_date", T.StringType(), True), T.StructField("create_month", T.StringType(), True),
       T.StructField("writer", T.StringType(), True), T.StructField("batch_id", T.LongType(), True)])


def read_orders(spark, path: str, days=None) -> DataFrame:
    """The orders table; with ``days`` only those days, reading only their month
    partitions and row groups (pushed ``create_date`` filter)."""
    if not days:
        return read_snapshot(spark, path, ORDERS_TABLE, "create_month")
    t = read_snapshot(spark, path, ORDERS_TABLE, "create_month", {d[:7] for d in days})
    return t.where(F.col("create_date").isin(sorted(days)))


def order_batch(path: str, quarantine: str | None = None):
    """The ``foreachBatch`` function for order messages (``value``); refused ones go to
    ``quarantine`` (default: ``<path>_quarantine``)."""
    refused = quarantine or f"{path.rstrip('/')}_quarantine"

    def run(batch: DataFrame, batch_id: int) -> None:
        rec = enrich_order(parse_order(batch, keep=("value",)), flag="_bad").persist()
        try:
            bad = F.col("_bad") | F.col("_corrupt").isNotNull()
            good = (rec.where(~bad).select(*ORDER_COLUMNS, "create_date")
                    .withColumn("create_month", F.substr("create_date", F.lit(1), F.lit(7))))
            append_table(good, path, ["create_month"], batch_id, sort_by=["create_date"])
            bad_rows = rec.where(bad).select("value")
            if not bad_rows.isEmpty():  # cheap on the cached batch
                append_table(bad_rows, refused, [], batch_id)
        finally:
            rec.unpersist()
    return run


def order_stream(msgs: DataFrame, path: str, checkpoint: str, trigger: str | None = DEFAULT_TRIGGER,
                 quarantine: str | None = None):
    """Start the order stream over JSON messages (``value``)."""
    src = with_metrics(msgs.select("value"), "orders_in")
    return start(src.writeStream.foreachBatch(order_batch(path, quarantine)), checkpoint, trigger)
