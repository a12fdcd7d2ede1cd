"""Change stream -> order messages: row-data envelopes, inserts of ``order_info`` only,
one camelCase JSON message per inserted row, published to the order topic.

One ``foreachBatch`` splits a batch into messages, refused envelopes and ignored ones. Messages are
published once per (query, batch), refused envelopes are kept as text, and a ledger counts
all three, so for every batch envelopes in = messages + refused + ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.tables import append_table, publish
from ..sources.cdc import MESSAGES, REFUSED, cdc_stream, cdc_to_messages, outcome, parse_envelope
from ..sources.logs import ORDER_TOPIC
from .runner import DEFAULT_TRIGGER, start

QUARANTINE = "cdc_quarantine"
LEDGER = "cdc_ledger"
LEDGER_TABLE = T.StructType([T.StructField("outcome", T.StringType(), True), T.StructField("envelopes", T.LongType(), True),
                             T.StructField("rows", T.LongType(), True), T.StructField("writer", T.StringType(), True),
                             T.StructField("batch_id", T.LongType(), True)])


def cdc_batch(out: str, kafka_out: dict | None = None):
    """The ``foreachBatch`` function: messages to ``<out>/order`` (or the Kafka topic), refused envelopes to
    ``<out>/cdc_quarantine``, counts to ``<out>/cdc_ledger``; all three are safe to run again."""
    root = out.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        env = parse_envelope(batch, keep=("value",)).withColumn("outcome", outcome()).persist()
        try:
            rows = F.sum(F.when(F.col("outcome") == MESSAGES, F.size("rows")).otherwise(0)).cast("long")
            counts = env.groupBy("outcome").agg(F.count(F.lit(1)).alias("envelopes"), rows.alias("rows"))
            there = {r["outcome"] for r in counts.collect()}  # three rows at most
            if MESSAGES in there:
                publish(cdc_to_messages(env.where(F.col("outcome") == MESSAGES)), ORDER_TOPIC, root, kafka_out, batch_id)
            if REFUSED in there:
                append_table(env.where(F.col("outcome") == REFUSED).select("value"), f"{root}/{QUARANTINE}", [], batch_id)
            if there:
                append_table(counts.coalesce(1), f"{root}/{LEDGER}", [], batch_id)
        finally:
            env.unpersist()
    return run


def read_ledger(spark: SparkSession, out: str) -> DataFrame:
    """The ledger of :func:`cdc_batch`: outcome, envelopes, rows per writer and batch."""
    return spark.read.schema(LEDGER_TABLE).parquet(f"{out.rstrip('/')}/{LEDGER}")


def cdc_stream_to_orders(spark: SparkSession, source: str, out: str, checkpoint: str,
                         trigger: str | None = DEFAULT_TRIGGER, kafka_in: dict | None = None,
                         kafka_out: dict | None = None, max_files: int | None = None):
    """Start the change-record job. ``out`` is the topics folder (``<out>/order``); with ``kafka_out`` options
    the messages go to Kafka and only ledger and refused envelopes to ``out``."""
    envelopes = cdc_stream(spark, source, kafka_in, max_files)
    return start(envelopes.select("value").writeStream.foreachBatch(cdc_batch(out, kafka_out)), checkpoint, trigger)
