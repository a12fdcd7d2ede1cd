"""Triggers and running a query to the end of the available input."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..session import STATE_CONF, settings

DEFAULT_TRIGGER = "5 seconds"


def trigger_options(trigger: str | None = DEFAULT_TRIGGER) -> dict:
    """``"availableNow"`` (drain what is there, then stop), ``"once"``, or an interval."""
    if trigger in (None, "availableNow"):
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def start(writer: DataStreamWriter, checkpoint: str, trigger: str | None = DEFAULT_TRIGGER,
          name: str | None = None) -> StreamingQuery:
    """Start with a required checkpoint (offsets, commit log and state live there)."""
    w = writer.option("checkpointLocation", checkpoint).trigger(**trigger_options(trigger))
    if name:
        w = w.queryName(name)
    return w.start()


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None):
    """Queries started inside keep their state in ``partitions`` parts (default: one per core of the cluster; fixed
    by a query's first start), and in RocksDB, so that it is bounded by disks and not by the executors' memory; a
    batch uploads its changes, not the files they end up in. A query copies the session's settings when it
    starts, so the session keeps its own."""
    own = {"spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism), **STATE_CONF}
    with settings(spark, own):
        yield


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish; re-raise its failure."""
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish")
    if query.exception() is not None:
        raise query.exception()
    return query
