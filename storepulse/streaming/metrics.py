"""Per-batch row counts without extra jobs, and a table that keeps them."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..session import existing, hadoop_path
from ..sinks.tables import append_table

# One row per batch, metric and counter; a batch that is run again replaces its rows.
COUNTS_TABLE = T.StructType([T.StructField("run_id", T.StringType(), True), T.StructField("metric", T.StringType(), True),
                             T.StructField("counter", T.StringType(), True), T.StructField("n", T.LongType(), True),
                             T.StructField("batch_ms", T.LongType(), True), T.StructField("writer", T.StringType(), True),
                             T.StructField("batch_id", T.LongType(), True)])


def with_metrics(df: DataFrame, name: str, **counters: Column) -> DataFrame:
    """Count the rows passing this point; the counts appear in the streaming progress
    (``observedMetrics[name]["rows"]``, or one entry per given counter) or in an
    ``Observation`` for batch jobs."""
    counters = counters or {"rows": F.count(F.lit(1))}
    return df.observe(name, *[c.alias(k) for k, c in counters.items()])


class BatchCounts(StreamingQueryListener):
    """Appends the observed counts of every batch to the table at ``path``.

    Register with ``spark.streams.addListener``; :meth:`wait` returns once all batches of a query that has
    ended are in the table. Listener events are sent at least once and after the batch: the rows of a
    (query, batch) are one partition, which a repeat replaces.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [(str(p.runId), metric, counter, int(n), int(p.batchDuration))
                for metric, row in p.observedMetrics.items() for counter, n in row.asDict().items() if n is not None]
        if rows:
            schema = T.StructType(COUNTS_TABLE.fields[:-2])
            append_table(self.spark.createDataFrame(rows, schema).coalesce(1), self.path, [], p.batchId, writer=str(p.id))

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def wait(self, query, timeout_s: float = 60) -> None:
        """Until the end of ``query`` has been heard, which follows all its batches."""
        with self._news:
            if not self._news.wait_for(lambda: str(query.runId) in self._ended, timeout_s):
                raise TimeoutError(f"no end of query {query.id} after {timeout_s} s")


def batch_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts table: writer (query id), batch_id, metric, counter, n; empty where nothing was counted yet."""
    if not existing(spark, [path]):
        fs, folder = hadoop_path(spark, path)
        fs.mkdirs(folder)
    return spark.read.schema(COUNTS_TABLE).parquet(path)
