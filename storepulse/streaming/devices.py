"""Known devices: the first day of every device, kept as moves that a day's card sums up.

A keyed state per device holds its first day. A device met for the first time is a move
``(mid, log_date, +1)``; a late log of an earlier day takes the device back from its old first day
(``-1``) and adds it to the new one. Moves go to partitions (log_date, writer, batch_id), which a
replayed batch replaces, so the number of new devices of a day is the sum over that day's folder
alone, however long the history is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import existing
from ..sinks.tables import append_table, ensure_table
from ..sources.logs import parse_startup
from .dau import ROW, line_kind
from .metrics import with_metrics
from .runner import DEFAULT_TRIGGER, start, state_settings

_MOVES = "mid string, log_date string, n long"
MOVES_TABLE = T.StructType([T.StructField("mid", T.StringType(), True), T.StructField("n", T.LongType(), True),
                            T.StructField("log_date", T.StringType(), True), T.StructField("writer", T.StringType(), True),
                            T.StructField("batch_id", T.LongType(), True)])


def _first_day():
    """The state processor; made here so that it travels to the executors by value."""
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class FirstDay(StatefulProcessor):
        def init(self, handle) -> None:
            self.first = handle.getValueState("first", "log_date string")

        def handleInputRows(self, key, rows, timer_values):
            mid, = key
            day = min(part["log_date"].min() for part in rows)
            old = self.first.get()[0] if self.first.exists() else None
            if old is None or day < old:
                self.first.update((day,))
                moves = [(mid, day, 1)] if old is None else [(mid, old, -1), (mid, day, 1)]
                yield pd.DataFrame(moves, columns=["mid", "log_date", "n"])

        def close(self) -> None:
            pass

    return FirstDay()


def device_moves(logs: DataFrame, tz: str | None = None) -> DataFrame:
    """(mid, log_date, n) moves over a stream of startup-log JSON lines; lines without device or time have none
    (the daily-device stream over the same topic quarantines them)."""
    rows = with_metrics(parse_startup(logs, tz=tz).withColumn("kind", line_kind()), "devices_in", rows=F.count(F.lit(1)),
                        accepted=F.count_if(F.col("kind") == ROW))
    keys = rows.where(F.col("kind") == ROW).select("mid", "log_date")
    return keys.groupBy("mid").transformWithStateInPandas(_first_day(), outputStructType=_MOVES, outputMode="Append", timeMode="None")


def known_devices_stream(logs: DataFrame, path: str, checkpoint: str, trigger: str | None = DEFAULT_TRIGGER, tz: str | None = None,
                         partitions: int | None = None):
    """Start keeping the moves table at ``path``, its state in ``partitions`` parts (default: one per core)."""
    ensure_table(logs.sparkSession, path, MOVES_TABLE, ["log_date", "writer", "batch_id"])

    def run(batch: DataFrame, batch_id: int) -> None:
        append_table(batch, path, ["log_date"], batch_id)
    with state_settings(logs.sparkSession, partitions):
        return start(device_moves(logs, tz).writeStream.foreachBatch(run), checkpoint, trigger)


def known_devices(spark: SparkSession, path: str) -> DataFrame:
    """(mid, first_date) of every device met so far."""
    moves = spark.read.schema(MOVES_TABLE).parquet(path)
    return (moves.groupBy("mid", F.col("log_date").alias("first_date")).agg(F.sum("n").alias("n"))
            .where(F.col("n") > 0).select("mid", "first_date"))


def new_device_days(spark: SparkSession, path: str) -> DataFrame:
    """(log_date, n): new devices of every day that has any."""
    moves = spark.read.schema(MOVES_TABLE).parquet(path)
    return moves.groupBy("log_date").agg(F.sum("n").alias("n")).where(F.col("n") > 0)


def new_device_card(spark: SparkSession, path: str, date: str) -> DataFrame:
    """``total``: new devices of ``date``; reads that day's folder only, 0 when there is none."""
    folder = f"{path.rstrip('/')}/log_date={date}"
    moves = spark.read.schema(MOVES_TABLE).option("basePath", path).parquet(folder) if existing(spark, [folder]) else spark.createDataFrame([], MOVES_TABLE)
    return moves.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
