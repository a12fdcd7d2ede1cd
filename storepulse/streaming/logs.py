"""Log collection: stamp arrival time, archive raw lines per day, route to topics.

One ``foreachBatch`` writes both outputs from one cached batch. The archive goes to partitions
that include the query and batch id, replaced on replay; topic folders are published once per
query and batch (see ``sinks.publish``). Lines pass as they came: only the value of ``ts`` is
replaced, at its place in the text, or a ``ts`` is added at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonio import json_object_field, splice_member
from ..functions.scalars import epoch_ms_parts
from ..session import settings
from ..sinks.tables import publish, writer_id
from ..sources.logs import EVENT_TOPIC, STARTUP_TOPIC, route, stamp_ts
from .runner import DEFAULT_TRIGGER, start

ARCHIVE = "archive"
TOPICS = "topics"
QUARANTINE = "quarantine"


def stamped_lines(batch: DataFrame, now: Column | int | str | None = None, tz: str | None = None) -> DataFrame:
    """``value`` (stamped JSON), ``dt`` (day of ``ts``), ``topic``; lines that are not one JSON
    object and nothing else get topic NULL and keep their raw text. ``now="client"`` leaves lines as they are."""
    # exploded, so that each line is parsed once (see parse_json)
    p = batch.select("*", F.inline(F.array(json_object_field("value", "type string, ts string"))))
    p = route(stamp_ts(p.withColumn("ts", F.col("ts").try_cast("long")), now))
    line = F.col("value") if now == "client" else splice_member("value", "ts", F.col("ts").cast("string"))
    return p.select(F.when(F.col("is_object"), line).otherwise(F.col("value")).alias("value"),
                    epoch_ms_parts("ts", tz)[0].alias("dt"),
                    F.when(F.col("is_object"), F.col("topic")).alias("topic"))


# Folders that a task writes to at a time, without sorting its lines by folder first.
OPEN_FILES = "256"


def _write_text(df: DataFrame, path: str, parts: list, batch_id: int) -> None:
    with settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES}):
        (df.hint("rebalance", *parts).withColumn("writer", F.lit(writer_id(df))).withColumn("batch_id", F.lit(batch_id).cast("long"))
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts, "writer", "batch_id").text(path))


def collect_batch(out: str, now: Column | int | str | None = None, tz: str | None = None,
                  kafka: dict | None = None):
    """The ``foreachBatch`` function writing ``<out>/archive/dt=..`` and the routed lines,
    to ``<out>/topics/topic=..`` or, with ``kafka`` producer options, to the topics."""
    root = out.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        lines = stamped_lines(batch, now, tz).persist()
        try:
            _write_text(lines.select("value", "dt"), f"{root}/{ARCHIVE}", ["dt"], batch_id)
            there = {r[0] for r in lines.select("topic").distinct().collect()}  # three values at most
            for topic in sorted(there.intersection((STARTUP_TOPIC, EVENT_TOPIC))):
                routed = lines.where(F.col("topic") == topic)
                if kafka:
                    publish(routed, topic, kafka=kafka, batch_id=batch_id)
                else:
                    publish(routed, f"topic={topic}", f"{root}/{TOPICS}", batch_id=batch_id)
            if None in there:
                _write_text(lines.where(F.col("topic").isNull()).select("value"), f"{root}/{QUARANTINE}", [], batch_id)
        finally:
            lines.unpersist()
    return run


def collect_logs(src: DataFrame, out: str, checkpoint: str, trigger: str | None = DEFAULT_TRIGGER,
                 now: Column | int | str | None = None, tz: str | None = None, kafka: dict | None = None):
    """Start log collection over a stream of raw JSON lines (``value``).

    Without ``now`` the stamp is the source record's ``timestamp`` if it has one, else the time of
    the micro-batch, which the stream keeps in its offset log: a replayed batch gets the same stamp.
    """
    if "timestamp" not in src.columns:
        src = src.withColumn("timestamp", F.current_timestamp())
    now = "record" if now is None else now
    return start(src.select("value", "timestamp").writeStream.foreachBatch(collect_batch(out, now, tz, kafka)),
                 checkpoint, trigger)
