"""Application logs: topic sources, server stamping, routing and typed parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonio import parse_json
from ..functions.scalars import add_log_time
from ..schemas import EVENT_WIRE, LOG_WIRE, STARTUP_WIRE
from ..session import hadoop_path

# Topic names and the log type that goes to the startup topic.
STARTUP_TOPIC = "startup"
EVENT_TOPIC = "event"
ORDER_TOPIC = "order"
STARTUP_TYPE = "startup"


def kafka_options(bootstrap: str, topic: str, group_id: str | None = None,
                  starting: str = "latest", max_offsets: int | None = None) -> dict:
    """Options of a Kafka subscription: one topic, start at ``latest``; offsets are kept
    in the query checkpoint (no auto-commit)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    return opts


def topic_stream(spark: SparkSession, topic_or_path: str, kafka: dict | None = None,
                 max_files: int | None = None) -> DataFrame:
    """Streaming ``value`` (and ``timestamp`` for Kafka) of one topic.

    With ``kafka`` options (see :func:`kafka_options`) reads the broker; otherwise the
    topic is a folder of JSON-lines files, read as they appear.
    """
    if kafka:
        opts = dict(kafka)
        opts.setdefault("subscribe", topic_or_path)
        return (spark.readStream.format("kafka").options(**opts).load()
                .select(F.col("value").cast("string").alias("value"), "timestamp"))
    fs, folder = hadoop_path(spark, topic_or_path)
    if not fs.exists(folder):  # the producer has not written yet
        fs.mkdirs(folder)
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(topic_or_path)


def log_stream(spark: SparkSession, path_or_topic: str, kafka: dict | None = None,
               max_files: int | None = None) -> DataFrame:
    """JSON log lines, one object per record (same source as :func:`topic_stream`)."""
    return topic_stream(spark, path_or_topic, kafka, max_files)


def parse_logs(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Any log line into the union schema of startup and event logs (+ ``_corrupt``)."""
    return parse_json(df, LOG_WIRE, value, keep=keep)


def stamp_ts(df: DataFrame, now: Column | int | str | None = None) -> DataFrame:
    """Server time stamp: ``ts`` := arrival time in epoch ms, overwriting any client value.

    ``now``: None for the current time, an int, a column (e.g. the Kafka record
    ``timestamp`` cast to ms), ``"record"`` for the source record's ``timestamp`` column
    (Kafka's append time), or ``"client"`` to keep the logged ``ts`` (replaying archives
    that were stamped already).
    """
    if now == "client":
        return df
    if now == "record":
        return df.withColumn("ts", F.unix_millis(F.col("timestamp")))
    if now is None:
        now_col = F.unix_millis(F.current_timestamp())
    elif isinstance(now, int):
        now_col = F.lit(now).cast("long")
    else:
        now_col = now
    return df.withColumn("ts", now_col.cast("long"))


def route(df: DataFrame, type_col: str = "type") -> DataFrame:
    """Topic per log: ``startup`` for type startup, everything else (NULL too) ``event``."""
    is_startup = F.col(type_col).eqNullSafe(F.lit(STARTUP_TYPE))
    return df.withColumn("topic", F.when(is_startup, F.lit(STARTUP_TOPIC)).otherwise(F.lit(EVENT_TOPIC)))


def parse_startup(df: DataFrame, value: str = "value", tz: str | None = None,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Startup log JSON -> typed record with ``log_date``, ``log_hour``, ``log_hour_minute``.

    The wire field ``type`` becomes ``log_type``. Malformed lines keep ``_corrupt``.
    """
    p = parse_json(df, STARTUP_WIRE, value, keep=keep)
    p = p.select(*keep, "mid", "uid", "appid", "area", "os", "ch", F.col("type").alias("log_type"),
                 "vs", "ts", "log_id", "_corrupt")
    return add_log_time(p, "ts", tz)


def parse_event(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Event log JSON -> typed record (``evid``, ``pgid``, ``npgid``, ``itemid`` ...)."""
    return parse_json(df, EVENT_WIRE, value, keep=keep)
