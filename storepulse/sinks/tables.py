"""Partitioned Parquet tables standing in for the document indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import existing, hadoop_path
from ..sources.warehouse import DEFAULT_DT, sale_scan

# The writer of rows that no streaming query writes.
BATCH_WRITER = "batch"


def writer_id(df: DataFrame) -> str:
    """Id of the streaming query whose micro-batch is running. It is kept in the query's
    checkpoint: a restart keeps it, a new checkpoint or a second query has another one."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or BATCH_WRITER


def append_table(df: DataFrame, path: str, partition_by=(), batch_id: int | None = None,
                 max_records_per_file: int | None = None, sort_by=(), writer: str | None = None) -> None:
    """Append ``df`` to the table at ``path`` (rows sorted by ``sort_by`` inside files).

    With ``batch_id`` the rows go to partitions ``(..., writer, batch_id)`` and only those
    partitions are replaced (dynamic overwrite), so a replayed micro-batch replaces its
    own output instead of duplicating it, and never that of another query.
    """
    parts = list(partition_by)
    # One writer per partition value where possible (few files), while AQE still splits
    # a value that holds a large share of the rows over several tasks.
    w = df.hint("rebalance", *parts) if parts else df
    if sort_by:
        w = w.sortWithinPartitions(*parts, *sort_by)
    mode = "append"
    if batch_id is not None:
        w = w.withColumn("writer", F.lit(writer or writer_id(df))).withColumn("batch_id", F.lit(batch_id).cast("long"))
        parts += ["writer", "batch_id"]
        mode = "overwrite"
    writer = w.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, partition_by=()) -> None:
    """Create the table folder (no rows) so that readers with an explicit schema find it."""
    w = spark.createDataFrame([], schema).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table written by :func:`append_table` (explicit schema keeps date text as text)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def publish(df: DataFrame, topic: str, path: str | None = None, kafka: dict | None = None,
            batch_id: int | None = None, writer: str | None = None) -> None:
    """Send ``value`` (JSON text) to a topic: Kafka when options are given, else a
    JSON-lines folder ``<path>/<topic>``. Key is NULL.

    With ``batch_id`` a batch is published once. In a folder topic its lines are written aside and
    then moved to ``writer=<id>/batch_id=<n>`` in one step; that folder is the commit, so a rerun
    finds it and leaves it, and a file that a consumer has seen never changes. Kafka delivers at least
    once: there each message carries the headers ``writer``, ``batch_id`` and ``seq`` (its place in the
    batch), by which :func:`drop_republished` removes what a rerun sent again.
    """
    who = writer or writer_id(df)
    if kafka:
        out = df.select("value")
        if batch_id is not None:
            head = {"writer": F.lit(who), "batch_id": F.lit(str(batch_id)), "seq": F.monotonically_increasing_id().cast("string")}
            out = out.withColumn("headers", F.array(*[F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value")) for k, v in head.items()]))
        out.write.format("kafka").options(**kafka).option("topic", topic).save()
        return
    root = f"{path.rstrip('/')}/{topic}"
    if batch_id is None:
        df.select("value").write.mode("append").text(root)
        return
    spark, name = df.sparkSession, f"writer={who}/batch_id={batch_id}"
    fs, target = hadoop_path(spark, f"{root}/{name}")
    if fs.exists(target):
        return
    aside = f"{root}/_publishing/{name}"
    df.select("value").write.mode("overwrite").text(aside)
    fs.mkdirs(target.getParent())
    if not fs.rename(hadoop_path(spark, aside)[1], target):
        raise OSError(f"cannot publish {aside} as {target.toString()}")


def drop_republished(messages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Messages of a Kafka topic read with ``includeHeaders`` (``value, headers, timestamp``) without those that a
    rerun of :func:`publish` sent again within ``delay``; messages without such headers all stay."""
    head = F.map_from_entries("headers")
    key = [F.element_at(head, k).cast("string") for k in ("writer", "batch_id", "seq")]
    known = key[0].isNotNull() & key[1].isNotNull() & key[2].isNotNull()
    tagged = messages.withColumn("_key", F.when(known, F.concat_ws("/", *key)))
    once = tagged.where(F.col("_key").isNotNull())
    once = once.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["_key"]) if once.isStreaming else once.dropDuplicates(["_key"])
    return once.unionByName(tagged.where(F.col("_key").isNull())).drop("_key")


def archive_logs(df: DataFrame, path: str) -> None:
    """Raw stamped log lines, bare JSON one per line, in one folder per day ``dt``."""
    df.select("value", "dt").write.mode("append").partitionBy("dt").text(path)


def load_sale_day(spark: SparkSession, source: str, target: str, dt: str = DEFAULT_DT,
                  max_records_per_file: int | None = None) -> int:
    """Load one warehouse day into the ``sale_detail`` table, replacing that day; returns its rows.

    The day is written aside, its rows are counted against the source's, and only then it takes the
    loaded day's place. A source that isn't there raises and changes nothing; a day without
    rows in a source that is there empties the day. A load that was cut off between the two moves
    is set right by the next one.
    """
    root = target.rstrip("/")
    if "/" in source and not (existing(spark, [source]) and _days_of(spark, source)):
        raise FileNotFoundError(f"no day folders dt=.. under {source}; {root}/dt={dt} stays as it is")
    day = sale_scan(spark, source, dt).drop("dt")
    rows = day.count()
    fs, place = hadoop_path(spark, f"{root}/dt={dt}")
    aside, old = (hadoop_path(spark, f"{root}/_{kind}/dt={dt}")[1] for kind in ("loading", "replaced"))
    if fs.exists(old) and not fs.exists(place):
        fs.rename(old, place)  # a load ended between its two moves
    fs.delete(old, True)
    writer = day.hint("rebalance").write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.parquet(aside.toString())
    loaded = spark.read.schema(day.schema).parquet(aside.toString()).count()
    if loaded != rows:
        raise RuntimeError(f"{loaded} of {rows} rows of {source} written; {root}/dt={dt} stays as it is")
    if fs.exists(place):
        fs.mkdirs(old.getParent())
        if not fs.rename(place, old):
            raise OSError(f"cannot set {place.toString()} aside")
    if not fs.rename(aside, place):
        raise OSError(f"cannot move the loaded rows to {place.toString()}")
    fs.delete(old, True)
    return rows


def _days_of(spark: SparkSession, root: str) -> list[str]:
    fs, folder = hadoop_path(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return [n[3:] for n in names if n.startswith("dt=")]
