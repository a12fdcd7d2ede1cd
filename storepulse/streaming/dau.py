"""Daily active devices: the first startup log of each device per day, kept forever.

Default form (``mode="state"``): the devices seen per day are keys of Spark's state store
(RocksDB on a cluster, see ``session.CLUSTER_CONF``), so a batch looks up its own keys only and
costs the same on a day's first and last batch; neither the table nor its folders are opened.
The keys that the batch adds come out of the state beside all its lines, and the earliest log
of each new key is written to partitions (log_date, writer, batch_id) with dynamic overwrite.
Rows that lie in the table when a query first starts are inherited: their keys are copied once
into a folder per day beside the checkpoint, and only batches with rows of such a day open it.

``keep_days`` bounds the state: days older than that are closed. Lines of closed days, or of
days that lie ahead of the clock, are never dropped: they go to ``<table>_late``. Without it the
state keeps every day, as the reference's set does.

``mode="table"``: the table itself is the seen-set; a batch reads its day folders. For backfills
that rewrite whole days, and as the batch function :func:`dau_batch`.

Lines that are malformed, or have no device or no time, go to a quarantine table with their
raw text. Every line is a new row, a repeat of a seen device, late, or refused; the counts of each
batch are the stream's ``dau_in`` metrics (see ``metrics.BatchCounts``).

Row choice: within a batch the earliest ``ts`` (ties by ``log_id``); across batches the
first arrival. Counts per day never depend on batching; hour attribution can, when
logs arrive out of order.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import drop_seen, first_per_key
from ..schemas import STARTUP, T
from ..session import existing, hadoop_path
from ..sinks.snapshot import read_snapshot
from ..sinks.tables import append_table, ensure_table, writer_id
from ..sources.logs import parse_startup
from .metrics import with_metrics
from .runner import DEFAULT_TRIGGER, start, state_settings

_log = logging.getLogger(__name__)
KEYS = ("log_date", "mid")
FIRST = ("ts", "log_id")
DAU_TABLE = T.StructType([*STARTUP.fields, T.StructField("writer", T.StringType(), True),
                          T.StructField("batch_id", T.LongType(), True)])
# What a line of a batch is; KEY marks the keys that the state store has not seen before.
KEY, ROW, LATE, REFUSED = "key", "row", "late", "refused"


def read_dau(spark: SparkSession, path: str, days=None) -> DataFrame:
    """The daily-device table; with ``days`` only those days' folders, others are not listed."""
    return read_snapshot(spark, path, DAU_TABLE, "log_date", days)


def _earliest(logs: DataFrame) -> DataFrame:
    firsts = first_per_key(logs, KEYS, [F.col(c).asc_nulls_last() for c in FIRST])
    return firsts.select(*[f.name for f in STARTUP.fields])


def dau_batch(path: str, on_metrics=None):
    """The ``foreachBatch`` function of ``mode="table"``, writing new daily-first devices to ``path``.

    Seen check without shuffling the seen set: the batch's keys are the small side of a
    left-semi join over the day folders, which yields the few already-seen keys, and the
    anti join runs against those. No hints: by their sizes the planner and AQE broadcast
    the keys of a live batch and shuffle those of a large backfill.

    The count of new daily devices written (read from the Parquet footers of the batch's
    own partitions) is logged and passed to ``on_metrics(batch_id, dict)`` when given;
    the count of logs in is the stream's ``dau_in`` metric.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark, writer = batch.sparkSession, writer_id(batch)
        logs = batch.where(F.col("mid").isNotNull() & F.col("log_date").isNotNull())
        # Days in one batch: a handful for a live stream, bounded by the span of the input.
        days = [r[0] for r in logs.select("log_date").distinct().collect()]
        if not days:
            return
        firsts = _earliest(logs)
        own = (F.col("writer") == writer) & (F.col("batch_id") == batch_id)
        hit = read_dau(spark, path, days).where(~own).select(*KEYS).join(firsts.select(*KEYS), list(KEYS), "left_semi")
        append_table(drop_seen(firsts, hit, KEYS), path, ["log_date"], batch_id, writer=writer)
        if on_metrics or _log.isEnabledFor(logging.INFO):
            metrics = {"days": sorted(days), "rows_in": firsts.count(), "rows_new": read_dau(spark, path, days).where(own).count()}
            _log.info("dau batch %s: %s", batch_id, metrics)
            if on_metrics:
                on_metrics(batch_id, metrics)
    return run


def line_kind(keep_days: int | None = None, tz: str | None = None) -> Column:
    """``refused``, ``late`` (a closed day, or one ahead of tomorrow) or ``row`` of a parsed startup line."""
    ok = F.col("_corrupt").isNull() & F.col("mid").isNotNull() & F.col("log_date").isNotNull()
    kind = F.when(~F.coalesce(ok, F.lit(False)), REFUSED)
    if keep_days is not None:
        # the batch's own time, which the stream keeps in its offset log
        now = F.current_timestamp() if tz is None else F.convert_timezone(None, F.lit(tz), F.current_timestamp().cast("timestamp_ntz"))
        today, day = F.to_date(now), F.try_to_date("log_date", "yyyy-MM-dd")
        kind = kind.when(day.isNull() | (day < F.date_sub(today, keep_days)) | (day > F.date_add(today, 1)), LATE)
    return kind.otherwise(ROW)


def _with_new_keys(parsed: DataFrame, keep_days: int | None) -> DataFrame:
    """All lines, and a ``key`` row for each (log_date, mid) that the state store meets for the first time."""
    keys = parsed.where(F.col("kind") == ROW).select(*KEYS)
    if keep_days is None:
        keys = keys.dropDuplicates(list(KEYS))
    else:
        # Rows reach from keep_days ago to tomorrow, so the watermark lies before all of them and drops none.
        day = F.try_to_timestamp("log_date", F.lit("yyyy-MM-dd"))
        keys = keys.withColumn("day", day).withWatermark("day", f"{keep_days + 2} days").dropDuplicates([*KEYS, "day"]).drop("day")
    return parsed.unionByName(keys.withColumn("kind", F.lit(KEY)), allowMissingColumns=True)


def _inherit(spark: SparkSession, path: str, checkpoint: str) -> tuple[str, set[str]]:
    """(folder, days) of the keys that lay in the table when the query first started."""
    folder = f"{checkpoint.rstrip('/')}_seen"
    if not existing(spark, [f"{folder}/_SUCCESS"]):
        rows = read_dau(spark, path).select(*KEYS).distinct()
        rows.hint("rebalance", "log_date").write.mode("overwrite").partitionBy("log_date").parquet(folder)
    fs, root = hadoop_path(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return folder, {n.split("=", 1)[1] for n in names if n.startswith("log_date=")}


def _state_batch(path: str, refused: str, late: str, inherited: tuple[str, set[str]]):
    folder, days = inherited

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # the parsed lines and new keys, in as many partitions as input and state have
        try:
            there = {r[0] for r in batch.select("kind").distinct().collect()}
            lines = lambda kind: batch.where(F.col("kind") == kind)
            if REFUSED in there:
                append_table(lines(REFUSED).select("value"), refused, [], batch_id)
            if LATE in there:
                append_table(lines(LATE).select(*[f.name for f in STARTUP.fields], "value"), late, [], batch_id)
            if KEY in there:
                keys = lines(KEY).select(*KEYS)
                if days:
                    old = sorted(days.intersection(r[0] for r in keys.select("log_date").distinct().collect()))
                    if old:
                        schema = T.StructType([T.StructField(k, T.StringType()) for k in KEYS])
                        seen = batch.sparkSession.read.schema(schema).option("basePath", folder).parquet(*[f"{folder}/log_date={d}" for d in old])
                        keys = keys.join(seen.join(keys, list(KEYS), "left_semi"), list(KEYS), "left_anti")
                new = lines(ROW).join(keys, list(KEYS), "left_semi")
                append_table(_earliest(new), path, ["log_date"], batch_id)
        finally:
            batch.unpersist()
    return run


def dau_stream(logs: DataFrame, path: str, checkpoint: str, trigger: str | None = DEFAULT_TRIGGER,
               tz: str | None = None, mode: str = "state", keep_days: int | None = None,
               quarantine: str | None = None, partitions: int | None = None):
    """Start the daily dedup over a stream of startup-log JSON lines (``value``).

    Refused lines go to ``quarantine`` (default: ``<path>_quarantine``). One query writes a table at a time.
    The state has ``partitions`` parts (default: one per core of the cluster), fixed by the first start.
    """
    spark = logs.sparkSession
    refused = quarantine or f"{path.rstrip('/')}_quarantine"
    parsed = parse_startup(logs, tz=tz, keep=("value",))
    ensure_table(spark, path, DAU_TABLE, ["log_date", "writer", "batch_id"])
    if mode == "state":
        parsed = parsed.withColumn("kind", line_kind(keep_days, tz)).drop("_corrupt")
        count = lambda kind: F.count_if(F.col("kind") == kind)
        out = with_metrics(_with_new_keys(parsed, keep_days), "dau_in", rows=F.count_if(F.col("kind") != KEY),
                           refused=count(REFUSED), late=count(LATE), accepted=count(ROW), keys=count(KEY))
        run = _state_batch(path, refused, f"{path.rstrip('/')}_late", _inherit(spark, path, checkpoint))
        with state_settings(spark, partitions):
            return start(out.writeStream.foreachBatch(run), checkpoint, trigger)
    if mode == "table":
        parsed = with_metrics(parsed.withColumn("kind", line_kind()), "dau_in", rows=F.count(F.lit(1)),
                              refused=F.count_if(F.col("kind") == REFUSED), accepted=F.count_if(F.col("kind") == ROW))
        write_new = dau_batch(path)

        def run(batch, batch_id):
            batch.persist()  # the parsed lines, not a shuffled result: as many partitions as the input has
            try:
                bad = batch.where(F.col("kind") == REFUSED).select("value")
                if not bad.isEmpty():
                    append_table(bad, refused, [], batch_id)
                write_new(batch.where(F.col("kind") == ROW).drop("_corrupt", "value", "kind"), batch_id)
            finally:
                batch.unpersist()
        return start(parsed.writeStream.foreachBatch(run), checkpoint, trigger)
    raise ValueError(f"unknown mode {mode!r}")
