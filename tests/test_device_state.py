"""Daily devices and known devices held in keyed state: bounded batches, late lines, inherited rows, kept counts."""

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from storepulse.operators import new_devices
from storepulse.schemas import STARTUP
from storepulse.sources import log_stream
from storepulse.sources.logs import parse_startup
from storepulse.streaming import (DAU_TABLE, BatchCounts, batch_counts, dau_stream, known_devices, known_devices_stream,
                                  new_device_card, new_device_days, run_to_end)

DAY = 86_400_000
T0 = 1551657600000  # 2019-03-04 00:00 UTC


def _line(mid, ts, log_id=0):
    return json.dumps({"type": "startup", "mid": mid, "ts": ts, "log_id": log_id})


def _feed(folder, batches):
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 1000
    for i, lines in enumerate(batches):
        p = os.path.join(folder, f"part-{i}.json")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (base + i, base + i))


def _old_day(spark, path, folders):
    """A day written by another query in ``folders`` batches of three devices."""
    rows = spark.range(folders * 3).select(F.concat(F.lit("m"), F.col("id")).alias("mid"), F.lit("2019-03-04").alias("log_date"),
                                           F.lit("00").alias("log_hour"), (F.lit(T0) + F.col("id")).alias("ts"), F.col("id").alias("log_id"),
                                           F.lit("other").alias("writer"), (F.col("id") % folders).alias("batch_id"))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in STARTUP.fields if f.name not in rows.columns]
    rows.select("*", *missing).repartition(4, "batch_id").write.partitionBy("log_date", "writer", "batch_id").parquet(path)


def _tasks(spark, query):
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(str(query.runId))]
    stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
    return sum(s.numTasks for s in stages if s)


def test_a_batch_costs_the_same_on_a_day_of_2000_folders(spark, tmp_dir):
    figures = {}
    for folders in (1, 2000):
        root = f"{tmp_dir}/{folders}"
        _old_day(spark, f"{root}/dau", folders)
        # per batch 100 devices of the old folders (three of them with one folder) and 100 new ones
        batches = [[_line(f"m{i}", T0 + DAY // 2, i) for i in range(100)] + [_line(f"new{b}_{i}", T0 + DAY // 2, i) for i in range(100)] for b in range(4)]
        _feed(f"{root}/in", batches[:1])
        start = lambda: dau_stream(log_stream(spark, f"{root}/in", max_files=1), f"{root}/dau", f"{root}/ck", trigger="availableNow", tz="UTC")
        run_to_end(start())  # inherits the table's keys, once
        _feed(f"{root}/in", batches)
        q = run_to_end(start())
        ms = [p["durationMs"]["triggerExecution"] for p in q.recentProgress if p["numInputRows"] > 0]
        assert len(ms) == 3 and sorted(ms)[1] < 5000, ms  # the middle one: a busy machine may hold one up
        figures[folders] = _tasks(spark, q)
        rows = spark.read.schema(DAU_TABLE).parquet(f"{root}/dau")
        want = folders * 3 + 400 + (97 if folders == 1 else 0)
        assert rows.count() == rows.select("mid").distinct().count() == want
    # a scan of 2,000 small files is 63 tasks (32 files each, by their opening cost), so 189 for three batches
    assert figures[2000] < figures[1] + 60, figures


def test_every_line_is_new_repeat_late_or_refused(spark, tmp_dir):
    today = dt.datetime.now(dt.timezone.utc).replace(hour=0, minute=0, second=1, microsecond=0)
    at = lambda days: int((today + dt.timedelta(days=days)).timestamp() * 1000)
    batches = [[_line("a", at(0), 1), _line("a", at(0) + 5, 2), _line("b", at(-1)), "{junk", _line(None, at(0))],
               [_line("b", at(-1)), _line("c", at(-2)), _line("old", at(-3)), _line("ahead", at(5)), _line("t", at(1))],
               [_line("c", at(-2)), _line("old", at(-3))]]
    _feed(f"{tmp_dir}/in", batches)
    counts = BatchCounts(spark, f"{tmp_dir}/counts")
    spark.streams.addListener(counts)
    try:
        for _ in range(2):  # and a restart, which finds nothing new
            q = run_to_end(dau_stream(log_stream(spark, f"{tmp_dir}/in", max_files=1), f"{tmp_dir}/dau", f"{tmp_dir}/ck", trigger="availableNow",
                                      tz="UTC", keep_days=2))
            counts.wait(q)
    finally:
        spark.streams.removeListener(counts)
    rows = spark.read.schema(DAU_TABLE).parquet(f"{tmp_dir}/dau").collect()
    assert sorted((r.mid, r.log_id) for r in rows) == [("a", 1), ("b", 0), ("c", 0), ("t", 0)]
    assert sorted(r.mid for r in spark.read.parquet(f"{tmp_dir}/dau_late").collect()) == ["ahead", "old", "old"]
    assert spark.read.parquet(f"{tmp_dir}/dau_quarantine").count() == 2
    kept = batch_counts(spark, f"{tmp_dir}/counts").where("metric = 'dau_in'")
    per = kept.groupBy("batch_id").pivot("counter", ["rows", "refused", "late", "accepted", "keys"]).agg(F.sum("n")).orderBy("batch_id").collect()
    per = [tuple(r)[1:] for r in per if r.rows]
    assert per == [(5, 2, 0, 3, 2), (5, 0, 2, 3, 2), (2, 0, 1, 1, 0)]
    assert all(n == refused + late + accepted for n, refused, late, accepted, _ in per)


def test_empty_counts_table(spark, tmp_dir):
    assert batch_counts(spark, f"{tmp_dir}/none").count() == 0


def test_late_log_moves_a_first_day(spark, tmp_dir):
    batches = [[_line("a", T0 + DAY), _line("b", T0 + DAY), _line("b", T0 + 2 * DAY), "junk", _line(None, T0)],
               [_line("a", T0 + 2 * DAY), _line("c", T0 + 2 * DAY)],
               [_line("a", T0), _line("c", T0 + DAY), _line("b", T0 + 3 * DAY)],
               [_line("a", T0 - DAY), _line("a", T0)]]
    want = [[("2019-03-05", 2)], [("2019-03-05", 2), ("2019-03-06", 1)], [("2019-03-04", 1), ("2019-03-05", 2)], [("2019-03-03", 1), ("2019-03-05", 2)]]
    path, lines = f"{tmp_dir}/known", []
    for i, batch in enumerate(batches):
        _feed(f"{tmp_dir}/in", batches[:i + 1])
        run_to_end(known_devices_stream(log_stream(spark, f"{tmp_dir}/in"), path, f"{tmp_dir}/ck", trigger="availableNow", tz="UTC"))
        lines += batch
        days = sorted(tuple(r) for r in new_device_days(spark, path).collect())
        logs = parse_startup(spark.createDataFrame([(x,) for x in lines], "value string"), tz="UTC").where("mid is not null")
        assert days == want[i] == sorted(tuple(r) for r in new_devices(logs).collect())
    first = {r.mid: r.first_date for r in known_devices(spark, path).collect()}
    assert first == {"a": "2019-03-03", "b": "2019-03-05", "c": "2019-03-05"}
    # the card of a day opens that day's folder
    card = new_device_card(spark, path, "2019-03-05")
    assert card.first().total == 2 and new_device_card(spark, path, "2000-01-01").first().total == 0
    assert all("log_date=2019-03-05" in f for f in card.inputFiles())
