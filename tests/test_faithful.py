"""The collector leaves lines as they came, topics are published once, refused changes are kept and counted, day loads are guarded."""

import json
import os
import time

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from storepulse.functions.jsonio import json_object_field, splice_member
from storepulse.schemas import SALE
from storepulse.sinks import append_table, drop_republished, load_sale_day, publish
from storepulse.sources import sale_scan, topic_stream
from storepulse.streaming import cdc_batch, cdc_stream_to_orders, collect_logs, read_ledger, run_to_end

NOW = 1551657600005
BIG = "1" * 50


def _feed(folder, lines, name="a.json"):
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(p, (time.time() - 10,) * 2)


STAMPED = [
    ('{"type":"startup","ts":1}', f'{{"type":"startup","ts":{NOW}}}'),
    ('{"type":"startup"}', f'{{"type":"startup","ts":{NOW}}}'),
    ('{}', f'{{"ts":{NOW}}}'), (' { } ', f' {{ "ts":{NOW}}} '),
    (f'{{"n":{BIG},"x":1.10, "e" : 1E+2 ,"ts" :\t"soon" , "z":null}}', f'{{"n":{BIG},"x":1.10, "e" : 1E+2 ,"ts" :\t{NOW} , "z":null}}'),
    ('{"type":"event","type":"startup","ts":1,"a":2,"ts":2}', f'{{"type":"event","type":"startup","ts":{NOW},"a":2,"ts":{NOW}}}'),
    ('{"a":{"ts":1,"b":[{"ts":2}]},"ts":3}', f'{{"a":{{"ts":1,"b":[{{"ts":2}}]}},"ts":{NOW}}}'),
    ('{"a":{"ts":1}}', f'{{"a":{{"ts":1}},"ts":{NOW}}}'),
    ('{"ts":{"ts":1},"a":[1,{"ts":[2]}]}', f'{{"ts":{{"ts":1}},"a":[1,{{"ts":[2]}}],"ts":{NOW}}}'),
    (r'{"a":"say \"ts\":1, } ] \\","ts":"x\"}","b":"\\"}', '{"a":"say \\"ts\\":1, } ] \\\\","ts":%d,"b":"\\\\"}' % NOW),
    (r'{"\u0074s":1,"\u00e9":"中文 😀"}', r'{"\u0074s":%d,"\u00e9":"中文 😀"}' % NOW),
    ('{"type":"ts","v":"ts"}', f'{{"type":"ts","v":"ts","ts":{NOW}}}'),
]
REFUSED = ['{"type":"startup"} trailing', '{"type":"startup"}{"a":1}', '{"type":"startup"}]', '{"type":"startup"},"end":"x"}', "[1]", "7", '"text"', "null",
           "{'type':'startup'}", '{"a":NaN}', '{"a":01}', '{"a":1,}', '{"a":1', "junk"]


def test_lines_pass_as_they_came(spark, tmp_dir):
    _feed(f"{tmp_dir}/in", [a for a, _ in STAMPED] + REFUSED)
    run_to_end(collect_logs(topic_stream(spark, f"{tmp_dir}/in"), f"{tmp_dir}/out", f"{tmp_dir}/ck", trigger="availableNow", now=NOW, tz="UTC"))
    got = spark.read.schema("value string, topic string").text(f"{tmp_dir}/out/topics").collect()
    assert sorted(r.value for r in got) == sorted(b for _, b in STAMPED)
    startup = [r.value for r in got if r.topic == "startup"]
    assert len(startup) == 3 and any('"type":"event","type":"startup"' in v for v in startup)  # the last of doubled keys decides
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/out/quarantine").select("value").collect()) == sorted(REFUSED)


_json = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=8),
                     lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from(["ts", "a", "b\"", "\\"]), x, max_size=3), max_leaves=8)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(["ts", "a", "type", "\"ts\":", "é"]), _json, max_size=4), min_size=20, max_size=40))
def test_stamp_equals_a_parsed_object(spark, objects):
    lines = [json.dumps(o, ensure_ascii=i % 2 == 0) for i, o in enumerate(objects)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    out = df.select("i", json_object_field("value", "ts string")["is_object"].alias("ok"), splice_member("value", "ts", F.lit(str(NOW))).alias("v")).collect()
    assert all(r.ok for r in out)
    for r in out:
        assert json.loads(r.v) == {**objects[r.i], "ts": NOW}


def test_long_lines(spark):
    line = json.dumps({"a": ["\\\"" * 40_000, {"ts": 1}] * 3, "ts": 5, "z": "q" * 200_000})
    df = spark.createDataFrame([(line,)], "value string")
    got = df.select(splice_member("value", "ts", F.lit("7"))).first()[0]
    assert got == line.replace('"ts": 5', '"ts": 7')


def test_a_batch_is_published_once(spark, tmp_dir):
    df = spark.createDataFrame([("a",), ("b",)], "value string")
    for _ in range(3):
        publish(df, "order", tmp_dir, batch_id=4, writer="w")
    files = {f"{d}/{f}": os.path.getmtime(f"{d}/{f}") for d, _, fs in os.walk(f"{tmp_dir}/order") for f in fs}
    publish(spark.createDataFrame([("other",)], "value string"), "order", tmp_dir, batch_id=4, writer="w")
    publish(df, "order", tmp_dir, batch_id=5, writer="w")
    publish(df, "order", tmp_dir, batch_id=4, writer="v")
    assert sorted(r[0] for r in spark.read.text(f"{tmp_dir}/order").select("value").collect()) == ["a"] * 3 + ["b"] * 3
    after = {f"{d}/{f}": os.path.getmtime(f"{d}/{f}") for d, _, fs in os.walk(f"{tmp_dir}/order") for f in fs}
    assert files.items() <= after.items()  # what a consumer may have read is never written again


def test_publishing_goes_on_after_a_crash(spark, tmp_dir):
    aside = f"{tmp_dir}/order/_publishing/writer=w/batch_id=1"
    spark.createDataFrame([("half",)], "value string").write.text(aside)  # written aside, never moved
    assert spark.read.schema("value string").text(f"{tmp_dir}/order").count() == 0
    publish(spark.createDataFrame([("a",), ("b",)], "value string"), "order", tmp_dir, batch_id=1, writer="w")
    assert sorted(r[0] for r in spark.read.text(f"{tmp_dir}/order").select("value").collect()) == ["a", "b"]


def test_republished_kafka_messages_are_dropped(spark):
    head = lambda seq: [("writer", b"w"), ("batch_id", b"1"), ("seq", seq)]
    rows = [("a", head(b"0")), ("a", head(b"1")), ("a", head(b"0")), ("free", None), ("free", None), ("x", [("other", b"1")])]
    df = spark.createDataFrame(rows, "value string, headers array<struct<key string, value binary>>").withColumn("timestamp", F.current_timestamp())
    assert sorted(r.value for r in drop_republished(df).collect()) == ["a", "a", "free", "free", "x"]


def _env(typ="INSERT", rows=(), table="order_info", entry="ROWDATA"):
    return json.dumps({"entry_type": entry, "table": table, "type": typ, "rows": [[{"name": k, "value": v} for k, v in r] for r in rows]})


def test_changes_are_messages_refused_or_ignored(spark, tmp_dir):
    good = [("id", "1"), ("consignee_tel", "138")]
    files = [[_env(rows=[good, good]), _env("UPDATE", [good]), _env(rows=[good], table="user_info"), _env(rows=[good], entry="TRANSACTIONBEGIN"), "{torn"],
             [_env(rows=[[("id", "2"), ("id", "3")]]), _env(rows=[[(None, "2")]]), _env(rows=[[("a_b", "2"), ("A_B", "2")]]), _env(table=None), _env(None),
              '{"entry_type":"ROWDATA","table":"order_info","type":"INSERT"}', '{"entry_type":"ROWDATA","table":"order_info","type":"INSERT","rows":[null]}', "[]"],
             [_env(rows=[]), _env(rows=[[("id", "4")]])]]
    for i, lines in enumerate(files):
        _feed(f"{tmp_dir}/in", lines, f"{i}.json")
        # a restart after each file
        run_to_end(cdc_stream_to_orders(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck", trigger="availableNow", max_files=1))
    ledger = {(r.batch_id, r.outcome): (r.envelopes, r.rows) for r in read_ledger(spark, f"{tmp_dir}/out").collect()}
    assert ledger == {(0, "messages"): (1, 2), (0, "ignored"): (3, 0), (0, "refused"): (1, 0), (1, "refused"): (8, 0), (2, "messages"): (2, 1)}
    for i, lines in enumerate(files):
        assert sum(n for (b, _), (n, _) in ledger.items() if b == i) == len(lines)
    ids = sorted(json.loads(r.value)["id"] for r in spark.read.text(f"{tmp_dir}/out/order").collect())
    assert ids == ["1", "1", "4"]
    kept = sorted(r.value for r in spark.read.parquet(f"{tmp_dir}/out/cdc_quarantine").collect())
    assert kept == sorted([files[0][-1], *files[1]])


def test_a_change_batch_can_run_again(spark, tmp_dir):
    batch = spark.createDataFrame([(_env(rows=[[("id", "1")]]),), ("{torn",)], "value string")
    for _ in range(2):
        cdc_batch(tmp_dir)(batch, 0)
    assert spark.read.text(f"{tmp_dir}/order").count() == 1 and spark.read.parquet(f"{tmp_dir}/cdc_quarantine").count() == 1
    assert sorted(tuple(r)[:2] for r in read_ledger(spark, tmp_dir).collect()) == [("messages", 1), ("refused", 1)]


def _warehouse(spark, root, days):
    base = {f.name: None for f in SALE.fields}
    rows = [tuple({**base, "user_id": str(i), "sku_id": "s", "dt": d}[f.name] for f in SALE.fields) for d, n in days.items() for i in range(n)]
    spark.createDataFrame(rows, SALE).write.mode("overwrite").partitionBy("dt").parquet(root)


def test_a_missing_source_leaves_the_loaded_day(spark, tmp_dir):
    src, out, dt = f"{tmp_dir}/wh", f"{tmp_dir}/sale", "2019-02-01"
    _warehouse(spark, src, {dt: 7, "2019-02-02": 2})
    assert load_sale_day(spark, src, out, dt) == 7
    os.makedirs(f"{tmp_dir}/no_days")
    for wrong in (f"{tmp_dir}/wh_mistyped", f"{tmp_dir}/no_days"):
        with pytest.raises(FileNotFoundError):
            load_sale_day(spark, wrong, out, dt)
    assert sale_scan(spark, out, dt).count() == 7
    assert load_sale_day(spark, src, out, "2019-02-02") == 2
    _warehouse(spark, src, {"2019-02-02": 2})  # the day has become empty
    assert load_sale_day(spark, src, out, dt) == 0
    assert sale_scan(spark, out, dt).count() == 0 and sale_scan(spark, out, "2019-02-02").count() == 2


def test_a_load_cut_off_between_its_moves(spark, tmp_dir):
    src, out, dt = f"{tmp_dir}/wh", f"{tmp_dir}/sale", "2019-02-01"
    _warehouse(spark, src, {dt: 7})
    load_sale_day(spark, src, out, dt)
    os.makedirs(f"{out}/_replaced", exist_ok=True)
    os.rename(f"{out}/dt={dt}", f"{out}/_replaced/dt={dt}")
    assert load_sale_day(spark, src, out, dt) == 7 and sale_scan(spark, out, dt).count() == 7
    assert not os.path.exists(f"{out}/_replaced/dt={dt}")


def test_rows_per_file(spark, tmp_dir):
    """Writes come in files of at most so many rows, the rest in a last one (the reference's bulks of 100)."""
    src, out = f"{tmp_dir}/wh", f"{tmp_dir}/sale"
    _warehouse(spark, src, {"2019-02-01": 250})
    load_sale_day(spark, src, out, "2019-02-01", max_records_per_file=100)
    append_table(spark.range(250).coalesce(1), f"{tmp_dir}/t", max_records_per_file=100)
    for folder in (f"{out}/dt=2019-02-01", f"{tmp_dir}/t"):
        sizes = [r["count"] for r in spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()]
        assert sum(sizes) == 250 and max(sizes) <= 100 and sorted(sizes)[-2:] == [100, 100]


def test_lines_are_parsed_and_searched_once(spark):
    """However often a step names it, a line's checksum, its parse and its split stand in the plan once."""
    lines = spark.createDataFrame([('{"a":{"ts":1},"ts":2}',)], "value string")
    plan = lines.select(splice_member("value", "ts", F.lit("7")).alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == plan.count("regexp_replace(value") == 1
    plan = lines.select(json_object_field("value", "type string, ts string").alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == plan.count("md5(") == 1


def test_lines_are_not_sorted_by_folder(spark, tmp_dir, monkeypatch):
    """A task that writes to many day folders holds no lines: it keeps the folders' files open."""
    from pyspark.sql import DataFrameWriter
    from storepulse.streaming.logs import collect_batch
    seen, text, name = [], DataFrameWriter.text, "spark.sql.maxConcurrentOutputFileWriters"
    monkeypatch.setattr(DataFrameWriter, "text", lambda w, path, **kw: (seen.append((path, int(w._spark.conf.get(name)))), text(w, path, **kw))[1])
    before = spark.conf.get(name)
    batch = spark.createDataFrame([(f'{{"type":"startup","ts":{i * 86_400_000}}}',) for i in range(40)] + [("torn",)], "value string")
    collect_batch(tmp_dir, "client", "UTC")(batch, 0)
    assert all(n > 0 for path, n in seen if "archive" in path or "quarantine" in path) and len(seen) > 2
    assert spark.conf.get(name) == before
    assert spark.read.text(f"{tmp_dir}/archive").count() == 41 and spark.read.text(f"{tmp_dir}/quarantine").count() == 1
