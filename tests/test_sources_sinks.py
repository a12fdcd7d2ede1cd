"""Sources and sinks: parsing fixtures, stamping, routing, publishing, archive."""

import json

from pyspark.sql import functions as F

from storepulse.functions import to_message
from storepulse.sinks import append_table, archive_logs, publish
from storepulse.sources import parse_event, parse_logs, parse_order, parse_startup, route, stamp_ts
from storepulse.sources.cdc import cdc_to_messages, parse_envelope


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_parse_startup_fixture_row(spark):
    row = ('{"type":"startup","mid":"mid_17","uid":"42","os":"ios","appid":"app","area":"beijing",'
           '"ch":"appstore","vs":"1.2.0","ts":1551657600123}')
    r = parse_startup(_lines(spark, [row, "nope"]), tz="UTC").collect()
    good = [x for x in r if x._corrupt is None][0]
    assert (good.mid, good.log_type, good.ts, good.log_date, good.log_hour, good.log_hour_minute) == \
        ("mid_17", "startup", 1551657600123, "2019-03-04", "00", "00:00")
    assert [x._corrupt for x in r if x._corrupt is not None] == ["nope"]


def test_parse_event_numbers_and_strings(spark):
    row = '{"type":"event","mid":"mid_3","uid":"7","evid":"addCart","pgid":12,"npgid":"13","itemid":4,"ts":5}'
    r = parse_event(_lines(spark, [row])).first()
    assert (r.evid, r.pgid, r.itemid, r.ts) == ("addCart", 12, 4, 5)


def test_parse_order_quoted_and_bare_numbers(spark):
    rows = ['{"id":"1","totalAmount":"12.50","createTime":"2019-03-04 09:05:01"}',
            '{"id":"2","totalAmount":7}', '{"id":"3","totalAmount":"abc"}']
    got = {r.id: r.total_amount for r in parse_order(_lines(spark, rows)).collect()}
    assert got == {"1": 12.5, "2": 7.0, "3": None}


def test_stamp_and_route(spark):
    df = parse_logs(_lines(spark, ['{"type":"startup","ts":1}', '{"type":"event"}', '{"type":null}', '{}']))
    fixed = stamp_ts(df, 99).collect()
    assert all(r.ts == 99 for r in fixed)
    now = stamp_ts(df).agg(F.min("ts")).first()[0]
    assert now > 1_700_000_000_000
    topics = [r.topic for r in route(df).collect()]
    assert topics == ["startup", "event", "event", "event"]


def test_cdc_messages_batch(spark):
    env = json.dumps({"entry_type": "ROWDATA", "table": "order_info", "type": "INSERT",
                      "rows": [[{"name": "id", "value": "1"}, {"name": "consignee_tel", "value": "13812345678"},
                                {"name": "total_amount", "value": "12.50"}]]})
    msgs = cdc_to_messages(parse_envelope(_lines(spark, [env]))).collect()
    assert [json.loads(m.value) for m in msgs] == [{"id": "1", "consigneeTel": "13812345678", "totalAmount": "12.50"}]


def test_publish_and_archive(spark, tmp_dir):
    df = spark.createDataFrame([("a", "2019-03-04"), ("b", "2019-03-05")], "k string, dt string")
    publish(to_message(df.select("k")), "order", tmp_dir)
    assert sorted(json.loads(r.value)["k"] for r in spark.read.text(f"{tmp_dir}/order").collect()) == ["a", "b"]
    archive_logs(df.select(F.col("k").alias("value"), "dt"), f"{tmp_dir}/arch")
    got = spark.read.schema("value string, dt string").text(f"{tmp_dir}/arch").collect()
    assert sorted((r.value, r.dt) for r in got) == [("a", "2019-03-04"), ("b", "2019-03-05")]


def test_append_table_batch_replay(spark, tmp_dir):
    df = spark.createDataFrame([("d1", 1), ("d2", 2)], "d string, v int")
    for _ in range(2):
        append_table(df, f"{tmp_dir}/t", ["d"], batch_id=3)
    append_table(df.limit(1), f"{tmp_dir}/t", ["d"], batch_id=4)
    t = spark.read.schema("v int, d string, batch_id long").parquet(f"{tmp_dir}/t")
    assert sorted((r.d, r.v, r.batch_id) for r in t.collect()) == [("d1", 1, 3), ("d1", 1, 4), ("d2", 2, 3)]


def test_stamp_with_record_time(spark, tmp_dir):
    import datetime as dt
    from storepulse.streaming.logs import collect_batch
    t = dt.datetime(2019, 3, 4, 1, 2, 3, tzinfo=dt.timezone.utc)
    batch = spark.createDataFrame([('{"type":"startup","mid":"m1","ts":1}', t)], "value string, timestamp timestamp")
    collect_batch(tmp_dir, now="record", tz="UTC")(batch, 0)
    line = spark.read.schema("value string, topic string, batch_id long").text(f"{tmp_dir}/topics").first()
    assert json.loads(line.value)["ts"] == int(t.timestamp() * 1000) and line.topic == "startup"
