"""Operators on small literal frames."""

from pyspark.sql import functions as F

from storepulse.operators import (age_band_share, area_sales_binned, checked_broadcast, dau_hour,
                                  dau_total, drop_seen, first_per_key, gender_share, hour_compare,
                                  new_devices, order_total, page, rank_bm25, realtime_hour,
                                  realtime_total, sale_detail, sale_hits, sale_stats, terms)
from storepulse.schemas import SALE


def _dau(spark):
    rows = [("2019-03-04", "m1", "09", 1), ("2019-03-04", "m2", "09", 2), ("2019-03-04", "m3", "10", 3),
            ("2019-03-03", "m1", "23", 0), ("2019-03-05", "m4", "01", 4)]
    return spark.createDataFrame(rows, "log_date string, mid string, log_hour string, ts long")


def test_first_per_key_earliest_with_tie_break(spark):
    rows = [("d", "m", 5, 2, "b"), ("d", "m", 5, 1, "a"), ("d", "m", 7, 0, "c"), ("e", "m", 9, 9, "z")]
    df = spark.createDataFrame(rows, "log_date string, mid string, ts long, log_id long, tag string")
    got = sorted((r.log_date, r.tag) for r in first_per_key(df, ["log_date", "mid"], ["ts", "log_id"]).collect())
    assert got == [("d", "a"), ("e", "z")]


def test_first_per_key_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = first_per_key(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_drop_seen_null_keys_and_broadcast(spark):
    batch = spark.createDataFrame([("d", "m1"), ("d", "m2"), ("d", None), ("e", "m1")], "log_date string, mid string")
    seen = spark.createDataFrame([("d", "m1"), ("d", None)], "log_date string, mid string")
    got = sorted(tuple(r) for r in drop_seen(batch, seen).collect())
    assert got == [("d", "m2"), ("e", "m1")]
    b = drop_seen(batch, seen, broadcast_max_rows=10)
    assert "BroadcastHashJoin" in b._jdf.queryExecution().executedPlan().toString()
    assert checked_broadcast(seen, 1) is seen  # too many rows: no hint


def test_dau_total_hour_and_compare(spark):
    dau = _dau(spark)
    assert dau_total(dau, "2019-03-04").first().total == 3
    assert dau_total(dau, "2000-01-01").first().total == 0
    assert sorted(tuple(r) for r in dau_hour(dau, "2019-03-04").collect()) == [("09", 2), ("10", 1)]
    cmp = {r.hour: (r.yesterday, r.today) for r in hour_compare(spark, dau, "log_date", "log_hour", "2019-03-04").collect()}
    assert len(cmp) == 24 and cmp["09"] == (0, 2) and cmp["23"] == (1, 0) and cmp["00"] == (0, 0)


def test_hours_lose_no_amount(spark):
    import json
    from storepulse.operators import hour_maps_json
    rows = [("2019-03-04", "9", 6.0), ("2019-03-04", "09", 1.0), ("2019-03-04", None, 2.0), ("2019-03-03", "10", 0.0)]
    o = spark.createDataFrame(rows, "create_date string, create_hour string, total_amount double")
    cmp = realtime_hour(spark, "order_amount", "2019-03-04", orders=o)
    got = {r.hour: (r.yesterday, r.today) for r in cmp.collect()}
    assert got["09"] == (0.0, 7.0) and got[None] == (0.0, 2.0) and len(got) == 25
    answer = hour_maps_json(realtime_hour(spark, "order_amount", "2019-03-04", orders=o, fill=False)).first().json
    assert json.loads(answer) == {"yesterday": {"10": 0.0}, "today": {"09": 7.0}}


def test_bm25_filter_keeps_scores(spark):
    df = spark.createDataFrame([(1, "a", "the cat the"), (2, "b", "the dog"), (3, "a", "in")], "id long, k string, text string")
    everything = {r.id: r.score for r in rank_bm25(df, ["id", "k"], "text", "the").collect()}
    some = [(r.id, r.k, r.score) for r in rank_bm25(df, ["id", "k"], "text", "the", where=F.col("k") == "a").collect()]
    assert some == [(1, "a", everything[1])]


def test_realtime_hour_unknown_id(spark):
    import pytest
    with pytest.raises(ValueError):
        realtime_hour(spark, "nope", "2019-03-04")


def test_new_devices(spark):
    logs = _dau(spark)
    got = sorted(tuple(r) for r in new_devices(logs).collect())
    assert got == [("2019-03-03", 1), ("2019-03-04", 2), ("2019-03-05", 1)]
    assert [tuple(r) for r in new_devices(logs, "2019-03-04").collect()] == [("2019-03-04", 2)]


def _orders(spark):
    rows = [("a", "2019-03-04", "09", 10.10), ("a", "2019-03-04", "10", 0.20), ("b", "2019-03-03", "09", 1.0)]
    return spark.createDataFrame(rows, "area string, create_date string, create_hour string, total_amount double")


def test_order_total_and_kpi_cards(spark):
    o = _orders(spark)
    assert order_total(o, "2019-03-04").first().total == 10.3
    assert order_total(o, "1999-01-01").first().total == 0.0
    cards = realtime_total(_dau(spark), _dau(spark), o, "2019-03-04").collect()
    assert [c.id for c in cards] == ["dau", "new_mid", "order_amount"]
    assert [c.value for c in cards] == [3.0, 2.0, 10.3]


def test_area_bins(spark):
    got = {r.area: (r.n, r.bin) for r in area_sales_binned(_orders(spark)).collect()}
    assert got == {"a": (2, 1), "b": (1, 1)}


def _sale(spark):
    base = {f.name: None for f in SALE.fields}
    rows = []
    for uid, g, age, name, amt in [("1", "M", 19, "red widget", 5.0), ("2", "F", 20, "Red bolt", 7.0),
                                   ("3", "X", 29, "blue widget", 1.0), ("4", None, 30, "widget red", 3.0),
                                   ("5", "M", None, "red red", 9.0)]:
        r = dict(base, user_id=uid, sku_id="s" + uid, user_gender=g, user_age=age, sku_name=name,
                 order_amount=amt, dt="2019-02-01")
        rows.append(tuple(r[f.name] for f in SALE.fields))
    return spark.createDataFrame(rows, SALE)


def test_sale_search_shares(spark):
    hits = sale_hits(_sale(spark), "2019-02-01", "RED")
    st = sale_stats(hits).first()
    assert (st.total, st.m, st.f, st.lt20, st.a20_29, st.ge30) == (4, 2, 1, 1, 1, 1)
    g = {r.name: r.value for r in gender_share(hits).collect()}
    assert g == {"M": 50.0, "F": 25.0}
    a = {r.name: r.value for r in age_band_share(hits).collect()}
    assert a == {"lt20": 25.0, "20_29": 25.0, "ge30": 25.0}
    assert sale_stats(sale_hits(_sale(spark), "2019-02-01", "")).first().total == 0
    assert sale_stats(sale_hits(_sale(spark), "2019-02-01", "widget red")).first().total == 2
    empty = {r.name: r.value for r in gender_share(sale_hits(_sale(spark), "2019-02-01", "zzz")).collect()}
    assert empty == {"M": 0.0, "F": 0.0}


def test_terms_and_page(spark):
    s = _sale(spark)
    t = [tuple(r) for r in terms(s, "user_gender", 2).collect()]
    assert t == [("M", 2), ("F", 1)]
    order = [F.col("order_amount").desc(), F.col("user_id")]
    assert [r.user_id for r in page(s, 1, 2, order).collect()] == ["5", "2"]
    assert [r.user_id for r in page(s, 2, 2, order).collect()] == ["1", "4"]
    assert [r.user_id for r in page(s, 3, 2, order).collect()] == ["3"]


def test_sale_detail_answer(spark):
    a = sale_detail(_sale(spark), "2019-02-01", "red", 1, 2).first()
    assert a.total == 4
    assert [g.title for g in a.stat] == ["性别占比", "年龄占比"]
    assert [o.value for o in a.stat[0].options] == [50.0, 25.0]
    assert [d.user_id for d in a.detail] == ["5", "2"]
    none = sale_detail(_sale(spark), "2019-02-01", "", 1, 2).first()
    assert none.total == 0 and none.detail == []


def test_bm25_matches_hand_computation(spark):
    import math
    docs = [(1, "the cat the"), (2, "the dog in the house"), (3, "in a box"), (4, "the in the in")]
    df = spark.createDataFrame(docs, "id long, text string")
    got = [(r.id, r.score) for r in rank_bm25(df, "id", "text", "the in", 1, 10).collect()]
    toks = {i: t.split() for i, t in docs}
    n, avgdl = len(docs), sum(len(v) for v in toks.values()) / len(docs)
    def score(i):
        s = 0.0
        for term in ("the", "in"):
            dfc = sum(1 for v in toks.values() if term in v)
            tf = toks[i].count(term)
            s += math.log(1 + (n - dfc + 0.5) / (dfc + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(toks[i]) / avgdl))
        return round(s, 6)
    want = sorted([(i, score(i)) for i in (2, 4)], key=lambda x: (-x[1], x[0]))
    assert got == want
    assert rank_bm25(df, "id", "text", "", 1, 10).count() == 0


def test_sale_day_without_rows(spark):
    st = sale_stats(sale_hits(_sale(spark), "2030-01-01", "red")).first()
    assert st.total == 0
    a = {r.name: r.value for r in age_band_share(sale_hits(_sale(spark), "2030-01-01", "red")).collect()}
    assert a == {"lt20": 0.0, "20_29": 0.0, "ge30": 0.0}


def test_json_answers(spark):
    import json
    from storepulse.operators import hour_maps_json, kpi_list_json
    cards = realtime_total(_dau(spark), _dau(spark), _orders(spark), "2019-03-04")
    assert json.loads(kpi_list_json(cards).first().json) == [
        {"id": "dau", "name": "新增日活", "value": 3.0}, {"id": "new_mid", "name": "新增设备", "value": 2.0},
        {"id": "order_amount", "name": "新增交易额", "value": 10.3}]
    cmp = hour_compare(spark, _dau(spark), "log_date", "log_hour", "2019-03-04", fill=False)
    assert json.loads(hour_maps_json(cmp).first().json) == {"yesterday": {"23": 1}, "today": {"09": 2, "10": 1}}
