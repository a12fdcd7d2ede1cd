"""Column functions on literal frames: each semantic edge of the survey's operator table."""

import pytest

from storepulse.functions import (add_create_time, add_log_time, age_band, camel_case, camel_columns,
                                  keyword_terms, mask_tel, match_all, pct1, previous_day,
                                  previous_day_col, term_count, token_count, tokens, value_bin)


def test_log_time_parts_utc_and_zone(spark):
    df = spark.createDataFrame([(1551657600123,), (1551743999999,)], "ts long")
    r = add_log_time(df, tz="UTC").orderBy("ts").collect()
    assert (r[0].log_date, r[0].log_hour, r[0].log_hour_minute) == ("2019-03-04", "00", "00:00")
    assert (r[1].log_date, r[1].log_hour, r[1].log_hour_minute) == ("2019-03-04", "23", "23:59")
    sh = add_log_time(df, tz="Asia/Shanghai").orderBy("ts").collect()
    assert (sh[0].log_date, sh[0].log_hour) == ("2019-03-04", "08")
    assert (sh[1].log_date, sh[1].log_hour) == ("2019-03-05", "07")


def test_create_time_split(spark):
    df = spark.createDataFrame([("2019-03-04 09:05:59",), ("2019-03-04",), (None,), ("2019-03-04 09",)],
                               "create_time string")
    r = {x.create_time: x for x in add_create_time(df, flag="bad").collect()}
    ok = r["2019-03-04 09:05:59"]
    assert (ok.create_date, ok.create_hour, ok.create_hour_minute, ok.bad) == ("2019-03-04", "09", "09:05", False)
    for k in ("2019-03-04", None, "2019-03-04 09"):
        assert (r[k].create_date, r[k].create_hour, r[k].create_hour_minute, r[k].bad) == (None, None, None, True)


def test_mask_tel(spark):
    df = spark.createDataFrame([("13812345678",), ("123",), ("1234567",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(mask_tel("t")).collect()]
    assert got == ["*******5678", "*******", "*******", None, "*******"]


def test_pct1_half_up_and_zero_total(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (0, 0), (5, 0)], "n long, t long")
    got = [r[0] for r in df.select(pct1("n", "t")).collect()]
    assert got == [33.3, 66.7, 12.5, 0.0, 0.0]


def test_age_band_edges(spark):
    df = spark.createDataFrame([(19,), (20,), (29,), (30,), (None,)], "a int")
    assert [r[0] for r in df.select(age_band("a")).collect()] == ["lt20", "20_29", "20_29", "ge30", None]


def test_value_bin_edges(spark):
    df = spark.createDataFrame([(-1,), (0,), (99,), (100,), (599,), (600,), (10000,)], "v long")
    assert [r[0] for r in df.select(value_bin("v")).collect()] == [0, 1, 1, 2, 6, 7, 7]


def test_previous_day():
    assert previous_day("2019-03-01") == "2019-02-28"
    assert previous_day("2020-03-01") == "2020-02-29"
    assert previous_day("2019-01-01") == "2018-12-31"
    with pytest.raises(ValueError):
        previous_day("not a date")


def test_previous_day_col(spark):
    df = spark.createDataFrame([("2019-01-01",)], "d string")
    assert df.select(previous_day_col("d")).first()[0] == "2018-12-31"


def test_camel_case(spark):
    df = spark.createDataFrame([("consignee_tel",), ("id",), ("parent_order_id",), ("Order_ID",)], "k string")
    assert [r[0] for r in df.select(camel_case("k")).collect()] == ["consigneeTel", "id", "parentOrderId", "orderId"]
    assert camel_columns(spark.createDataFrame([(1, 2)], "user_id int, total_amount int")).columns == ["userId", "totalAmount"]


def test_keyword_terms():
    assert keyword_terms("") == []
    assert keyword_terms(None) == []
    assert keyword_terms("  Red, blue red ") == ["red", "blue"]
    assert keyword_terms("Café-au-lait") == ["café", "au", "lait"]


def test_han_characters_are_words(spark):
    from storepulse.functions import keyword_terms, match_all
    df = spark.createDataFrame([("小米 红米手机 64G",), ("手表",)], "t string")
    assert keyword_terms("手机 64G") == ["手", "机", "64g"]
    assert [r.t for r in df.where(match_all("t", "手机 64g")).collect()] == ["小米 红米手机 64G"]
    assert [r[0] for r in df.select(token_count("t")).collect()] == [7, 2]
    assert df.select(tokens("t")).first()[0] == ["小", "米", "红", "米", "手", "机", "64g"]


def test_tokens_and_matching_agree(spark):
    texts = ["Red widget", "small RED", "redder widget", "widget-red!", "blue", None, "Thé, the THE"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", tokens("t").alias("tok"), token_count("t").alias("n"),
                     match_all("t", "red").alias("m1"), match_all("t", "widget red").alias("m2"),
                     match_all("t", "").alias("m0"), term_count("t", "the").alias("c")).collect()
    for r in rows:
        toks = r.tok or []
        if r.t is not None:
            assert r.n == len(toks)
        assert r.m1 == ("red" in toks)
        assert r.m2 == ("red" in toks and "widget" in toks)
        assert r.m0 is False
        if r.t is not None:
            assert r.c == toks.count("the")
