"""Keyset pages equal offset pages; scores from per-day statistics equal those over the whole table."""

import random

import pytest
from pyspark.sql import functions as F

from storepulse.operators import page, rank_bm25
from storepulse.operators.paging import Key, after, cursor_of, keyset_page
from storepulse.operators.ranking import BY_SCORE, load_searchable_day, ranked_answer, ranked_page, ranking, write_statistics
from storepulse.schemas import SALE
from storepulse.sources import sale_scan

DAYS = ("2019-02-01", "2019-02-02", "2019-02-03")


def _walk(df, keys, size):
    rows, cursor = [], None
    while True:
        got = keyset_page(df, keys, size, cursor).collect()
        rows += got
        if len(got) < size:
            return rows
        cursor = cursor_of(got[-1], keys)


@pytest.mark.parametrize("keys", [[Key("a", True), Key("b"), Key("i")], [Key("a"), Key("b", True), Key("i", True)], [Key("b"), Key("i")]])
def test_pages_behind_a_cursor_are_offset_pages(spark, keys):
    rnd = random.Random(5)
    rows = [(rnd.choice([None, 1.5, 2.5, -3.0, 1.5]), rnd.choice([None, "x", "y", "é"]), i) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b string, i int").repartition(5).cache()
    want = [tuple(r) for n in range(1, 10) for r in page(df, n, 7, [k.order() for k in keys]).collect()]
    assert len(want) == 60 and [tuple(r) for r in _walk(df, keys, 7)] == want
    assert keyset_page(df, keys, 7, cursor_of(df.orderBy(*[k.order() for k in keys]).collect()[-1], keys)).count() == 0
    df.unpersist()


def test_a_deep_page_keeps_size_rows_a_task(spark, tmp_dir):
    df = spark.range(200_000).select((F.col("id") % 1000 / 7).alias("amount"), F.col("id").alias("user_id"))
    df.repartitionByRange(8, "amount").write.parquet(f"{tmp_dir}/t")
    df, keys = spark.read.parquet(f"{tmp_dir}/t"), [Key("amount", True), Key("user_id")]
    last = page(df, 10_000, 10, [k.order() for k in keys]).collect()[-1]
    deep = keyset_page(df, keys, 10, cursor_of(last, keys))
    assert [tuple(r) for r in deep.collect()] == [tuple(r) for r in page(df, 10_001, 10, [k.order() for k in keys]).collect()]
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=10," in plan and "LessThanOrEqual(amount" in plan  # and the scan skips row groups
    assert "limit=100010" in page(df, 10_001, 10, [k.order() for k in keys])._jdf.queryExecution().executedPlan().toString()


def test_cursor_predicate_without_rows(spark):
    df = spark.createDataFrame([], "a double, i int")
    assert cursor_of(None, BY_SCORE) is None and df.where(after([Key("a"), Key("i")], {"a": None, "i": 3})).count() == 0


def _warehouse(spark, root):
    rnd, words = random.Random(3), ["red", "Red", "blue", "bolt", "widget", "中", "x1"]
    base = {f.name: None for f in SALE.fields}
    rows = []
    for d, n in zip(DAYS, (40, 25, 60)):
        for i in range(n):
            name = None if i % 17 == 0 else " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 6)))
            r = {**base, "user_id": str(i % 9), "sku_id": str(i), "user_age": 15 + i % 30, "user_gender": "MF"[i % 2], "sku_name": name, "dt": d}
            rows.append(tuple(r[f.name] for f in SALE.fields))
    spark.createDataFrame(rows, SALE).write.mode("overwrite").partitionBy("dt").parquet(root)


@pytest.fixture()
def table(spark, tmp_dir):
    _warehouse(spark, f"{tmp_dir}/wh")
    for d in DAYS:
        assert load_searchable_day(spark, f"{tmp_dir}/wh", f"{tmp_dir}/sale", d) > 0
    return f"{tmp_dir}/sale"


@pytest.mark.parametrize("keyword", ["red", "widget red", "中", "nothing", ""])
def test_scores_equal_the_whole_table(spark, table, keyword):
    everything = spark.read.schema(SALE).parquet(table)
    for d in DAYS[:2]:
        want = [tuple(r) for r in rank_bm25(everything, ["user_id", "sku_id"], "sku_name", keyword, 1, 1000, where=F.col("dt") == d).collect()]
        got, cursor = [], None
        while True:
            rows = ranked_page(spark, table, d, keyword, 4, cursor).collect()
            got += [(r.user_id, r.sku_id, r.score) for r in rows]
            if len(rows) < 4:
                break
            cursor = cursor_of(rows[-1], BY_SCORE)
        assert got == want
        answer = ranked_answer(spark, table, d, keyword, 1, 5).first()
        assert answer.total == len(want) and [(r.user_id, r.sku_id) for r in answer.detail] == [w[:2] for w in want[:5]]
        assert "_score" not in (answer.detail[0].asDict() if answer.detail else {})


def test_a_search_scans_its_day_only(spark, table):
    files = ranked_page(spark, table, DAYS[1], "red").inputFiles()
    assert files and all(f"dt={DAYS[1]}" in f for f in files)


def test_reloading_a_day_replaces_its_statistics(spark, table, tmp_dir):
    before = ranking(spark, table, "red bolt")
    assert load_searchable_day(spark, f"{tmp_dir}/wh", table, DAYS[0]) == 40
    assert ranking(spark, table, "red bolt") == before
    kept = sale_scan(spark, f"{tmp_dir}/wh", DAYS[2])
    kept.write.mode("overwrite").partitionBy("dt").parquet(f"{tmp_dir}/wh2")
    assert load_searchable_day(spark, f"{tmp_dir}/wh2", table, DAYS[0]) == 0  # the day has become empty
    rest = spark.read.schema(SALE).parquet(table)
    write_statistics(rest, f"{tmp_dir}/fresh")
    assert ranking(spark, table, "red bolt") == ranking(spark, f"{tmp_dir}/fresh", "red bolt") and rest.count() == 85


def test_no_statistics_yet(spark, tmp_dir):
    r = ranking(spark, f"{tmp_dir}/none", "red")
    assert (r.n, r.mean_length, r.df) == (0, None, {})
    assert ranked_page(spark, f"{tmp_dir}/none", "2019-02-01", "red").count() == 0
