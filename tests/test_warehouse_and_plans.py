"""Warehouse scan, loads, and the physical plans we rely on at scale."""

import pytest

from conftest import SF001
from storepulse.plans import catalogue as C
from storepulse.schemas import SALE
from storepulse.sinks import load_sale_day
from storepulse.sources import conform, sale_scan


def _plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _sale_text_rows(spark):
    # a warehouse table with text-typed measures and the category columns in another order
    cols = [f.name for f in SALE.fields]
    row = {c: None for c in cols}
    row.update(user_id="1", sku_id="9", user_gender="M", user_age="19", sku_price="3.5", sku_num="2",
               order_count="1", order_amount="7.25", sku_name="red bolt")
    rows = [tuple(dict(row, dt=d)[c] for c in reversed(cols)) for d in ("2019-02-01", "2019-02-02")]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in reversed(cols)))


def test_conform_binds_by_name_and_casts(spark):
    out = conform(_sale_text_rows(spark))
    assert out.columns == [f.name for f in SALE.fields]
    r = out.where("dt = '2019-02-01'").first()
    assert (r.user_age, r.sku_price, r.order_count, r.order_amount) == (19, 3.5, 1, 7.25)
    with pytest.raises(ValueError):
        conform(_sale_text_rows(spark).drop("spu_id"))


def test_sale_scan_prunes_partitions_and_load_replaces(spark, tmp_dir):
    wh, idx = f"{tmp_dir}/wh", f"{tmp_dir}/idx"
    conform(_sale_text_rows(spark)).write.partitionBy("dt").parquet(wh)
    scan = sale_scan(spark, wh, "2019-02-01")
    plan = _plan(scan)
    assert "PartitionFilters: [isnotnull(dt" in plan and "2019-02-01" in plan
    assert scan.count() == 1
    load_sale_day(spark, wh, idx, "2019-02-01")
    load_sale_day(spark, wh, idx, "2019-02-01")  # rerun: replaced, not duplicated
    load_sale_day(spark, wh, idx, "2019-02-02")
    got = spark.read.schema(SALE).parquet(idx).groupBy("dt").count().collect()
    assert sorted(tuple(r) for r in got) == [("2019-02-01", 1), ("2019-02-02", 1)]


def test_load_of_an_emptied_day_and_stored_types(spark, tmp_dir):
    wh, idx = f"{tmp_dir}/wh", f"{tmp_dir}/idx"
    _sale_text_rows(spark).write.partitionBy("dt").parquet(wh)  # measures stored as text
    r = sale_scan(spark, wh, "2019-02-01").first()
    assert (r.user_age, r.sku_price, r.order_count, r.dt) == (19, 3.5, 1, "2019-02-01")
    assert sale_scan(spark, wh, "2030-01-01").count() == 0
    load_sale_day(spark, wh, idx, "2019-02-01")
    _sale_text_rows(spark).drop("dt").limit(0).write.mode("overwrite").parquet(f"{wh}/dt=2019-02-01")
    load_sale_day(spark, wh, idx, "2019-02-01")
    assert spark.read.schema(SALE).parquet(idx).count() == 0


def test_day_queries_push_time_range_to_scan(spark):
    plan = _plan(C.dau_total_q(spark, SF001))
    pushed = plan[plan.index("PushedFilters"):]
    assert all(f in pushed for f in ("EqualTo(event_type,view)", "GreaterThanOrEqual(ts,", "LessThan(ts,"))
    plan = _plan(C.order_total_q(spark, SF001))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    plan = _plan(C.sale_keyword_total_q(spark, SF001))
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_hour_compare_reads_events_once(spark):
    plan = _plan(C.dau_hour_compare_q(spark, SF001))
    assert plan.count("events.parquet") == 1


def test_projection_pruned_at_scan(spark):
    plan = _plan(C.sale_keyword_total_q(spark, SF001))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan  # count only: keys only
    plan = _plan(C.sale_page_q(spark, SF001))
    li = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema: struct<l_orderkey")][0]
    assert "l_shipdate" not in li and "l_tax" not in li and "l_extendedprice" in li


def test_bm25_scores_from_checkpointed_narrow_table(spark):
    df = C.relevance_page_q(spark, SF001)
    plan = _plan(df)
    assert df.columns == ["doc_id", "score"]
    assert "Subquery" not in plan                       # statistics are literals from one job
    assert "documents.parquet" not in plan              # the text is not read again
    assert "ExistingRDD" in plan                        # scores read the checkpointed narrow table


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["hour", "yesterday", "today"] and df.count() == 24
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(C.QUERIES) <= set(E.oracle_sql())


def test_checked_broadcast_with_bound(spark):
    from storepulse.operators import checked_broadcast
    small = spark.range(5)
    big_bound = spark.range(100)
    assert checked_broadcast(small, 10, bound=big_bound) is small          # bound too large: no hint
    hinted = checked_broadcast(small, 10)
    assert hinted is not small and "broadcast" in str(hinted._jdf.queryExecution().logical()).lower()


def test_spread_only_under_split_scans(spark):
    from storepulse.plans.adapters import spread, table
    raw = table(spark, SF001, "events")
    assert spread(raw, min_partitions=1) is raw                              # already split enough
    spread_df = spread(raw.where("event_type = 'view'"), min_partitions=64)
    plan = _plan(spread_df)
    assert "RoundRobinPartitioning(64)" in plan and "EqualTo(event_type,view)" in plan  # filter still pushed


def test_scratch_folders_go_together(spark):
    import os
    from storepulse.session import build_session, remove_scratch, scratch_path
    a, b = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert a != b and os.path.dirname(a) == os.path.dirname(b) and spark.sparkContext.applicationId in a
    kept = os.listdir(os.path.dirname(a)) if os.path.isdir(os.path.dirname(a)) else []
    spark.range(3).write.parquet(a)
    other = os.path.join(os.path.dirname(os.path.dirname(a)), "another-application", "x")
    spark.range(3).write.parquet(other)
    if not kept:  # nothing of other tests is in use
        remove_scratch(spark)
        assert not os.path.exists(a)
    assert os.path.exists(other)


@pytest.mark.parametrize("name", ["sale_partition_scan", "sale_ranked_page", "sale_answer_ranked_json"])
def test_tasks_of_the_sale_table_do_not_grow(spark, monkeypatch, name):
    """All months are joined and written in partitions that follow the tables' size; the session keeps its settings."""
    from pyspark.sql import DataFrameWriter
    from storepulse import session
    from storepulse.plans.catalogue import QUERIES
    parts, task = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    seen, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(session, "PART_INPUT", 2000)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, path, *a, **kw: (seen.append((path, w._spark.conf.get(parts, None), w._spark.conf.get(task))), parquet(w, path, *a, **kw))[1])
    before = spark.conf.get(parts, None), spark.conf.get(task)
    QUERIES[name](spark, "/root/testdata/sf0.001")
    (_, n, size), = [x for x in seen if x[0].endswith(("/warehouse", "/sale"))]
    assert int(n) > 20 and int(size) == session.TASK_SHUFFLE
    assert (spark.conf.get(parts, None), spark.conf.get(task)) == before
