"""Shape the shared test tables into the records the dashboards work on.

The test tables carry zone-less timestamps (wall clock, read as UTC here). Every
adapter reads only the columns it needs, and date-scoped callers pass ``days`` /
``until`` so that a range predicate on the raw timestamp reaches the Parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonio import to_message
from ..functions.scalars import add_log_time, camel_columns
from ..functions.text import match_all
from ..session import bounded_tasks

UTC = "UTC"
# At most this many partitions when spreading an under-split scan (a small input on a
# large cluster should not become thousands of tiny tasks).
SPREAD_MAX = 256


def table(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    """One test table; ``heavy`` when CPU-heavy per-row work follows (see :func:`spread`)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if heavy else df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a raw file scan that has fewer splits than the cluster has cores.

    A file made of one large row group is one task however big it is; the per-row work
    pipelined after the scan (JSON, regular expressions) would then run on one core.
    When the scan is split finely enough — any large table — this is a no-op and adds
    no shuffle. Filters and column pruning still reach the scan below the repartition.
    Used only in front of CPU-heavy per-row work (text regexes, JSON messages), and only
    on a plain scan: its split count comes from the file listing, while asking a plan
    with joins for its partition count would run the join stages.
    """
    target = min_partitions or min(df.sparkSession.sparkContext.defaultParallelism, SPREAD_MAX)
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def _ntz(day: str) -> Column:
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


def _next_day(day: str) -> str:
    return (_dt.date.fromisoformat(day) + _dt.timedelta(days=1)).isoformat()


def day_range(col: str, days=None, until: str | None = None) -> Column | None:
    """Range predicate on a zone-less timestamp covering ``days`` / everything up to ``until``."""
    preds = []
    if days:
        preds.append((F.col(col) >= _ntz(min(days))) & (F.col(col) < _ntz(_next_day(max(days)))))
    if until:
        preds.append(F.col(col) < _ntz(_next_day(until)))
    if not preds:
        return None
    p = preds[0]
    for q in preds[1:]:
        p = p & q
    return p


def epoch_ms(col: str) -> Column:
    """Zone-less timestamp read as UTC -> whole epoch milliseconds (truncated; equal to the
    floor for the tables' post-1970 times)."""
    return F.timestamp_diff("MILLISECOND", _ntz("1970-01-01"), F.col(col))


def _events(spark, sf_dir, days=None, until=None, heavy=False) -> DataFrame:
    ev = table(spark, sf_dir, "events", heavy)
    p = day_range("ts", days, until)
    return ev.where(p) if p is not None else ev


def startup_records(spark: SparkSession, sf_dir: str, days=None, until=None, heavy=False) -> DataFrame:
    """Startup logs as posted and stamped: ``view`` events, device ``mid_<user>``."""
    ev = _events(spark, sf_dir, days, until, heavy).where(F.col("event_type") == "view")
    return ev.select(
        F.lit("startup").alias("type"),
        F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.concat(F.lit("area_"), (F.col("user_id") % 10).cast("string")).alias("area"),
        epoch_ms("ts").alias("ts"),
        F.col("event_id").alias("log_id"))


def startup_json(spark: SparkSession, sf_dir: str, days=None, in_time_order: int | None = None) -> DataFrame:
    """Startup logs as JSON lines (``value``); ``in_time_order=n`` range-partitions them by
    ``ts`` into ``n`` parts, as a live feed arrives (one file per time slice)."""
    rec = startup_records(spark, sf_dir, days, heavy=True)
    if in_time_order:
        rec = rec.repartitionByRange(in_time_order, "ts", "log_id")
    return to_message(rec)


def startup_logs(spark: SparkSession, sf_dir: str, days=None, until=None, tz: str = UTC) -> DataFrame:
    """Typed startup records with date parts (the shape of the ``dau`` table)."""
    r = startup_records(spark, sf_dir, days, until).withColumnRenamed("type", "log_type")
    return add_log_time(r, "ts", tz)


def event_records(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Event logs: every non-``view`` event, ``evid`` = event type, ``itemid`` from props."""
    ev = _events(spark, sf_dir, heavy=heavy).where(F.col("event_type") != "view")
    return ev.select(
        F.lit("event").alias("type"),
        F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.concat(F.lit("area_"), (F.col("user_id") % 10).cast("string")).alias("area"),
        F.col("event_type").alias("evid"),
        F.get_json_object("props", "$.k").try_cast("int").alias("itemid"),
        epoch_ms("ts").alias("ts"),
        F.col("event_id").alias("log_id"))


def raw_log_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a stamped log line (startup for ``view``, else event)."""
    ev = _events(spark, sf_dir, heavy=True)
    is_view = F.col("event_type") == "view"
    rec = ev.select(
        F.when(is_view, F.lit("startup")).otherwise(F.lit("event")).alias("type"),
        F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.when(is_view, F.lit(None)).otherwise(F.col("event_type")).alias("evid"),
        epoch_ms("ts").alias("ts"),
        F.col("event_id").alias("log_id"))
    return to_message(rec)


def order_rows(spark: SparkSession, sf_dir: str, days=None, heavy: bool = False) -> DataFrame:
    """Rows of ``order_info`` (snake_case, text timestamps): orders + customer + nation.

    ``create_time`` is the order day plus ``(key * 7919) mod 86400`` seconds, so the
    day of ``create_time`` is the order day and ``days`` can prune the scan.
    """
    o = table(spark, sf_dir, "orders", heavy).select("o_orderkey", "o_custkey", "o_orderstatus",
                                                     "o_totalprice", "o_orderdate")
    p = day_range("o_orderdate", days)
    if p is not None:
        o = o.where(p)
    # Area per customer first (customer x 25 nations, a dimension lookup), then one join
    # of the orders on the customer key: orders are shuffled once, never by nation.
    # No hints: the planner's byte threshold and AQE choose the broadcasts.
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select("c_custkey", "n_name")
    j = o.join(cn, o["o_custkey"] == cn["c_custkey"])
    secs = (F.col("o_orderkey") * 7919) % 86400
    created = F.timestamp_add("SECOND", secs, F.col("o_orderdate"))
    return j.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("n_name").alias("area"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        F.concat(F.lit("138"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("consignee_tel"),
        F.date_format(created, "yyyy-MM-dd HH:mm:ss").alias("create_time"))


def order_messages(spark: SparkSession, sf_dir: str, days=None, in_time_order: int | None = None) -> DataFrame:
    """Order rows as camelCase JSON messages with every value as text; ``in_time_order=n``
    range-partitions them by creation time into ``n`` parts (a live feed's order)."""
    rows = order_rows(spark, sf_dir, days, heavy=True)
    if in_time_order:
        rows = rows.repartitionByRange(in_time_order, "create_time", "id")
    as_text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    return to_message(camel_columns(as_text))


def odd_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a log line that a parser and writer would change: a startup line with a number of fifty digits, a
    doubled key and a time of the client's own; every tenth other one with text behind the object."""
    ev = _events(spark, sf_dir, heavy=True)
    i = F.col("event_id").cast("string")
    startup = F.concat(F.lit('{"type":"event","type":"startup","n":'), F.lit("1" + "0" * 38), F.lpad(i, 11, "0"),
                       F.lit(',"x":1.10, "ts" : "soon" ,"log_id":'), i, F.lit("}"))
    other = F.concat(F.lit('{"log_id":'), i, F.lit(',"a":{"ts":1}}'), F.when(F.col("event_id") % 10 == 0, " behind").otherwise(""))
    return ev.select(F.when(F.col("event_type") == "view", startup).otherwise(other).alias("value"))


def cdc_envelopes(spark: SparkSession, sf_dir: str, torn: str | None = None) -> DataFrame:
    """Change envelopes of ``order_info``: INSERT, or UPDATE for status ``F``; one row each. Orders of status
    ``torn`` come a second time, cut off in the middle."""
    rows = order_rows(spark, sf_dir, heavy=True)
    cols = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
                     for c in rows.columns])
    env = rows.select(
        F.lit("ROWDATA").alias("entry_type"), F.lit("order_info").alias("table"),
        F.when(F.col("order_status") == "F", F.lit("UPDATE")).otherwise(F.lit("INSERT")).alias("type"),
        F.array(cols).alias("rows"), (F.lit(False) if torn is None else F.col("order_status") == torn).alias("torn"))
    value = F.to_json(F.struct("entry_type", "table", "type", "rows"))
    cut = F.when(F.col("torn"), F.array(value, F.substr(value, F.lit(1), F.lit(60)))).otherwise(F.array(value))
    return env.select(F.explode(cut).alias("value"))


def _month_range(col: str, month: str) -> Column:
    y, m = (int(x) for x in month.split("-"))
    nxt = f"{y + (m == 12):04d}-{(m % 12) + 1:02d}-01"
    return (F.col(col) >= _ntz(f"{month}-01")) & (F.col(col) < _ntz(nxt))


def sale_rows(spark: SparkSession, sf_dir: str, dt: str | None = None,
              sku_keyword: str | None = None) -> DataFrame:
    """The warehouse wide table of daily sale details: per user, sku and month
    ``dt`` the quantity, distinct orders and amount.

    Aggregates on keys first and joins customer and part attributes after, so the big
    shuffles carry narrow rows. Distinct orders come from a two-level aggregate: the
    first level groups by order key and reuses the join's partitioning (no shuffle),
    the second counts orders per (user, sku, month) with map-side partial counts.

    ``sku_keyword``: only SKUs whose name matches (for searches). The match is on the
    part table, which joins after the aggregation, so the optimizer cannot push it down;
    here lineitems are semi-joined with the matching part keys before aggregating; the
    planner and AQE broadcast those keys when they are small. Callers still apply the
    match on the result.
    """
    o = table(spark, sf_dir, "orders")
    if dt:
        o = o.where(_month_range("o_orderdate", dt))
    o = o.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("dt"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    if sku_keyword is not None:
        skus = table(spark, sf_dir, "part").where(match_all("p_name", sku_keyword)).select("p_partkey")
        li = li.join(skus, li["l_partkey"] == skus["p_partkey"], "left_semi")
    per_order = (li.join(o, li["l_orderkey"] == o["o_orderkey"])
                   .groupBy("o_orderkey", "o_custkey", "l_partkey", "dt")
                   .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
                        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("a")))
    keyed = (per_order.groupBy("o_custkey", "l_partkey", "dt")
             .agg(F.sum("q").alias("sku_num"), F.count(F.lit(1)).alias("order_count"),
                  F.sum("a").alias("amount")))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    j = (keyed.join(c, keyed["o_custkey"] == c["c_custkey"])
              .join(p, F.col("l_partkey") == F.col("p_partkey")))
    none = F.lit(None).cast("string")
    return j.select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("p_partkey").cast("string").alias("sku_id"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("user_gender"),
        (F.lit(12) + F.col("c_custkey") % 40).cast("int").alias("user_age"),
        F.col("c_mktsegment").alias("user_level"),
        F.col("p_retailprice").alias("sku_price"),
        F.col("p_name").alias("sku_name"),
        F.col("p_brand").alias("sku_tm_id"),
        none.alias("sku_category1_id"), none.alias("sku_category2_id"), none.alias("sku_category3_id"),
        F.col("p_type").alias("sku_category1_name"), none.alias("sku_category2_name"),
        none.alias("sku_category3_name"), none.alias("spu_id"),
        F.col("sku_num").cast("bigint").alias("sku_num"),
        F.col("order_count").cast("bigint").alias("order_count"),
        F.col("amount").cast("double").alias("order_amount"),
        F.col("dt"))


def sale_settings(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Session settings for writing :func:`sale_rows` of whole tables."""
    return bounded_tasks(spark, [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("lineitem", "orders", "customer", "part")])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents (``doc_id, text``)."""
    return table(spark, sf_dir, "documents", heavy=True).select("doc_id", "text")
