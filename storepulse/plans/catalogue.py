"""The dashboard's questions over the test tables, one function per query.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables.
Streaming entries write their input (derived from the tables by Spark) to a fresh
folder under the shared scratch root, run the stream to the end of the input with an
``availableNow`` trigger, and return the table the stream wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonio import as_json, to_message
from ..operators import answers, dedup, kpi, paging, ranking, search
from ..schemas import SALE, STARTUP
from ..session import scratch_path, settings
from ..sinks.compact import compact_partition
from ..sinks.tables import load_sale_day, publish
from ..sources.cdc import cdc_to_messages, parse_envelope
from ..sources.logs import log_stream, parse_event, parse_logs, parse_startup, route, topic_stream
from ..sources.orders import enrich_order, parse_order
from ..sources.warehouse import sale_scan
from ..streaming import (ORDERS_TABLE, BatchCounts, batch_counts, cdc_stream_to_orders, collect_logs, dau_stream,
                         known_devices, known_devices_stream, new_device_card, order_stream, read_dau, read_ledger, read_orders,
                         run_to_end)
from . import adapters as A

# Fixed parameters of the catalogue (dates present in the test tables).
DAU_DATE = "2024-01-15"
KPI_DATE = "2024-01-02"
ORDER_DATE = "1998-10-03"
SALE_DT = "1998-10"
SALE_KEYWORD = "red"
DOC_KEYWORD = "the"
REL_KEYWORD = "the in"
PAGE_SIZE = 10
LOAD_ROWS = 100
STAMP_MS = 1551657600000  # 2019-03-04 00:00 UTC
TZ = A.UTC

# Micro-batch durations (ms) of the last run of each streaming entry, for the benchmark.
STREAM_BATCH_MS: dict[str, list[int]] = {}


def _slices(spark, max_files: int | None) -> int | None:
    """Fed in micro-batches (``max_files``), the input is written in time order like a live
    feed; drained in one batch, its order does not matter."""
    return spark.sparkContext.defaultParallelism if max_files else None


def _run(name: str, query) -> None:
    run_to_end(query)
    STREAM_BATCH_MS[name] = [p["durationMs"].get("triggerExecution", 0) for p in query.recentProgress
                             if p.get("numInputRows", 0) > 0]



def _firsts(logs: DataFrame) -> DataFrame:
    return dedup.first_per_key(logs, ["log_date", "mid"], [F.col("ts").asc_nulls_last(), F.col("log_id").asc_nulls_last()])


def _orders(spark, sf_dir, days=None) -> DataFrame:
    """The ``orders`` index: order rows with date parts and masked phone."""
    return enrich_order(A.order_rows(spark, sf_dir, days))


def _sale(spark, sf_dir) -> DataFrame:
    return A.sale_rows(spark, sf_dir, SALE_DT)


def _write_sale(spark, sf_dir, path: str, dt: str | None = None) -> None:
    """The warehouse table by month; its joins and its writer hold as much per task whatever the tables' size."""
    with settings(spark, A.sale_settings(spark, sf_dir)):
        A.sale_rows(spark, sf_dir, dt).hint("rebalance", "dt").write.partitionBy("dt").parquet(path)


def _hits(spark, sf_dir) -> DataFrame:
    sale = A.sale_rows(spark, sf_dir, SALE_DT, sku_keyword=SALE_KEYWORD)
    return search.sale_hits(sale, SALE_DT, SALE_KEYWORD)


# --- ingest -----------------------------------------------------------------------------

def parse_startup_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = parse_startup(A.startup_json(spark, sf_dir), tz=TZ)
    return logs.select("mid", "uid", "area", "ts", "log_date", "log_hour", "log_hour_minute")


def parse_event_q(spark, sf_dir):
    ev = parse_event(to_message(A.event_records(spark, sf_dir, heavy=True)))
    return ev.select("mid", "evid", "itemid", "ts")


def route_by_type_q(spark, sf_dir):
    routed = route(parse_logs(A.raw_log_json(spark, sf_dir)))
    return routed.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def archive_daily_q(spark, sf_dir, max_files: int | None = None):
    """Stream the raw log lines through the collector; count the archive per day."""
    root = scratch_path(spark, "collect")
    A.raw_log_json(spark, sf_dir).write.text(f"{root}/in")
    q = collect_logs(log_stream(spark, f"{root}/in", max_files=max_files), f"{root}/out", f"{root}/_checkpoint",
                     trigger="availableNow", now="client", tz=TZ)
    _run("archive_daily", q)
    arch = spark.read.schema("value string, dt string, batch_id long").text(f"{root}/out/archive")
    return arch.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


def archive_lines_q(spark, sf_dir):
    """Stream lines with a field no schema knows and a quoted number through the collector; content of the routed lines."""
    root = scratch_path(spark, "collect")
    odd = F.concat(F.expr("substr(value, 1, length(value) - 1)"), F.lit(',"pgid":"7","net":{"kind":"wifi"}}'))
    A.raw_log_json(spark, sf_dir).select(odd.alias("value")).write.text(f"{root}/in")
    run_to_end(collect_logs(log_stream(spark, f"{root}/in"), f"{root}/out", f"{root}/_checkpoint",
                            trigger="availableNow", now=STAMP_MS, tz=TZ))
    got = spark.read.schema("value string, topic string").text(f"{root}/out/topics")
    field = lambda path: F.get_json_object("value", path)
    return got.select("topic", field("$.log_id").cast("long").alias("log_id"), field("$.mid").alias("mid"), field("$.pgid").alias("pgid"),
                      field("$.net.kind").alias("net"), field("$.ts").cast("long").alias("ts"))


def collect_faithful_q(spark, sf_dir):
    """Lines as they leave the collector, text for text: numbers of fifty digits, doubled keys, odd spaces, text behind the object."""
    root = scratch_path(spark, "faithful")
    A.odd_log_lines(spark, sf_dir).write.text(f"{root}/in")
    run_to_end(collect_logs(log_stream(spark, f"{root}/in"), f"{root}/out", f"{root}/_checkpoint", trigger="availableNow", now=STAMP_MS, tz=TZ))
    routed = spark.read.schema("value string, topic string").text(f"{root}/out/topics")
    refused = spark.read.schema("value string").text(f"{root}/out/quarantine")
    return routed.select("topic", "value").unionByName(refused.select(F.lit("quarantine").alias("topic"), "value"))


def _cdc(spark, sf_dir) -> str:
    """Run the change stream over every envelope, and a torn copy of those of status P."""
    root = scratch_path(spark, "cdc")
    env = A.cdc_envelopes(spark, sf_dir, torn="P")
    env.write.text(f"{root}/in")
    run_to_end(cdc_stream_to_orders(spark, f"{root}/in", f"{root}/out", f"{root}/_checkpoint", trigger="availableNow"))
    return f"{root}/out"


def cdc_stream_orders_q(spark, sf_dir):
    msgs = spark.read.schema("value string").text(f"{_cdc(spark, sf_dir)}/order")
    o = parse_order(msgs)
    return o.select("id", F.col("user_id").alias("userId"), F.col("total_amount").alias("totalAmount"), F.col("consignee_tel").alias("consigneeTel"))


def cdc_ledger_q(spark, sf_dir):
    """What became of the envelopes: messages, ignored, refused, and the rows among them."""
    return read_ledger(spark, _cdc(spark, sf_dir)).groupBy("outcome").agg(F.sum("envelopes").alias("envelopes"), F.sum("rows").alias("rows"))


def publish_once_q(spark, sf_dir):
    """Order messages published twice as the same batch: one copy is there."""
    root = scratch_path(spark, "publish")
    msgs = A.order_messages(spark, sf_dir)
    for _ in range(2):
        publish(msgs, "order", root, batch_id=0)
    return parse_order(spark.read.schema("value string").text(f"{root}/order")).select("id", "area", "create_time")


def orders_compacted_q(spark, sf_dir):
    """The order stream's table after its months were fed in two batches and one month was merged."""
    root = scratch_path(spark, "compacted")
    for i, half in enumerate(A.order_messages(spark, sf_dir).randomSplit([0.5, 0.5], 7)):
        half.write.mode("append").text(f"{root}/in")
        run_to_end(order_stream(topic_stream(spark, f"{root}/in"), f"{root}/orders", f"{root}/_checkpoint", trigger="availableNow"))
    compact_partition(spark, f"{root}/orders", ORDERS_TABLE, "create_month", ORDER_DATE[:7], sort_by=["create_date"])
    return read_orders(spark, f"{root}/orders").select("id", "area", "total_amount", "create_date")


def cdc_insert_orders_q(spark, sf_dir):
    msgs = cdc_to_messages(parse_envelope(A.cdc_envelopes(spark, sf_dir)))
    o = parse_order(msgs)
    return o.select("id", F.col("user_id").alias("userId"), F.col("total_amount").alias("totalAmount"),
                    F.col("consignee_tel").alias("consigneeTel"))


def order_enrich_q(spark, sf_dir):
    o = enrich_order(parse_order(A.order_messages(spark, sf_dir)))
    return o.select("id", "area", "total_amount", "create_date", "create_hour", "create_hour_minute",
                    F.col("consignee_tel").alias("tel_masked"))


def _all_order_columns(orders: DataFrame) -> DataFrame:
    names = [c for c in ORDERS_TABLE.fieldNames() if c not in ("consignee_tel", "create_month", "writer", "batch_id")]
    return orders.select(*names, F.col("consignee_tel").alias("tel_masked"))


def order_stream_q(spark, sf_dir, max_files: int | None = None):
    root = scratch_path(spark, "order_stream")
    A.order_messages(spark, sf_dir, in_time_order=_slices(spark, max_files)).write.text(f"{root}/in")
    _run("order_stream", order_stream(topic_stream(spark, f"{root}/in", max_files=max_files), f"{root}/orders",
                                      f"{root}/_checkpoint", trigger="availableNow", quarantine=f"{root}/quarantine"))
    return _all_order_columns(read_orders(spark, f"{root}/orders"))


def order_json_roundtrip_q(spark, sf_dir):
    o = parse_order(A.order_messages(spark, sf_dir))
    return o.select("id", "area", "create_time")


# --- daily devices ----------------------------------------------------------------------

def dau_first_logs_q(spark, sf_dir):
    return _firsts(A.startup_logs(spark, sf_dir)).select("log_date", "mid", "ts", "log_hour")


def dau_stream_q(spark, sf_dir, max_files: int | None = None):
    root = scratch_path(spark, "dau_stream")
    A.startup_json(spark, sf_dir, in_time_order=_slices(spark, max_files)).write.text(f"{root}/in")
    _run("dau_stream", dau_stream(log_stream(spark, f"{root}/in", max_files=max_files), f"{root}/dau",
                                  f"{root}/_checkpoint", trigger="availableNow", tz=TZ))
    return read_dau(spark, f"{root}/dau").select(*STARTUP.fieldNames())


def known_devices_q(spark, sf_dir):
    """First day of every device, from the moves that the keyed stream kept."""
    root = scratch_path(spark, "known_devices")
    A.startup_json(spark, sf_dir).write.text(f"{root}/in")
    run_to_end(known_devices_stream(log_stream(spark, f"{root}/in"), f"{root}/known", f"{root}/_checkpoint", trigger="availableNow", tz=TZ))
    return known_devices(spark, f"{root}/known")


def realtime_cards_q(spark, sf_dir):
    """The KPI cards from the tables that the three streams keep: each card opens one day's folder (orders: one month's)."""
    root = scratch_path(spark, "cards")
    A.startup_json(spark, sf_dir).write.text(f"{root}/startup")
    A.order_messages(spark, sf_dir).write.text(f"{root}/order")
    run_to_end(dau_stream(log_stream(spark, f"{root}/startup"), f"{root}/dau", f"{root}/_dau", trigger="availableNow", tz=TZ))
    run_to_end(known_devices_stream(log_stream(spark, f"{root}/startup"), f"{root}/known", f"{root}/_known", trigger="availableNow", tz=TZ))
    run_to_end(order_stream(topic_stream(spark, f"{root}/order"), f"{root}/orders", f"{root}/_orders", trigger="availableNow"))
    cards = kpi.realtime_total(read_dau(spark, f"{root}/dau", [KPI_DATE]), None, read_orders(spark, f"{root}/orders", [ORDER_DATE]), KPI_DATE,
                               ORDER_DATE, new_mid=new_device_card(spark, f"{root}/known", KPI_DATE))
    return cards.select("id", "name", "value")


def stream_counts_q(spark, sf_dir):
    """Counts of the daily-device stream as its listener kept them, torn lines among its input."""
    root = scratch_path(spark, "stream_counts")
    lines = A.startup_json(spark, sf_dir)
    torn = lines.where(F.get_json_object("value", "$.log_id").cast("long") % 50 == 0).select(F.substr("value", F.lit(1), F.lit(10)).alias("value"))
    lines.unionByName(torn).write.text(f"{root}/in")
    counts = BatchCounts(spark, f"{root}/counts")
    spark.streams.addListener(counts)
    try:
        counts.wait(run_to_end(dau_stream(log_stream(spark, f"{root}/in"), f"{root}/dau", f"{root}/_checkpoint", trigger="availableNow", tz=TZ)))
    finally:
        spark.streams.removeListener(counts)
    kept = batch_counts(spark, f"{root}/counts").where(F.col("metric") == "dau_in")
    return kept.groupBy("counter").agg(F.sum("n").alias("n"))


def dau_new_in_batch_q(spark, sf_dir):
    """Seen = the day's logs before noon; batch = the day's logs from noon on."""
    day = A.startup_logs(spark, sf_dir, days=[DAU_DATE]).where(F.col("log_date") == DAU_DATE)
    batch = _firsts(day.where(F.col("log_hour") >= "12"))
    seen = day.where(F.col("log_hour") < "12")
    return dedup.drop_seen(batch, seen, ["log_date", "mid"]).select("mid")


def dau_total_q(spark, sf_dir):
    return kpi.dau_total(_firsts(A.startup_logs(spark, sf_dir, days=[DAU_DATE])), DAU_DATE)


def dau_hour_q(spark, sf_dir):
    return kpi.dau_hour(_firsts(A.startup_logs(spark, sf_dir, days=[DAU_DATE])), DAU_DATE)


def dau_hour_compare_q(spark, sf_dir):
    days = [kpi.previous_day(DAU_DATE), DAU_DATE]
    return kpi.realtime_hour(spark, "dau", DAU_DATE, dau=_firsts(A.startup_logs(spark, sf_dir, days=days)))


def new_device_total_q(spark, sf_dir):
    return kpi.new_devices(A.startup_logs(spark, sf_dir))


def realtime_total_q(spark, sf_dir):
    dau = _firsts(A.startup_logs(spark, sf_dir, days=[KPI_DATE]))
    logs = A.startup_logs(spark, sf_dir, until=KPI_DATE)
    orders = _orders(spark, sf_dir, days=[ORDER_DATE])
    return kpi.realtime_total(dau, logs, orders, KPI_DATE, ORDER_DATE).select("id", "value")


# --- orders -------------------------------------------------------------------------------

def order_total_q(spark, sf_dir):
    return kpi.order_total(_orders(spark, sf_dir, days=[ORDER_DATE]), ORDER_DATE)


def order_hour_q(spark, sf_dir):
    return kpi.order_hour(_orders(spark, sf_dir, days=[ORDER_DATE]), ORDER_DATE)


def order_hour_compare_q(spark, sf_dir):
    days = [kpi.previous_day(ORDER_DATE), ORDER_DATE]
    return kpi.realtime_hour(spark, "order_amount", ORDER_DATE, orders=_orders(spark, sf_dir, days=days))


def area_sales_q(spark, sf_dir):
    return kpi.area_sales(_orders(spark, sf_dir))


def area_sales_binned_q(spark, sf_dir):
    return kpi.area_sales_binned(_orders(spark, sf_dir))


# --- sales search -------------------------------------------------------------------------

SALE_SCAN_COLUMNS = ["user_id", "sku_id", "user_gender", "user_age", "user_level", "sku_price",
                     "sku_name", "sku_tm_id", "sku_category1_name", "sku_num", "order_count", "order_amount", "dt"]


def sale_partition_scan_q(spark, sf_dir):
    """Write the warehouse table by month, load one month into the index through the
    partition-pruned scan, read the loaded day back."""
    root = scratch_path(spark, "sale_load")
    _write_sale(spark, sf_dir, f"{root}/warehouse")
    load_sale_day(spark, f"{root}/warehouse", f"{root}/sale_detail", SALE_DT)
    return sale_scan(spark, f"{root}/sale_detail", SALE_DT).select(*SALE_SCAN_COLUMNS)


def sale_keyword_total_q(spark, sf_dir):
    return search.search_total(_hits(spark, sf_dir))


def keyword_match_documents_q(spark, sf_dir):
    return search.keyword_match(A.documents(spark, sf_dir), "text", DOC_KEYWORD).select("doc_id")


def terms_topn_q(spark, sf_dir):
    return search.terms(_sale(spark, sf_dir).where(F.col("dt") == SALE_DT), "user_age", 10)


def sale_page_q(spark, sf_dir):
    return search.page(_hits(spark, sf_dir), 2, PAGE_SIZE, search.sale_order()).select(
        "user_id", "sku_id", "sku_name", "order_amount")


def relevance_page_q(spark, sf_dir):
    return search.rank_bm25(A.documents(spark, sf_dir), "doc_id", "text", REL_KEYWORD, 1, PAGE_SIZE)


def sale_relevance_page_q(spark, sf_dir):
    """The month's sales that match, best first; statistics over the sales of all months."""
    with settings(spark, A.sale_settings(spark, sf_dir)):  # the sales of all months are worked out inside, once
        return search.rank_bm25(A.sale_rows(spark, sf_dir), ["user_id", "sku_id"], "sku_name", SALE_KEYWORD, 1, PAGE_SIZE,
                                where=F.col("dt") == SALE_DT)


def _sale_table(spark, sf_dir) -> str:
    """The stored sale table: every month with its statistics, one month loaded from the warehouse on top."""
    root = scratch_path(spark, "sale_table")
    _write_sale(spark, sf_dir, f"{root}/sale")
    ranking.write_statistics(spark.read.schema(SALE).parquet(f"{root}/sale"), f"{root}/sale")
    return f"{root}/sale"


def sale_answer_ranked_json_q(spark, sf_dir):
    """The sale search answer by relevance: statistics of all months added up, rows of one month scanned."""
    return as_json(ranking.ranked_answer(spark, _sale_table(spark, sf_dir), SALE_DT, SALE_KEYWORD, 1, PAGE_SIZE))


def sale_ranked_page_q(spark, sf_dir):
    """The second page by relevance, behind the last row of the first."""
    table = _sale_table(spark, sf_dir)
    first = ranking.ranked_page(spark, table, SALE_DT, SALE_KEYWORD, PAGE_SIZE).collect()
    cursor = paging.cursor_of(first[-1] if first else None, ranking.BY_SCORE)
    return ranking.ranked_page(spark, table, SALE_DT, SALE_KEYWORD, PAGE_SIZE, cursor).select("user_id", "sku_id", "score")


def sale_page_keyset_q(spark, sf_dir):
    """The second page by amount, behind the last row of the first."""
    hits = _hits(spark, sf_dir).select("user_id", "sku_id", "sku_name", "order_amount")
    keys = [paging.Key("order_amount", descending=True), paging.Key("user_id"), paging.Key("sku_id")]
    first = paging.keyset_page(hits, keys, PAGE_SIZE).collect()
    return paging.keyset_page(hits, keys, PAGE_SIZE, paging.cursor_of(first[-1] if first else None, keys))


def sale_load_files_q(spark, sf_dir):
    """One month loaded in files of at most ``LOAD_ROWS`` rows: its rows, its fullest file within the bound, files no more than needed per task."""
    root = scratch_path(spark, "sale_files")
    _write_sale(spark, sf_dir, f"{root}/warehouse", SALE_DT)
    load_sale_day(spark, f"{root}/warehouse", f"{root}/sale", SALE_DT, max_records_per_file=LOAD_ROWS)
    files = spark.read.parquet(f"{root}/sale/dt={SALE_DT}").groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.max("n") <= LOAD_ROWS, F.lit(True)).alias("bounded"))


def gender_share_q(spark, sf_dir):
    return search.gender_share(_hits(spark, sf_dir))


def age_band_share_q(spark, sf_dir):
    return search.age_band_share(_hits(spark, sf_dir))


def sale_summary_q(spark, sf_dir):
    return search.sale_stats(_hits(spark, sf_dir))


def realtime_total_json_q(spark, sf_dir):
    """The KPI list answer as JSON (flat values checked by ``realtime_total``)."""
    dau = _firsts(A.startup_logs(spark, sf_dir, days=[KPI_DATE]))
    logs = A.startup_logs(spark, sf_dir, until=KPI_DATE)
    orders = _orders(spark, sf_dir, days=[ORDER_DATE])
    return answers.kpi_list_json(kpi.realtime_total(dau, logs, orders, KPI_DATE, ORDER_DATE))


def dau_hour_compare_json_q(spark, sf_dir):
    """The hourly comparison answer as JSON maps (flat values checked by ``dau_hour_compare``)."""
    days = [kpi.previous_day(DAU_DATE), DAU_DATE]
    dau = _firsts(A.startup_logs(spark, sf_dir, days=days))
    return answers.hour_maps_json(kpi.realtime_hour(spark, "dau", DAU_DATE, dau=dau, fill=False))


def sale_summary_json_q(spark, sf_dir):
    sale = A.sale_rows(spark, sf_dir, SALE_DT, sku_keyword=SALE_KEYWORD)
    return as_json(search.sale_detail(sale, SALE_DT, SALE_KEYWORD, 1, PAGE_SIZE, materialize=True))


QUERIES = {
    "parse_startup": parse_startup_q,
    "parse_event": parse_event_q,
    "route_by_type": route_by_type_q,
    "archive_daily": archive_daily_q,
    "cdc_insert_orders": cdc_insert_orders_q,
    "order_enrich": order_enrich_q,
    "order_stream": order_stream_q,
    "order_json_roundtrip": order_json_roundtrip_q,
    "dau_first_logs": dau_first_logs_q,
    "dau_stream": dau_stream_q,
    "dau_new_in_batch": dau_new_in_batch_q,
    "dau_total": dau_total_q,
    "dau_hour": dau_hour_q,
    "dau_hour_compare": dau_hour_compare_q,
    "new_device_total": new_device_total_q,
    "order_total": order_total_q,
    "order_hour": order_hour_q,
    "order_hour_compare": order_hour_compare_q,
    "realtime_total": realtime_total_q,
    "sale_partition_scan": sale_partition_scan_q,
    "sale_keyword_total": sale_keyword_total_q,
    "keyword_match_documents": keyword_match_documents_q,
    "terms_topn": terms_topn_q,
    "sale_page": sale_page_q,
    "relevance_page": relevance_page_q,
    "sale_relevance_page": sale_relevance_page_q,
    "archive_lines": archive_lines_q,
    "gender_share": gender_share_q,
    "age_band_share": age_band_share_q,
    "sale_summary": sale_summary_q,
    "sale_summary_json": sale_summary_json_q,
    "realtime_total_json": realtime_total_json_q,
    "dau_hour_compare_json": dau_hour_compare_json_q,
    "known_devices": known_devices_q,
    "realtime_cards": realtime_cards_q,
    "stream_counts": stream_counts_q,
    "collect_faithful": collect_faithful_q,
    "cdc_stream_orders": cdc_stream_orders_q,
    "cdc_ledger": cdc_ledger_q,
    "publish_once": publish_once_q,
    "orders_compacted": orders_compacted_q,
    "sale_answer_ranked_json": sale_answer_ranked_json_q,
    "sale_ranked_page": sale_ranked_page_q,
    "sale_page_keyset": sale_page_keyset_q,
    "sale_load_files": sale_load_files_q,
    "area_sales": area_sales_q,
    "area_sales_binned": area_sales_binned_q,
}
