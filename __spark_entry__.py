"""

``queries()`` maps every implemented operator/query to a ``(spark, sf_dir) -> DataFrame``
callable (see ``storepulse/plans/catalogue.py``); ``oracle_sql()`` gives the same
answer as ANSI SQL over the pre-registered test tables.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# The package sits next to this file; make it importable whatever the caller's cwd.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: today against yesterday, daily active devices per hour (24 rows)."""
    from storepulse.plans.catalogue import dau_hour_compare_q
    return dau_hour_compare_q(spark, SMOKE_DIR)


def _training_data():
    """(queries, oracle SQL) of the training-data operators, empty where that subpackage is not installed."""
    try:
        from storepulse.llm import queries as llm
    except ModuleNotFoundError as e:
        if (e.name or "").startswith("storepulse.llm"):
            return {}, {}
        raise
    except ImportError as e:  # a folder left without modules is an empty namespace package
        if "storepulse.llm" in str(e):
            return {}, {}
        raise
    import corpus_pipeline
    oracle = dict(llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        oracle["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, oracle


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from storepulse.plans.catalogue import QUERIES
    return {**QUERIES, **_training_data()[0]}


# Shared fragments of the oracle texts (test tables -> dashboard records).
_STARTUP = r"""startup AS (SELECT event_id, 'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS uid, 'area_' || (user_id % 10) AS area,
  epoch_us(ts) // 1000 AS ts, strftime(ts,'%Y-%m-%d') AS log_date, strftime(ts,'%H') AS log_hour, strftime(ts,'%H:%M') AS log_hour_minute
  FROM events WHERE event_type = 'view'),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY log_date, mid ORDER BY ts, event_id) AS rn FROM startup) WHERE rn = 1)"""

_ORDER = r"""ord AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id, n_name AS area, o_orderstatus AS order_status,
  o_totalprice AS total_amount, '138' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS consignee_tel,
  strftime(o_orderdate + to_seconds((o_orderkey * 7919) % 86400), '%Y-%m-%d %H:%M:%S') AS create_time
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
orde AS (SELECT *, substr(create_time,1,10) AS create_date, substr(create_time,12,2) AS create_hour, substr(create_time,12,5) AS create_hour_minute,
  '*******' || substr(consignee_tel, 8) AS tel_masked FROM ord)"""

_SALE = r"""sale AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, CAST(p_partkey AS VARCHAR) AS sku_id,
  CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS user_gender, CAST(12 + c_custkey % 40 AS INTEGER) AS user_age,
  c_mktsegment AS user_level, p_retailprice AS sku_price, p_name AS sku_name, p_brand AS sku_tm_id, p_type AS sku_category1_name,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sku_num, count(DISTINCT l_orderkey) AS order_count,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS order_amount, strftime(o_orderdate,'%Y-%m') AS dt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
  GROUP BY ALL),
hits AS (SELECT * FROM sale WHERE dt = '1998-10' AND list_has_all(string_split(lower(sku_name), ' '), ['red']))"""

# Words as runs of letters, marks, digits and connectors; a Han character is a word of its own.
_TOKENS = r"string_split_regex(regexp_replace(lower(text), '(\p{Han})', ' \1 ', 'g'), '[^\p{L}\p{M}\p{Nd}\p{Pc}]+')"

_HOURS = "h AS (SELECT lpad(CAST(range AS VARCHAR),2,'0') AS hour FROM range(24))"


# BM25 of the month's hits with the statistics of all months.
_RANKED = r"""toks AS (SELECT *, string_split(lower(sku_name), ' ') AS ws FROM sale),
stat AS (SELECT count(*) AS n, avg(len(ws)) AS avgdl, count(*) FILTER (WHERE list_contains(ws, 'red')) AS df FROM toks),
ranked AS (SELECT toks.* EXCLUDE (ws), round(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / avgdl)), 6) AS score
  FROM (SELECT *, len(list_filter(ws, lambda x: x = 'red')) AS tf FROM toks WHERE dt = '1998-10') toks, stat WHERE tf > 0)"""

# Order fields that the test tables don't have.
_ORDER_NULLS = ("consignee", "order_comment", "operate_time", "payment_way", "img_url", "expire_time", "delivery_address", "tracking_no",
                "parent_order_id", "out_trade_no", "trade_body")


def _w(*frags: str) -> str:
    return "WITH " + ",\n".join(frags) + "\n"


def _sale_json(rows: str, order: str, *more: str) -> str:
    """The sale answer, its page taken from ``rows`` by ``order``."""
    return _w(_SALE, *more) + f"""SELECT * FROM (WITH c AS (SELECT count(*) AS total, count(*) FILTER (WHERE user_gender = 'M') AS m, count(*) FILTER (WHERE user_gender = 'F') AS f,
  count(*) FILTER (WHERE user_age < 20) AS a, count(*) FILTER (WHERE user_age >= 20 AND user_age < 30) AS b, count(*) FILTER (WHERE user_age >= 30) AS d FROM hits),
p AS (SELECT total, list_transform([m, f, a, b, d], lambda x: CASE WHEN total = 0 THEN 0.0::DOUBLE ELSE floor(x * 1000::DOUBLE / total + 0.5) / 10 END) AS v FROM c),
r AS (SELECT * FROM {rows} ORDER BY {order} LIMIT 10),
j AS (SELECT string_agg(json_object('user_id', user_id, 'sku_id', sku_id, 'user_gender', user_gender, 'user_age', user_age, 'user_level', user_level,
  'sku_price', sku_price, 'sku_name', sku_name, 'sku_tm_id', sku_tm_id, 'sku_category1_name', sku_category1_name, 'sku_num', sku_num,
  'order_count', order_count, 'order_amount', order_amount, 'dt', dt)::VARCHAR, ',' ORDER BY {order}) AS d FROM r)
SELECT '{{"total":' || total || ',"stat":[{{"title":"性别占比","options":[{{"name":"男","value":' || v[1] || '}},{{"name":"女","value":' || v[2]
  || '}}]}},{{"title":"年龄占比","options":[{{"name":"小于20岁","value":' || v[3] || '}},{{"name":"20至30岁","value":' || v[4]
  || '}},{{"name":"30岁及以上","value":' || v[5] || '}}]}}],"detail":[' || coalesce(j.d, '') || ']}}' AS json FROM p, j)"""


def oracle_sql() -> dict[str, str]:
    S, O, SA = _STARTUP, _ORDER, _SALE
    return {
        **_training_data()[1],
        "parse_startup": _w(S) + "SELECT mid, uid, area, ts, log_date, log_hour, log_hour_minute FROM startup",
        "parse_event": "SELECT 'mid_' || user_id AS mid, event_type AS evid, CAST(json_extract_string(props,'$.k') AS INTEGER) AS itemid, "
                       "epoch_us(ts) // 1000 AS ts FROM events WHERE event_type <> 'view'",
        "route_by_type": "SELECT CASE WHEN event_type = 'view' THEN 'startup' ELSE 'event' END AS topic, count(*) AS n FROM events GROUP BY 1",
        "archive_daily": "SELECT strftime(ts,'%Y-%m-%d') AS dt, count(*) AS n FROM events GROUP BY 1",
        "archive_lines": "SELECT CASE WHEN event_type = 'view' THEN 'startup' ELSE 'event' END AS topic, event_id AS log_id, 'mid_' || user_id AS mid, "
                         "'7' AS pgid, 'wifi' AS net, 1551657600000::BIGINT AS ts FROM events",
        "sale_relevance_page": _w(SA) + """, t AS (SELECT user_id, sku_id, dt, string_split(lower(sku_name), ' ') AS toks FROM sale),
s AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl, count(*) FILTER (WHERE list_contains(toks, 'red')) AS df FROM t),
q AS (SELECT user_id, sku_id, len(toks) AS dl, len(list_filter(toks, lambda x: x = 'red')) AS tf FROM t WHERE dt = '1998-10')
SELECT user_id, sku_id, round(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) AS score
FROM q, s WHERE tf > 0 ORDER BY score DESC, user_id, sku_id LIMIT 10""".replace(", t AS", "SELECT * FROM (WITH t AS", 1) + ")",
        "dau_hour_compare_json": _w(S) + """, c AS (SELECT log_date, log_hour, count(*) AS n FROM firsts WHERE log_date IN ('2024-01-14', '2024-01-15') GROUP BY ALL),
m AS (SELECT log_date, string_agg('"' || log_hour || '":' || n, ',' ORDER BY log_hour) AS j FROM c GROUP BY 1)
SELECT '{"yesterday":{' || coalesce((SELECT j FROM m WHERE log_date = '2024-01-14'), '') || '},"today":{'
  || coalesce((SELECT j FROM m WHERE log_date = '2024-01-15'), '') || '}}' AS json""".replace(", c AS", "SELECT * FROM (WITH c AS", 1) + ")",
        "realtime_total_json": _w(S, O) + """SELECT '[{"id":"dau","name":"新增日活","value":' || (SELECT CAST(count(*) AS DOUBLE) FROM firsts WHERE log_date = '2024-01-02')
  || '},{"id":"new_mid","name":"新增设备","value":' || (SELECT CAST(count(*) AS DOUBLE) FROM (SELECT mid FROM startup GROUP BY 1 HAVING min(log_date) = '2024-01-02'))
  || '},{"id":"order_amount","name":"新增交易额","value":' || (SELECT CAST(coalesce(sum(CAST(total_amount AS DECIMAL(18,2))),0) AS DOUBLE) FROM orde WHERE create_date = '1998-10-03')
  || '}]' AS json""",
        "sale_summary_json": _sale_json("hits", "order_amount DESC, user_id, sku_id"),
        "sale_answer_ranked_json": _sale_json("ranked", "score DESC, user_id, sku_id", _RANKED),
        "cdc_insert_orders": _w(O) + 'SELECT id, user_id AS "userId", CAST(total_amount AS DOUBLE) AS "totalAmount", '
                                     'consignee_tel AS "consigneeTel" FROM ord WHERE order_status <> \'F\'',
        "order_enrich": _w(O) + "SELECT id, area, total_amount, create_date, create_hour, create_hour_minute, tel_masked FROM orde",
        "order_stream": _w(O) + "SELECT " + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in _ORDER_NULLS) + ", id, user_id, area, order_status, "
                                "total_amount, create_time, create_date, create_hour, create_hour_minute, tel_masked FROM orde",
        "order_json_roundtrip": _w(O) + "SELECT id, area, create_time FROM ord",
        "dau_first_logs": _w(S) + "SELECT log_date, mid, ts, log_hour FROM firsts",
        "dau_stream": _w(S) + "SELECT " + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ("appid", "os", "ch", "vs")) + ", mid, uid, area, 'startup' AS log_type, "
                              "log_date, log_hour, log_hour_minute, ts, event_id AS log_id FROM firsts",
        "known_devices": _w(S) + "SELECT mid, min(log_date) AS first_date FROM startup GROUP BY 1",
        "realtime_cards": _w(S, O) + "SELECT 'dau' AS id, '新增日活' AS name, CAST(count(*) AS DOUBLE) AS value FROM firsts WHERE log_date = '2024-01-02' "
                                     "UNION ALL SELECT 'new_mid', '新增设备', CAST(count(*) AS DOUBLE) FROM (SELECT mid FROM startup GROUP BY 1 HAVING min(log_date) = '2024-01-02') "
                                     "UNION ALL SELECT 'order_amount', '新增交易额', CAST(coalesce(sum(CAST(total_amount AS DECIMAL(18,2))),0) AS DOUBLE) FROM orde WHERE create_date = '1998-10-03'",
        "stream_counts": _w(S) + """, n AS (SELECT count(*) AS lines, count(*) FILTER (WHERE event_id % 50 = 0) AS torn FROM startup)
SELECT 'rows' AS counter, (lines + torn)::BIGINT AS n FROM n UNION ALL SELECT 'refused', torn::BIGINT FROM n UNION ALL SELECT 'late', 0::BIGINT
UNION ALL SELECT 'accepted', lines::BIGINT FROM n UNION ALL SELECT 'keys', (SELECT count(*) FROM firsts)::BIGINT""".replace(", n AS", "SELECT * FROM (WITH n AS", 1) + ")",
        "collect_faithful": """SELECT CASE WHEN event_type = 'view' THEN 'startup' WHEN event_id % 10 = 0 THEN 'quarantine' ELSE 'event' END AS topic,
  CASE WHEN event_type = 'view' THEN '{"type":"event","type":"startup","n":1' || repeat('0', 38) || lpad(CAST(event_id AS VARCHAR), 11, '0') || ',"x":1.10, "ts" : 1551657600000 ,"log_id":' || event_id || '}'
  WHEN event_id % 10 = 0 THEN '{"log_id":' || event_id || ',"a":{"ts":1}} behind' ELSE '{"log_id":' || event_id || ',"a":{"ts":1},"ts":1551657600000}' END AS value FROM events""",
        "cdc_stream_orders": _w(O) + 'SELECT id, user_id AS "userId", CAST(total_amount AS DOUBLE) AS "totalAmount", '
                                     'consignee_tel AS "consigneeTel" FROM ord WHERE order_status <> \'F\'',
        "cdc_ledger": _w(O) + "SELECT CASE WHEN order_status = 'F' THEN 'ignored' ELSE 'messages' END AS outcome, count(*) AS envelopes, "
                              "(count(*) FILTER (WHERE order_status <> 'F'))::BIGINT AS rows FROM ord GROUP BY 1 "
                              "UNION ALL SELECT 'refused', count(*), 0::BIGINT FROM ord WHERE order_status = 'P' HAVING count(*) > 0",
        "publish_once": _w(O) + "SELECT id, area, create_time FROM ord",
        "orders_compacted": _w(O) + "SELECT id, area, total_amount, create_date FROM orde",
        "sale_page_keyset": _w(SA) + "SELECT user_id, sku_id, sku_name, order_amount FROM hits ORDER BY order_amount DESC, user_id, sku_id LIMIT 10 OFFSET 10",
        "sale_load_files": _w(SA) + "SELECT count(*)::BIGINT AS n_rows, true AS bounded FROM sale WHERE dt = '1998-10'",
        "sale_ranked_page": _w(SA, _RANKED) + "SELECT user_id, sku_id, score FROM ranked ORDER BY score DESC, user_id, sku_id LIMIT 10 OFFSET 10",
        "dau_new_in_batch": _w(S) + "SELECT DISTINCT mid FROM startup b WHERE log_date = '2024-01-15' AND log_hour >= '12' AND NOT EXISTS "
                                    "(SELECT 1 FROM startup s WHERE s.log_date = b.log_date AND s.mid = b.mid AND s.log_hour < '12')",
        "dau_total": _w(S) + "SELECT count(*) AS total FROM firsts WHERE log_date = '2024-01-15'",
        "dau_hour": _w(S) + "SELECT log_hour, count(*) AS n FROM firsts WHERE log_date = '2024-01-15' GROUP BY 1",
        "dau_hour_compare": _w(S, _HOURS) + "SELECT hour, count(*) FILTER (WHERE log_date = '2024-01-14') AS yesterday, "
                                            "count(*) FILTER (WHERE log_date = '2024-01-15') AS today FROM h LEFT JOIN firsts ON log_hour = hour GROUP BY 1",
        "new_device_total": _w(S) + "SELECT d AS log_date, count(*) AS n FROM (SELECT mid, min(log_date) AS d FROM startup GROUP BY 1) GROUP BY 1",
        "order_total": _w(O) + "SELECT CAST(coalesce(sum(CAST(total_amount AS DECIMAL(18,2))),0) AS DOUBLE) AS total FROM orde WHERE create_date = '1998-10-03'",
        "order_hour": _w(O) + "SELECT create_hour, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orde "
                              "WHERE create_date = '1998-10-03' GROUP BY 1",
        "order_hour_compare": _w(O, _HOURS) + "SELECT hour, CAST(coalesce(sum(CAST(total_amount AS DECIMAL(18,2))) FILTER (WHERE create_date = '1998-10-02'),0) AS DOUBLE) AS yesterday, "
                                              "CAST(coalesce(sum(CAST(total_amount AS DECIMAL(18,2))) FILTER (WHERE create_date = '1998-10-03'),0) AS DOUBLE) AS today "
                                              "FROM h LEFT JOIN orde ON create_hour = hour GROUP BY 1",
        "realtime_total": _w(S, O) + "SELECT 'dau' AS id, CAST(count(*) AS DOUBLE) AS value FROM firsts WHERE log_date = '2024-01-02' "
                                     "UNION ALL SELECT 'new_mid', CAST(count(*) AS DOUBLE) FROM (SELECT mid FROM startup GROUP BY 1 HAVING min(log_date) = '2024-01-02') "
                                     "UNION ALL SELECT 'order_amount', CAST(coalesce(sum(CAST(total_amount AS DECIMAL(18,2))),0) AS DOUBLE) FROM orde WHERE create_date = '1998-10-03'",
        "sale_partition_scan": _w(SA) + "SELECT user_id, sku_id, user_gender, user_age, user_level, sku_price, sku_name, sku_tm_id, sku_category1_name, "
                                        "sku_num, order_count, order_amount, dt FROM sale WHERE dt = '1998-10'",
        "sale_keyword_total": _w(SA) + "SELECT count(*) AS total FROM hits",
        "keyword_match_documents": f"SELECT doc_id FROM documents WHERE list_has_all({_TOKENS}, ['the'])",
        "terms_topn": _w(SA) + "SELECT CAST(user_age AS VARCHAR) AS term, count(*) AS n FROM sale WHERE dt = '1998-10' GROUP BY 1 ORDER BY n DESC, term LIMIT 10",
        "sale_page": _w(SA) + "SELECT user_id, sku_id, sku_name, order_amount FROM hits ORDER BY order_amount DESC, user_id, sku_id LIMIT 10 OFFSET 10",
        "relevance_page": f"WITH d AS (SELECT doc_id, list_filter({_TOKENS}, lambda x: x <> '') AS toks FROM documents)" + r""", s AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM d),
k AS (SELECT unnest(['the','in']) AS term), tf AS (SELECT doc_id, len(toks) AS dl, term, len(list_filter(toks, lambda x: x = term)) AS tf FROM d, k),
df AS (SELECT term, count(*) AS df FROM tf WHERE tf > 0 GROUP BY 1)
SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
FROM tf JOIN df USING (term), s WHERE tf > 0 GROUP BY doc_id HAVING count(*) = 2 ORDER BY score DESC, doc_id LIMIT 10""",
        "gender_share": _w(SA, "t AS (SELECT count(*) AS total, count(*) FILTER (WHERE user_gender = 'M') AS m, count(*) FILTER (WHERE user_gender = 'F') AS f FROM hits)")
        + "SELECT 'M' AS name, CASE WHEN total = 0 THEN 0.0::DOUBLE ELSE floor(m * 1000::DOUBLE / total + 0.5) / 10 END AS value FROM t "
          "UNION ALL SELECT 'F', CASE WHEN total = 0 THEN 0.0::DOUBLE ELSE floor(f * 1000::DOUBLE / total + 0.5) / 10 END FROM t",
        "age_band_share": _w(SA, "b AS (SELECT unnest(['lt20','20_29','ge30']) AS name)",
                             "t AS (SELECT CASE WHEN user_age < 20 THEN 'lt20' WHEN user_age < 30 THEN '20_29' ELSE 'ge30' END AS band FROM hits WHERE user_age IS NOT NULL)",
                             "c AS (SELECT count(*) AS total FROM hits)")
        + "SELECT name, CASE WHEN total = 0 THEN 0.0::DOUBLE ELSE floor((SELECT count(*) FROM t WHERE band = name) * 1000::DOUBLE / total + 0.5) / 10 END AS value FROM b, c",
        "sale_summary": _w(SA) + "SELECT count(*) AS total, count(*) FILTER (WHERE user_gender = 'M') AS m, count(*) FILTER (WHERE user_gender = 'F') AS f, "
                                 "count(*) FILTER (WHERE user_age < 20) AS lt20, count(*) FILTER (WHERE user_age >= 20 AND user_age < 30) AS a20_29, "
                                 "count(*) FILTER (WHERE user_age >= 30) AS ge30 FROM hits",
        "area_sales": _w(O) + "SELECT area, count(*) AS orders, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orde GROUP BY 1",
        "area_sales_binned": _w(O) + "SELECT area, n, CASE WHEN n < 0 THEN 0 WHEN n >= 600 THEN 7 ELSE CAST(floor(n / 100.0) AS BIGINT) + 1 END AS bin "
                                     "FROM (SELECT area, count(*) AS n FROM orde GROUP BY 1)",
    }
