"""Keyword search over sale details: match, facets, shares, paging, relevance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import AGE_EDGES, pct1
from ..functions.text import keyword_terms, match_all, term_count, token_count
from ..session import scratch_root
from .kpi import on_date

# Group titles and option labels of the sale answer.
GENDER_TITLE = "性别占比"
AGE_TITLE = "年龄占比"
GENDER_OPTIONS = (("M", "男"), ("F", "女"))
AGE_OPTIONS = (("lt20", "小于20岁"), ("20_29", "20至30岁"), ("ge30", "30岁及以上"))

# Default detail order: a total order over the sale day (user_id, sku_id is unique per dt).
def sale_order() -> list[Column]:
    return [F.col("order_amount").desc_nulls_last(), F.col("user_id"), F.col("sku_id")]


def keyword_match(df: DataFrame, col: str, keyword: str | None) -> DataFrame:
    """Rows whose ``col`` contains every token of ``keyword`` (empty keyword: no rows)."""
    return df.where(match_all(col, keyword))


def sale_hits(sale: DataFrame, date: str, keyword: str | None) -> DataFrame:
    """Sale rows of day ``date`` matching ``keyword`` on ``sku_name`` (filter AND match)."""
    return on_date(sale, "dt", date).where(match_all("sku_name", keyword))


def terms(df: DataFrame, field: str, n: int) -> DataFrame:
    """Top-``n`` values of ``field`` by count (``term`` as text, ``n``); ties by term.

    Exact: partial counts per task, one shuffle of distinct values, then a top-n.
    """
    return (df.where(F.col(field).isNotNull())
            .groupBy(F.col(field).cast("string").alias("term"))
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("term")).limit(n))


def search_total(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count(F.lit(1)).alias("total"))


def page(df: DataFrame, page_no: int, size: int, order) -> DataFrame:
    """Page ``page_no`` (from 1) of ``size`` rows in ``order`` (must be a total order)."""
    if page_no < 1 or size < 0:
        raise ValueError("page starts at 1 and size must be >= 0")
    return df.orderBy(*order).offset((page_no - 1) * size).limit(size)


def _stat_aggs() -> list[Column]:
    g, a = F.col("user_gender"), F.col("user_age")
    lo, hi = AGE_EDGES
    return [F.count(F.lit(1)).alias("total"),
            F.count_if(g == "M").alias("m"), F.count_if(g == "F").alias("f"),
            F.count_if(a < lo).alias("lt20"), F.count_if((a >= lo) & (a < hi)).alias("a20_29"),
            F.count_if(a >= hi).alias("ge30")]


def sale_stats(hits: DataFrame) -> DataFrame:
    """One pass: total hits and the counts behind both shares."""
    return hits.agg(*_stat_aggs())


def _shares(stats: DataFrame, options) -> DataFrame:
    cols = {"M": "m", "F": "f", "lt20": "lt20", "20_29": "a20_29", "ge30": "ge30"}
    arr = F.array(*[F.struct(F.lit(code).alias("name"), pct1(cols[code], "total").alias("value"))
                    for code, _ in options])
    return stats.select(F.inline(arr))


def gender_share(hits: DataFrame) -> DataFrame:
    """Percent of hits with gender M and F (one decimal); other codes count in the total only."""
    return _shares(sale_stats(hits), GENDER_OPTIONS)


def age_band_share(hits: DataFrame) -> DataFrame:
    """Percent of hits per age band; NULL ages count in the total only."""
    return _shares(sale_stats(hits), AGE_OPTIONS)


def sale_detail(sale: DataFrame, date: str, keyword: str | None, page_no: int = 1,
                size: int = 20, order=None, materialize: bool = False, score: Column | None = None) -> DataFrame:
    """The sale search answer as one row: ``total``, ``stat`` (two option groups with
    labels and shares) and ``detail`` (one page of rows, in order).

    Filters once; the shares come from one aggregate, the page from a top-k. Rows are ordered by
    ``score`` (best first) when given, else by ``order``. With
    ``materialize`` (for a ``sale`` that is an expensive derived view rather than a
    stored table) the hits are checkpointed to the shared folder first, so the view is
    computed once for both parts.
    """
    hits = sale_hits(sale, date, keyword)
    fields = hits.columns
    if score is not None:
        hits, order = hits.withColumn("_score", score), [F.col("_score").desc_nulls_last(), F.col("user_id"), F.col("sku_id")]
    order = order or sale_order()
    if materialize:
        scratch_root(sale.sparkSession)
        hits = hits.checkpoint(eager=True)
    stats = sale_stats(hits)
    cols = {"M": "m", "F": "f", "lt20": "lt20", "20_29": "a20_29", "ge30": "ge30"}

    def group(title, options):
        return F.struct(F.lit(title).alias("title"), F.array(*[
            F.struct(F.lit(label).alias("name"), pct1(cols[code], "total").alias("value"))
            for code, label in options]).alias("options"))

    rows = page(hits, page_no, size, order)
    pos = F.row_number().over(Window.orderBy(*order))  # over one page only
    detail = (rows.withColumn("_pos", pos)
              .agg(F.sort_array(F.collect_list(F.struct("_pos", F.struct(*fields).alias("r"))))
                   .alias("d"))
              .select(F.transform("d", lambda x: x["r"]).alias("detail")))
    return stats.select(
        F.col("total"),
        F.array(group(GENDER_TITLE, GENDER_OPTIONS), group(AGE_TITLE, AGE_OPTIONS)).alias("stat"),
        detail.scalar().alias("detail"))


def rank_bm25(docs: DataFrame, ids: str | list[str], text_col: str, keyword: str | None,
              page_no: int = 1, size: int = 10, k1: float = 1.2, b: float = 0.75,
              digits: int = 6, materialize: bool = True, where: Column | None = None) -> DataFrame:
    """Documents containing every keyword term, best BM25 score first: ``ids``, ``score``.

    ``where`` filters the hits only: it changes neither the statistics nor a score.

    One pass over the text builds a narrow table (id, length, count of each term);
    with ``materialize`` it is checkpointed to the shared checkpoint folder, so the text
    is read and matched once and the statistics and the scores both come from it.
    Statistics (document count, average length, document frequency per term) are over
    the whole of ``docs``, not the hits: one global aggregate (partial per task, one row
    to the driver). ``idf = ln(1 + (N - n + 0.5)/(n + 0.5))``, score rounded to ``digits``;
    ties by id.
    """
    ids = [ids] if isinstance(ids, str) else list(ids)
    terms = keyword_terms(keyword)
    text = F.col(text_col)
    if not terms:
        return docs.where(F.lit(False)).select(*ids, F.lit(0.0).alias("score"))
    hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    narrow = docs.select(*ids, hit.alias("_hit"), token_count(text).alias("_dl"),
                         *[term_count(text, t).alias(f"_tf{i}") for i, t in enumerate(terms)])
    if materialize:
        scratch_root(docs.sparkSession)  # the cluster's checkpoint folder (set only if missing)
        narrow = narrow.checkpoint(eager=True)
    tfs = [F.col(f"_tf{i}") for i in range(len(terms))]
    stats = narrow.agg(F.count(F.lit(1)).alias("n"), F.avg("_dl").alias("avgdl"),
                       *[F.count_if(tf > 0).alias(f"df{i}") for i, tf in enumerate(tfs)])
    # One aggregate job; its single row (a fixed-size record of statistics) becomes
    # literals of the score expression. As scalar subqueries, each reference would be
    # planned as a subquery of its own.
    st = stats.first()
    n, avgdl = F.lit(st["n"]), F.lit(st["avgdl"])
    all_terms = F.col("_hit")
    for tf in tfs:
        all_terms = all_terms & (tf > 0)
    score = None
    for i, tf in enumerate(tfs):
        dfi = F.lit(st[f"df{i}"])
        idf = F.log(1 + (n - dfi + 0.5) / (dfi + 0.5))
        part = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("_dl") / avgdl))
        score = part if score is None else score + part
    scored = narrow.where(all_terms).select(*ids, F.round(score, digits).alias("score"))
    return page(scored, page_no, size, [F.col("score").desc(), *ids])
