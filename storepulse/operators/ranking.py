"""Relevance of sale details from maintained statistics.

A score needs how many rows there are, how long they are and how many hold each keyword term, over
all days. Those are sums over days: each loaded day leaves its own partial statistics in a folder per
day, a search adds up one row per day and one per day and keyword term, and then scans the
rows of its own day only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import keyword_terms, term_count, token_count, tokens
from ..session import existing
from ..sinks.tables import load_sale_day
from ..sources.warehouse import DEFAULT_DT, sale_scan
from .paging import Key, keyset_page
from .search import sale_detail, sale_hits

LENGTHS = T.StructType([T.StructField("n", T.LongType()), T.StructField("sized", T.LongType()), T.StructField("length", T.LongType()),
                        T.StructField("dt", T.StringType())])
TERMS = T.StructType([T.StructField("term", T.StringType()), T.StructField("df", T.LongType()), T.StructField("dt", T.StringType())])
#: Best first; a sale day's rows are unique by user and sku.
BY_SCORE = [Key("score", descending=True), Key("user_id"), Key("sku_id")]


def statistics_root(table: str) -> str:
    return f"{table.rstrip('/')}_search"


def write_statistics(rows: DataFrame, table: str, text_col: str = "sku_name", day_col: str = "dt") -> None:
    """Write the partial statistics of every day in ``rows``, replacing those days' and no other's.

    Two aggregates over narrow columns, both combined before their shuffle; the second one's rows are the
    distinct terms of a day.
    """
    root = statistics_root(table)
    lengths = rows.groupBy(F.col(day_col).alias("dt")).agg(
        F.count(F.lit(1)).alias("n"), F.count(text_col).alias("sized"), F.coalesce(F.sum(token_count(text_col)), F.lit(0)).alias("length"))
    words = rows.select(F.col(day_col).alias("dt"), F.explode(F.array_distinct(tokens(text_col))).alias("term"))
    terms = words.groupBy("dt", "term").agg(F.count(F.lit(1)).alias("df"))
    for df, name in ((lengths, "lengths"), (terms, "terms")):
        # a term's rows of a day lie together, so that a search skips row groups by the term
        w = df.hint("rebalance", "dt")
        w = w.sortWithinPartitions("dt", "term") if name == "terms" else w
        w.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(f"{root}/{name}")


def load_searchable_day(spark: SparkSession, source: str, table: str, dt: str = DEFAULT_DT) -> int:
    """Load one day into the sale table and replace its statistics; returns its rows. A rerun sets both right."""
    rows = load_sale_day(spark, source, table, dt)
    if rows:
        write_statistics(sale_scan(spark, table, dt), table)
    else:  # no row would replace the day's partition
        empty = spark.createDataFrame([(0, 0, 0)], "n long, sized long, length long")
        empty.write.mode("overwrite").parquet(f"{statistics_root(table)}/lengths/dt={dt}")
        spark.createDataFrame([], "term string, df long").write.mode("overwrite").parquet(f"{statistics_root(table)}/terms/dt={dt}")
    return rows


@dataclass(frozen=True)
class Ranking:
    """Statistics of one keyword over all days: rows, mean length, and rows with each term."""

    terms: list[str]
    n: int
    mean_length: float | None
    df: dict[str, int]

    def score(self, text, k1: float = 1.2, b: float = 0.75, digits: int = 6) -> Column:
        """BM25 of ``text`` with ``idf = ln(1 + (N - n + 0.5)/(n + 0.5))``, rounded; NULL for an empty keyword."""
        total = None
        for t in self.terms:
            n, df, tf = F.lit(self.n), F.lit(self.df.get(t, 0)), term_count(text, t)
            idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
            part = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * token_count(text) / F.lit(self.mean_length)))
            total = part if total is None else total + part
        return F.lit(None).cast("double") if total is None else F.round(total, digits)


def ranking(spark: SparkSession, table: str, keyword: str | None) -> Ranking:
    """Add up the statistics of all days; a row per keyword term comes to the driver."""
    terms, root = keyword_terms(keyword), statistics_root(table)
    if not terms or not existing(spark, [f"{root}/lengths"]):
        return Ranking(terms, 0, None, {})
    sums = spark.read.schema(LENGTHS).parquet(f"{root}/lengths").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "sized", "length")]).first()
    found = spark.read.schema(TERMS).parquet(f"{root}/terms").where(F.col("term").isin(terms)).groupBy("term").agg(F.sum("df").alias("df")).collect()
    return Ranking(terms, sums["n"], sums["length"] / sums["sized"] if sums["sized"] else None, {r["term"]: r["df"] for r in found})


def ranked_page(spark: SparkSession, table: str, date: str, keyword: str | None, size: int = 10, cursor: dict | None = None) -> DataFrame:
    """The next ``size`` matching rows of a day, best first, behind ``cursor`` (see ``paging.cursor_of`` with BY_SCORE)."""
    score = ranking(spark, table, keyword).score("sku_name")
    return keyset_page(sale_hits(sale_scan(spark, table, date), date, keyword).withColumn("score", score), BY_SCORE, size, cursor)


def ranked_answer(spark: SparkSession, table: str, date: str, keyword: str | None, page_no: int = 1, size: int = 20) -> DataFrame:
    """The sale search answer (``total``, ``stat``, ``detail``) with its page of rows by relevance, in one plan over the day's rows."""
    score = ranking(spark, table, keyword).score("sku_name")
    return sale_detail(sale_scan(spark, table, date), date, keyword, page_no, size, score=score)
