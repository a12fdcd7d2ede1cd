"""Dashboard figures: daily devices, order amounts, hourly series, sales by area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import previous_day, value_bin

# KPI ids and their display names on the dashboard.
KPI_NAMES = {"dau": "新增日活", "new_mid": "新增设备", "order_amount": "新增交易额"}


def on_date(df: DataFrame, col: str, date: str) -> DataFrame:
    """Exact (unscored) filter on a date text column."""
    return df.where(F.col(col) == F.lit(date))


def sum_money(col) -> F.Column:
    """Sum through decimal(18,2) so that the order of addition cannot change the answer."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(18,2)"))


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    """Number of daily-first device records of ``date`` (0 when none)."""
    return on_date(dau, "log_date", date).agg(F.count(F.lit(1)).alias("total"))


def dau_hour(dau: DataFrame, date: str) -> DataFrame:
    """Devices per ``log_hour`` of ``date``; hours without rows are absent."""
    return (on_date(dau, "log_date", date).groupBy("log_hour")
            .agg(F.count(F.lit(1)).alias("n")))


def order_total(orders: DataFrame, date: str) -> DataFrame:
    """Order amount of ``date``; 0.0 when there are no orders."""
    return (on_date(orders, "create_date", date)
            .agg(F.coalesce(sum_money("total_amount"), F.lit(0)).cast("double").alias("total")))


def order_hour(orders: DataFrame, date: str) -> DataFrame:
    """Order amount per ``create_hour`` of ``date``."""
    return (on_date(orders, "create_date", date).groupBy("create_hour")
            .agg(sum_money("total_amount").cast("double").alias("amount")))


def hours24(spark: SparkSession) -> DataFrame:
    """The 24 hours ``00``..``23`` as text."""
    return spark.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hour"))


def fill_hours(spark: SparkSession, df: DataFrame, hour_col: str, values: dict) -> DataFrame:
    """Every hour present: the 24 hours joined with ``df`` (one row per hour), ``values`` defaults
    filled (a default of None stays NULL). Rows of ``df`` whose hour is none of the 24 (NULL, ``25``)
    are kept as rows of their own, so no amount is lost."""
    joined = hours24(spark).join(df.withColumnRenamed(hour_col, "hour"), "hour", "full")
    return joined.select("hour", *[F.col(c) if v is None else F.coalesce(F.col(c), F.lit(v)).alias(c)
                                   for c, v in values.items()])


def hour_text(c: str) -> F.Column:
    """An hour as ``HH``: a single digit gets its zero, anything else stays."""
    return F.when(F.col(c).rlike("^[0-9]$"), F.lpad(c, 2, "0")).otherwise(F.col(c))


def hour_compare(spark: SparkSession, df: DataFrame, date_col: str, hour_col: str, date: str,
                 amount: str | None = None, fill: bool = True) -> DataFrame:
    """One scan for ``date`` and the day before: ``hour, yesterday, today`` for all 24 hours.

    Counts rows when ``amount`` is None, else sums it (decimal, reported as double). Hours
    without rows are 0, or NULL with ``fill=False``, which tells them from a real sum of 0.
    """
    y = previous_day(date)
    scoped = df.where(F.col(date_col).isin(y, date))
    is_y, is_t = F.col(date_col) == y, F.col(date_col) == date
    if amount is None:
        agg = scoped.groupBy(hour_text(hour_col).alias("hour")).agg(
            F.nullif(F.count_if(is_y), F.lit(0)).alias("yesterday"), F.nullif(F.count_if(is_t), F.lit(0)).alias("today"))
        return fill_hours(spark, agg, "hour", dict.fromkeys(("yesterday", "today"), 0 if fill else None))
    a = F.col(amount).cast("decimal(18,2)")
    agg = scoped.groupBy(hour_text(hour_col).alias("hour")).agg(
        F.sum(F.when(is_y, a)).cast("double").alias("yesterday"),
        F.sum(F.when(is_t, a)).cast("double").alias("today"))
    return fill_hours(spark, agg, "hour", dict.fromkeys(("yesterday", "today"), 0.0 if fill else None))


def realtime_hour(spark: SparkSession, kpi_id: str, date: str, dau: DataFrame | None = None,
                  orders: DataFrame | None = None, fill: bool = True) -> DataFrame:
    """Hourly series of today and yesterday for KPI ``dau`` or ``order_amount``."""
    if kpi_id == "dau":
        return hour_compare(spark, dau, "log_date", "log_hour", date, fill=fill)
    if kpi_id == "order_amount":
        return hour_compare(spark, orders, "create_date", "create_hour", date, amount="total_amount", fill=fill)
    raise ValueError(f"unknown KPI id {kpi_id!r}")


def new_devices(logs: DataFrame, date: str | None = None) -> DataFrame:
    """Devices whose first log day is that day: ``log_date, n`` (one row per first day).

    With ``date``, only days up to it are read and only that day is returned.
    """
    src = logs.where(F.col("log_date") <= date) if date else logs
    first = src.where(F.col("mid").isNotNull()).groupBy("mid").agg(F.min("log_date").alias("log_date"))
    if date:
        first = first.where(F.col("log_date") == date)
    return first.groupBy("log_date").agg(F.count(F.lit(1)).alias("n"))


def new_device_total(logs: DataFrame, date: str) -> DataFrame:
    return new_devices(logs, date).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))


def realtime_total(dau: DataFrame, logs: DataFrame | None, orders: DataFrame, date: str,
                   order_date: str | None = None, new_mid: DataFrame | None = None) -> DataFrame:
    """KPI cards in fixed order: ``id, name, value`` for dau, new_mid, order_amount.

    New devices come from ``new_mid`` (``total``, see ``streaming.new_device_card``: one day's moves) or, without
    it, from the whole history in ``logs``.
    """
    new_mid = new_device_total(logs, date) if new_mid is None else new_mid
    def card(i, df, col):
        return df.select(F.lit(i).alias("id"), F.lit(KPI_NAMES[i]).alias("name"),
                         F.col(col).cast("double").alias("value"))
    return (card("dau", dau_total(dau, date), "total")
            .unionByName(card("new_mid", new_mid, "total"))
            .unionByName(card("order_amount", order_total(orders, order_date or date), "total")))


def area_sales(orders: DataFrame, date: str | None = None) -> DataFrame:
    """Orders and amount per area (optionally of one day)."""
    src = on_date(orders, "create_date", date) if date else orders
    return src.groupBy("area").agg(F.count(F.lit(1)).alias("orders"),
                                   sum_money("total_amount").cast("double").alias("amount"))


def area_sales_binned(orders: DataFrame, date: str | None = None) -> DataFrame:
    """Orders per area with the map legend bin of that count."""
    src = on_date(orders, "create_date", date) if date else orders
    n = src.groupBy("area").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("bin", value_bin("n"))
