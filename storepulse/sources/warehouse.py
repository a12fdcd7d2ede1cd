"""Warehouse wide table: one day partition, conformed to the sale record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SALE
from ..session import existing

DEFAULT_DT = "2019-02-01"


def conform(df: DataFrame, schema: T.StructType = SALE) -> DataFrame:
    """Select ``schema``'s fields by name (not position) with safe casts."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def sale_scan(spark: SparkSession, table_or_path: str, dt: str = DEFAULT_DT,
              schema: T.StructType = SALE) -> DataFrame:
    """Rows of partition ``dt`` of a catalog table or a ``dt=``-partitioned Parquet folder.

    Only the day's folder is listed and read. Columns are read with their stored types and
    cast by :func:`conform`; ``dt`` stays a string. A day without a folder has no rows.
    """
    if "/" in table_or_path:
        root = table_or_path.rstrip("/")
        folder = f"{root}/dt={dt}"
        if not existing(spark, [folder]):
            return spark.createDataFrame([], schema)
        stored = spark.read.parquet(folder).schema
        reader = spark.read.schema(T.StructType([*stored.fields, T.StructField("dt", T.StringType())]))
        df = reader.option("basePath", root).parquet(folder)
    else:
        df = spark.table(table_or_path)
    return conform(df.where(F.col("dt") == F.lit(dt)), schema)
