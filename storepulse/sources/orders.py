"""Order messages: typed parsing (camelCase wire -> snake_case record) and enrichment."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonio import parse_json
from ..functions.scalars import add_create_time, mask_tel
from ..schemas import ORDER_FIELDS, ORDER_WIRE


def snake(name: str) -> str:
    return re.sub(r"([A-Z])", lambda m: "_" + m.group(1).lower(), name)


def parse_order(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Order JSON -> typed record. Every wire value is text; ``total_amount`` is cast
    safely to double (a quoted or bare number both work; garbage gives NULL)."""
    p = parse_json(df, ORDER_WIRE, value, keep=keep)
    cols = [F.col(n).try_cast("double").alias("total_amount") if n == "totalAmount"
            else F.col(n).alias(snake(n)) for n in ORDER_FIELDS]
    return p.select(*keep, *cols, "_corrupt")


def enrich_order(df: DataFrame, flag: str | None = None) -> DataFrame:
    """Add create date/hour/minute parts and mask ``consignee_tel`` in place."""
    return add_create_time(df, "create_time", flag).withColumn("consignee_tel", mask_tel("consignee_tel"))
