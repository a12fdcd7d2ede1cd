"""First record per key, and dropping records already seen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """Keep the first row of each key by ``order`` (a total order gives a deterministic row).

    Planned as ``row_number() = 1``: Spark inserts a partial WindowGroupLimit before the
    shuffle, so each map task sends at most one row per key (a hot key costs one row per
    task, not a third of the table), and a final one after it.
    """
    keys, order = list(keys), list(order)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def checked_broadcast(df: DataFrame, max_rows: int | None, bound: DataFrame | None = None) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows; otherwise leave the
    choice to the planner (sort-merge join, or AQE's runtime switch).

    ``bound``: a cheaper DataFrame whose row count is an upper bound of ``df``'s (e.g. the
    dimension table a lookup join starts from). The count is one extra job; on a Parquet
    read it is answered from file footers.
    """
    if max_rows is None:
        return df
    return F.broadcast(df) if (bound if bound is not None else df).count() <= max_rows else df


def drop_seen(batch: DataFrame, seen: DataFrame, keys=("log_date", "mid"),
              broadcast_max_rows: int | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``seen`` (left anti join on all ``keys``).

    Rows with a NULL key are dropped first: they could never match and would otherwise
    pass as new every time.
    """
    keys = list(keys)
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    right = checked_broadcast(seen.select(*keys).where(not_null), broadcast_max_rows)
    return batch.where(not_null).join(right, keys, "left_anti")
