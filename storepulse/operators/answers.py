"""The dashboard's JSON answers in the service's shapes.

KPI list: ``[{"id", "name", "value"}, ...]`` in card order; hourly comparison:
``{"yesterday": {"HH": v}, "today": {"HH": v}}`` with hours that have no data (NULL) left
out (the chart fills them); a real sum of 0 stays. Both collect a bounded number of rows (3 cards, 24 hours).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kpi_list_json(cards: DataFrame) -> DataFrame:
    """``json`` = the KPI cards (``id, name, value``) as one JSON array, dau first."""
    order = F.when(F.col("id") == "dau", 0).when(F.col("id") == "new_mid", 1).otherwise(2)
    items = F.sort_array(F.collect_list(F.struct(order.alias("o"), F.struct("id", "name", "value").alias("c"))))
    return cards.agg(F.to_json(F.transform(items, lambda x: x["c"])).alias("json"))


def hour_maps_json(compare: DataFrame, hour: str = "hour") -> DataFrame:
    """``json`` = ``{"yesterday": {HH: v}, "today": {HH: v}}`` from an hourly comparison
    (``hour, yesterday, today``, made with ``fill=False``); NULL is "no data" and left out."""
    def day_map(c):
        entries = F.collect_list(F.when(F.col(c).isNotNull() & F.col(hour).isNotNull(), F.struct(F.col(hour).alias("k"), F.col(c).alias("v"))))
        return F.map_from_entries(F.array_sort(entries))
    return compare.agg(F.to_json(F.struct(day_map("yesterday").alias("yesterday"),
                                          day_map("today").alias("today"))).alias("json"))
