"""Relational operators of the dashboards, as DataFrame compositions."""

from .answers import hour_maps_json, kpi_list_json
from .dedup import checked_broadcast, drop_seen, first_per_key
from .kpi import (area_sales, area_sales_binned, dau_hour, dau_total, fill_hours, hour_compare,
                  hours24, new_device_total, new_devices, on_date, order_hour, order_total,
                  realtime_hour, realtime_total, sum_money)
from .search import (age_band_share, gender_share, keyword_match, page, rank_bm25, sale_detail,
                     sale_hits, sale_stats, search_total, terms)

__all__ = [
    "hour_maps_json", "kpi_list_json",
    "checked_broadcast", "drop_seen", "first_per_key", "area_sales", "area_sales_binned",
    "dau_hour", "dau_total", "fill_hours", "hour_compare", "hours24", "new_device_total",
    "new_devices", "on_date", "order_hour", "order_total", "realtime_hour", "realtime_total",
    "sum_money", "age_band_share", "gender_share", "keyword_match", "page", "rank_bm25",
    "sale_detail", "sale_hits", "sale_stats", "search_total", "terms",
]
