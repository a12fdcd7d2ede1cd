"""Column expressions (all JVM-side built-ins; no Python UDFs)."""

from .scalars import (add_create_time, add_log_time, age_band, camel_case, camel_columns,
                      epoch_ms_parts, mask_tel, pct1, previous_day, previous_day_col, value_bin)
from .text import has_term, keyword_terms, match_all, term_count, token_count, tokens
from .jsonio import as_json, parse_json, to_message

__all__ = [
    "add_create_time", "add_log_time", "age_band", "camel_case", "camel_columns", "epoch_ms_parts",
    "mask_tel", "pct1", "previous_day", "previous_day_col", "value_bin", "has_term", "keyword_terms",
    "match_all", "term_count", "token_count", "tokens", "as_json", "parse_json", "to_message",
]
