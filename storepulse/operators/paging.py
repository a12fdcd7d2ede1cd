"""Keyset paging: a page begins behind the last row of the page before.

Offset paging to page p keeps p * size rows in every task and merges them in one; behind a cursor a
task keeps ``size`` rows whatever the page, and the cursor's first column prunes row groups.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Key:
    """One column of a page order: ascending with nulls first, or descending with nulls last."""

    column: str
    descending: bool = False

    def order(self) -> Column:
        return F.col(self.column).desc_nulls_last() if self.descending else F.col(self.column).asc_nulls_first()

    def behind(self, value, ties: bool = False) -> Column:
        """Rows that come after ``value`` in this column (with ``ties``: or hold it)."""
        c = F.col(self.column)
        if value is None:
            after = F.lit(False) if self.descending else c.isNotNull()
            return after | c.isNull() if ties else after
        v = F.lit(value)
        if self.descending:
            return (c <= v if ties else c < v) | c.isNull()
        return c >= v if ties else c > v


def after(keys: list[Key], cursor: dict) -> Column:
    """Rows behind ``cursor`` (a value per key) in the order of ``keys``."""
    steps, same = [], []
    for k in keys:
        steps.append(reduce(lambda a, b: a & b, [*same, k.behind(cursor[k.column])]))
        same.append(F.col(k.column).eqNullSafe(F.lit(cursor[k.column])))
    # implied by the rest, but one simple range: it reaches the scan
    return keys[0].behind(cursor[keys[0].column], ties=True) & reduce(lambda a, b: a | b, steps)


def keyset_page(df: DataFrame, keys: list[Key], size: int, cursor: dict | None = None) -> DataFrame:
    """The next ``size`` rows behind ``cursor`` (None: the first page). ``keys`` must be a total order; NaN has no place in it."""
    if size < 0:
        raise ValueError("size must be >= 0")
    rows = df if cursor is None else df.where(after(keys, cursor))
    return rows.orderBy(*[k.order() for k in keys]).limit(size)


def cursor_of(last: Row | None, keys: list[Key]) -> dict | None:
    """The cursor behind a page, from its last row; None where the page was empty."""
    return None if last is None else {k.column: last[k.column] for k in keys}
