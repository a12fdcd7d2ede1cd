"""Scalar column functions: time parts, masking, shares, bands, bins, name casing."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the dashboard's): masking prefix length and text, age band
# edges, legend bins of the sales map (six bins of width 100 over 0..600).
MASK = "*******"
MASK_KEEP_FROM = 8
AGE_EDGES = (20, 30)
AGE_BANDS = ("lt20", "20_29", "ge30")
BIN_LOW, BIN_HIGH, BIN_COUNT = 0, 600, 6

def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_parts(ms, tz: str | None = None) -> tuple[Column, Column, Column]:
    """(yyyy-MM-dd, HH, HH:mm) of an epoch-millisecond column.

    ``tz=None`` formats in the session time zone; a zone id formats there, independent
    of the session (integer arithmetic on a zone-less timestamp, then a zone shift).
    """
    ms = _col(ms)
    if tz is None:
        t = F.timestamp_millis(ms)
    else:
        utc = F.timestamp_add("MILLISECOND", ms, _epoch_ntz())
        t = utc if tz in ("UTC", "Z", "+00:00") else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    return (F.date_format(t, "yyyy-MM-dd"), F.date_format(t, "HH"), F.date_format(t, "HH:mm"))


def add_log_time(df: DataFrame, ts: str = "ts", tz: str | None = None) -> DataFrame:
    """Add ``log_date``, ``log_hour`` (zero padded) and ``log_hour_minute`` from epoch ms."""
    d, h, hm = epoch_ms_parts(ts, tz)
    return df.withColumns({"log_date": d, "log_hour": h, "log_hour_minute": hm})


def add_create_time(df: DataFrame, src: str = "create_time", flag: str | None = None) -> DataFrame:
    """Split ``yyyy-MM-dd HH:mm:ss`` text into ``create_date``, ``create_hour``,
    ``create_hour_minute`` by plain text splitting (no parsing, no zone).

    Text without a time part, or a time without minutes, yields NULL parts; ``flag``
    names an optional boolean column marking such rows for a quarantine table.
    """
    parts = F.split(F.col(src), " ")
    time_parts = F.split(F.try_element_at(parts, F.lit(2)), ":")
    hour = F.try_element_at(time_parts, F.lit(1))
    minute = F.try_element_at(time_parts, F.lit(2))
    ok = hour.isNotNull() & minute.isNotNull()
    cols = {
        "create_date": F.when(ok, F.try_element_at(parts, F.lit(1))),
        "create_hour": F.when(ok, hour),
        "create_hour_minute": F.when(ok, F.concat_ws(":", hour, minute)),
    }
    if flag:
        cols[flag] = ~F.coalesce(ok, F.lit(False))
    return df.withColumns(cols)


def mask_tel(tel) -> Column:
    """Seven stars followed by the characters from the eighth on; NULL stays NULL."""
    tel = _col(tel)
    return F.concat(F.lit(MASK), F.substr(tel, F.lit(MASK_KEEP_FROM)))


def pct1(n, total) -> Column:
    """Share in percent with one decimal, half-up; 0.0 when ``total`` is 0."""
    n, total = _col(n), _col(total)
    return (F.when(total == 0, F.lit(0.0))
            .otherwise(F.floor(n.cast("double") * 1000.0 / total + 0.5) / 10.0))


def age_band(age) -> Column:
    """``lt20`` below 20, ``20_29`` for 20..29, ``ge30`` from 30; NULL for NULL."""
    age = _col(age)
    lo, hi = AGE_EDGES
    return (F.when(age < lo, AGE_BANDS[0]).when(age < hi, AGE_BANDS[1])
            .when(age >= hi, AGE_BANDS[2]))


def value_bin(v) -> Column:
    """Legend bin 1..6 of width 100 over [0, 600); below 0 -> 0, from 600 on -> 7."""
    return F.width_bucket(_col(v), F.lit(BIN_LOW), F.lit(BIN_HIGH), F.lit(BIN_COUNT))


def previous_day(date: str) -> str:
    """``yyyy-MM-dd`` of the day before; raises on text that is not a date."""
    return (_dt.date.fromisoformat(date) - _dt.timedelta(days=1)).isoformat()


def previous_day_col(d) -> Column:
    return F.date_format(F.date_sub(F.to_date(_col(d), "yyyy-MM-dd"), 1), "yyyy-MM-dd")


def camel_case(name) -> Column:
    """lower_underscore -> lowerCamel on a string column (``consignee_tel`` -> ``consigneeTel``)."""
    spaced = F.initcap(F.replace(F.lower(_col(name)), F.lit("_"), F.lit(" ")))
    joined = F.replace(spaced, F.lit(" "), F.lit(""))
    return F.concat(F.lower(F.substr(joined, F.lit(1), F.lit(1))), F.substr(joined, F.lit(2)))


def _camel_py(name: str) -> str:
    words = name.lower().split("_")
    return words[0] + "".join(w[:1].upper() + w[1:] for w in words[1:])


def camel_columns(df: DataFrame) -> DataFrame:
    """Rename every column of ``df`` from lower_underscore to lowerCamel."""
    return df.toDF(*[_camel_py(c) for c in df.columns])
