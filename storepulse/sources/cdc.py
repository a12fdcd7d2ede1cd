"""Database change records: envelopes, insert filter, rows to camelCase messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonio import parse_json
from ..functions.scalars import camel_case
from ..schemas import CDC_ENVELOPE, ORDER_FIELDS
from .logs import topic_stream

# The entry type that carries row data, the watched table and event.
ROW_DATA = "ROWDATA"
ORDER_TABLE = "order_info"
INSERT = "INSERT"


# Names of this shape keep apart as camelCase, so only others need comparing after the change.
_PLAIN_NAME = "^[a-z][a-z0-9]*(_[a-z][a-z0-9]*)*$"
MESSAGES, REFUSED, IGNORED = "messages", "refused", "ignored"


def parse_envelope(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON change envelope -> ``entry_type, table, type, rows`` (+ ``_corrupt``)."""
    return parse_json(df, CDC_ENVELOPE, value, keep=keep)


def cdc_stream(spark: SparkSession, path_or_topic: str, kafka: dict | None = None,
               max_files: int | None = None) -> DataFrame:
    """Streaming change envelopes as text (``value``), every one of them. ``max_files`` (or Kafka's
    ``maxOffsetsPerTrigger``) bounds a micro-batch like the poll size did."""
    return topic_stream(spark, path_or_topic, kafka, max_files)


def message_name(column) -> Column:
    """The camelCase name of a column: looked up for the order table's own, worked out for others."""
    known = F.create_map(*[F.lit(x) for n in ORDER_FIELDS for x in (_snake(n), n)])
    return F.coalesce(F.try_element_at(known, column), camel_case(column))


def _snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name)


def outcome(table: str = ORDER_TABLE) -> Column:
    """What becomes of an envelope: ``messages`` (a row-data insert of ``table``), ``ignored`` (another entry,
    table or event) or ``refused``: no JSON, no entry type, or an insert whose rows are no records, i.e. missing,
    null, or with a column name that is missing or doubled."""
    insert = (F.col("entry_type") == ROW_DATA) & (F.col("table") == table) & (F.col("type") == INSERT)
    doubled = lambda names: F.size(F.array_distinct(names)) < F.size(names)
    names = lambda row: F.transform(row, lambda c: c["name"])
    odd = lambda row: (row.isNull() | F.exists(row, lambda c: c["name"].isNull()) | doubled(names(row))
                       | (F.exists(row, lambda c: ~c["name"].rlike(_PLAIN_NAME)) & doubled(F.transform(names(row), message_name))))
    no_records = F.col("rows").isNull() | F.coalesce(F.exists("rows", odd), F.lit(True))
    nameless = (F.col("entry_type") == ROW_DATA) & (F.col("table").isNull() | F.col("type").isNull())
    return (F.when(F.col("_corrupt").isNotNull() | F.col("entry_type").isNull() | nameless, REFUSED)
            .when(~insert, IGNORED).when(no_records, REFUSED).otherwise(MESSAGES))


def inserts_only(df: DataFrame, table: str = ORDER_TABLE) -> DataFrame:
    """Row-data entries of ``table`` with event type INSERT (updates, deletes dropped)."""
    return df.where((F.col("entry_type") == ROW_DATA) & (F.col("table") == table)
                    & (F.col("type") == INSERT))


def cdc_to_rows(df: DataFrame) -> DataFrame:
    """One row per changed row: ``row`` = map of lowerCamel column name -> text value
    (after-image; column order kept)."""
    return (df.select(F.explode("rows").alias("cols"))
              .select(F.transform_keys(F.map_from_entries("cols"), lambda k, v: message_name(k))
                      .alias("row")))


def cdc_to_messages(df: DataFrame) -> DataFrame:
    """Inserted order rows as JSON messages (``value``), one per row."""
    return cdc_to_rows(inserts_only(df)).select(F.to_json("row").alias("value"))
