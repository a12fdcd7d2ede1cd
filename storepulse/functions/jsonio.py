"""JSON in and out: typed parsing with a quarantine flag, messages, answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value",
               keep: tuple[str, ...] = (), corrupt: str | None = CORRUPT) -> DataFrame:
    """Parse a JSON text column into the top-level fields of ``schema``.

    PERMISSIVE: a malformed line keeps its text in ``corrupt`` (when given) and NULL fields,
    so callers can route it to a quarantine table instead of failing the batch.
    """
    fields = list(schema.fields)
    opts = {"mode": "PERMISSIVE"}
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType(), True))
        opts["columnNameOfCorruptRecord"] = corrupt
    parsed = F.from_json(F.col(value), T.StructType(fields), opts)
    # ``inline`` of a one-element array makes the parse a Generate node: filters on the
    # parsed fields stay above it, so each line is parsed once (a plain projection lets
    # predicate pushdown inline ``from_json`` into every conjunct).
    return df.select(*keep, F.inline(F.array(parsed)))


def to_message(df: DataFrame, cols: list[str] | None = None, value: str = "value") -> DataFrame:
    """One JSON object per row (NULL fields omitted), in column ``value``."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*cols)).alias(value))


def as_json(df: DataFrame, value: str = "json") -> DataFrame:
    """Whole rows as JSON text (nested structs and arrays kept)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(value))


def json_col(*cols) -> Column:
    return F.to_json(F.struct(*cols))


def once(col: Column, use) -> Column:
    """``use(col)`` with ``col`` worked out once a row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(col), use), 1)


def json_object_field(value: str, fields: str) -> Column:
    """Struct of the given top-level ``fields`` plus ``is_object``: whether the text is one JSON object and nothing else.

    The reader stops at the end of the first value and would accept any text behind it. So the object
    is read as a member of an outer object whose next member holds the text's own checksum: text behind
    the object breaks the outer one, and no text can hold its own checksum to end it early. Of doubled
    keys the last one counts.
    """
    names = [f.split()[0] for f in fields.split(", ")]
    schema = f"v struct<{', '.join(f.replace(' ', ': ') for f in fields.split(', '))}>, end string"
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

    def checked(check: Column) -> Column:
        outer = F.concat(F.lit('{"v":'), F.col(value), F.lit(',"end":"'), check, F.lit('"}'))
        return once(F.from_json(outer, schema, strict), lambda read: once(
            F.coalesce((read["end"] == check) & read["v"].isNotNull(), F.lit(False)),
            lambda ok: F.struct(ok.alias("is_object"), *[F.when(ok, read["v"][n]).alias(n) for n in names])))
    return once(F.md5(F.col(value)), checked)


_SPACE = r"[ \t\n\r]*"


def _opened(masked: Column) -> Column:
    """Brackets opened less brackets closed, strings aside."""
    return once(F.regexp_replace(masked, '"[^"]*"', ""),
                lambda bare: F.regexp_count(bare, F.lit(r"[\[{]")) - F.regexp_count(bare, F.lit(r"[\]}]")))


def splice_member(value: str, key: str, new: Column) -> Column:
    """The JSON object text ``value`` with ``new`` as the value of its top-level ``key``, every other byte as it was.

    A scalar value is replaced where it stands (each one, if the key is doubled). Without the key, or where its last
    value is an object or array, the member is added at the end, where it is the one that counts. ``value`` must be a
    valid object (see :func:`json_object_field`). ``key`` is plain letters; keys spelled with escapes are found too.
    """
    text = F.col(value)
    # Escapes become two characters no valid text holds: quotes are then string ends only, at their old places.
    masked = F.regexp_replace(text, r"\\.", "\x01\x01")
    name = "".join(f"(?:{c}|\x01\x01(?i:{ord(c):04x}))" for c in key)
    member = f'"{name}"{_SPACE}:'
    scalar = rf'^({_SPACE})("[^"]*"|[^ \t\n\r,\[\]{{}}"]+)'

    def step(parts, acc, i):
        before, after = F.element_at(parts["between"], i), F.element_at(parts["between"], i + 1)
        begin = acc["at"] + F.length(before) + F.length(F.element_at(parts["found"], i))  # where the member's value begins
        seen = F.struct((acc["depth"] + _opened(before)).alias("depth"), begin.alias("start"), F.regexp_extract(after, scalar, 0).alias("old"),
                        F.regexp_extract(after, scalar, 1).alias("space"))

        def member_read(m):
            top = m["depth"] == 1
            swap = top & (F.length(m["old"]) > 0)
            upto = F.substr(text, acc["copied"], m["start"] - acc["copied"])
            return F.struct(m["depth"].alias("depth"), m["start"].alias("at"), F.when(swap, m["start"] + F.length(m["old"])).otherwise(acc["copied"]).alias("copied"),
                            F.when(swap, F.concat(acc["out"], upto, m["space"], new)).otherwise(acc["out"]).alias("out"),
                            F.when(top, swap).otherwise(acc["done"]).alias("done"))
        return once(seen, member_read)

    def spliced(parts):
        first = F.struct(F.lit(0).alias("depth"), F.lit(1).alias("at"), F.lit(1).alias("copied"), F.lit("").alias("out"), F.lit(False).alias("done"))
        swapped = F.aggregate(F.sequence(F.lit(1), F.size(parts["found"])), first, lambda acc, i: step(parts, acc, i),
                              lambda acc: F.struct(F.concat(acc["out"], F.substr(text, acc["copied"])).alias("text"), acc["done"].alias("done")))
        swapped = F.when(F.size(parts["found"]) > 0, swapped).otherwise(F.struct(text.alias("text"), F.lit(False).alias("done")))
        comma = F.when(parts["masked"].rlike(rf"^{_SPACE}\{{{_SPACE}\}}{_SPACE}$"), "").otherwise(",")

        def finished(got):
            added = F.regexp_replace(got["text"], F.lit(rf"\}}({_SPACE})$"), F.concat(comma, F.lit(f'"{key}":'), new, F.lit("}$1")))
            return F.when(got["done"], got["text"]).otherwise(added)
        return once(swapped, finished)

    return once(masked, lambda m: once(F.struct(m.alias("masked"), F.split(m, member, -1).alias("between"),
                                                F.regexp_extract_all(m, F.lit(member), F.lit(0)).alias("found")), spliced))
