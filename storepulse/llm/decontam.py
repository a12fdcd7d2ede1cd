"""Benchmark decontamination by Wu-Manber multi-pattern search (operator 8).

Texts are sequences of words. A pattern is a window of WINDOW consecutive words of a
benchmark item (a shorter item is one pattern). For patterns of one length m the scan looks
at the block of the last two words of the next m words: the shift table says how far the
nearest pattern could still end, so most words are never looked at; a shift of 0 leads to
the bucket of patterns with that suffix, and the m words are compared with them directly.
Patterns of other lengths have tables of their own, so short items don't shorten the shifts.

Benchmark items are cut into rounds of at most ROUND_WINDOWS windows, which bounds the
tables that a task holds; each round scans all documents and adds its finds, so a larger
benchmark takes more rounds, not more memory.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from storepulse.llm.common import fresh, slices, stored

WINDOW = 10
ROUND_WINDOWS = 400_000
#: Words on UTF-8 bytes: digits, lower-case ASCII letters and everything beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().lower())  # bytes.lower() touches A-Z only


class Tables:
    """Shift tables and suffix buckets for patterns, by length."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.lengths: dict[int, tuple[dict, dict]] = {}
        patterns: dict[int, dict[tuple, list]] = defaultdict(lambda: defaultdict(list))
        for item, text in items:
            w = words_of(text)
            m = min(WINDOW, len(w))
            for i in range(len(w) - m + 1 if m else 0):
                patterns[m][tuple(w[i:i + m])].append(item)
        for m, found in patterns.items():
            block = min(2, m)
            shift: dict[tuple, int] = {}
            buckets: dict[tuple, list] = defaultdict(list)
            for p, owners in found.items():
                for end in range(block, m + 1):
                    key = p[end - block:end]
                    shift[key] = min(shift.get(key, m), m - end)
                buckets[p[m - block:]].append((p, sorted(set(owners))))
            self.lengths[m] = (shift, dict(buckets))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans of words inside occurrences, and the items that occur."""
        spans, items = [], set()
        for m, (shift, buckets) in self.lengths.items():
            block = min(2, m)
            most, n, end = m - block + 1, len(words), m
            while end <= n:
                key = tuple(words[end - block:end])
                step = shift.get(key, most)
                if step:
                    end += step
                    continue
                seen = tuple(words[end - m:end])
                for p, owners in buckets.get(key, ()):
                    if p == seen:
                        spans.append((end - m, end))
                        items.update(owners)
                end += 1
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _rounds(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list]:
    """Items in rounds of bounded size; the items' sizes, not their texts, decide the rounds."""
    items = benchmark.select(benchmark[item_col].cast("string").alias("item"), benchmark[text_col].alias("text"))
    weight = F.coalesce(F.length("text"), F.lit(0)) + 1  # at least as many characters as windows
    part = items.select("item", "text", F.xxhash64("item", "text").alias("h"), weight.alias("w"))
    total = part.agg(F.sum("w")).first()[0] or 0
    n = -(-int(total) // ROUND_WINDOWS)
    if n <= 1:
        yield [(r.item, r.text) for r in items.collect()]  # at most ROUND_WINDOWS characters
        return
    part = stored(part.withColumn("round", F.pmod("h", F.lit(n))), "items")
    for k in range(n):
        yield [(r.item, r.text) for r in part.where(F.col("round") == k).select("item", "text").collect()]


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(``keep`` columns or ``id_col``, n_words, spans, items): occurrences of benchmark windows in every whole text.

    ``spans`` are the merged [from, to) word ranges inside occurrences, ``items`` the sorted ids as
    strings. Null or empty texts have no words; items without words never occur; null item ids
    are listed as ''. One row per input row, repeated rows included; an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    keep = [id_col] if keep is None else keep
    made = ("n_words", "spans", "items")
    if set(made).intersection(keep):
        raise ValueError(f"rename columns named as the results first: {sorted(set(made).intersection(keep))}")
    fields = [f for f in docs.schema.fields if f.name in keep]
    body = fresh("text_to_read", [*docs.columns, *made])
    now = docs.select([F.col(f.name) for f in fields] + [docs[text_col].alias(body), F.lit(0).cast("long").alias("n_words"),
                      F.array().cast("array<struct<a:int,b:int>>").alias("spans"), F.array().cast("array<string>").alias("items")])
    schema = now.schema
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    for k, items in enumerate(_rounds(benchmark, item_col, item_text_col)):
        if k:
            now = stored(now, "hits")
        tables = spark.sparkContext.broadcast(items)  # bounded by ROUND_WINDOWS

        def run(batches: Iterator[pa.RecordBatch], tables=tables) -> Iterator[pa.RecordBatch]:
            t = Tables([(i or "", x) for i, x in tables.value])
            for batch in batches:
                texts = batch.column(body).to_pylist()
                for a, b in slices(texts):
                    part = batch.slice(a, b - a)
                    old_spans, old_items = part.column("spans").to_pylist(), part.column("items").to_pylist()
                    counts, spans, found = [], [], []
                    for text, s, i in zip(texts[a:b], old_spans, old_items):
                        w = words_of(text)
                        more, own = t.scan(w)
                        counts.append(len(w))
                        spans.append([{"a": x, "b": y} for x, y in merged([(p["a"], p["b"]) for p in s] + more)])
                        found.append(sorted(own.union(i)))
                    cols = [part.column(f.name) for f in fields] + [part.column(body), pa.array(counts, pa.int64()),
                                                                    pa.array(spans, kind), pa.array(found, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields] + [body, *made])

        now = now.mapInArrow(run, schema)
    return now.drop(body)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **columns) -> DataFrame:
    """(``id_col``, n_words, n_hit, n_items, items_sha256, contaminated) of :func:`find`."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"])
    return find(docs, benchmark, id_col, **columns).select(
        id_col, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
