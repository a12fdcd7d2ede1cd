"""Licence scans by sparse TF-IDF cosine and nearest-ancestor inheritance (operator 5).

Templates are short notices and the openings of licence texts. Terms are their words and
word pairs; a term's weight is its count times the inverse document frequency over all
scanned files. Every window of a file's whole text is compared with every template by cosine,
however long it is and wherever it lies; windows are passed over only where a bound proves that
they cannot reach ``threshold``. A file's own licence is its best window at or above ``threshold``
(ties: the first window, then the first licence by name). The notice goes on behind its window while template words
follow, gaps of one word aside. A file of which the notice is the larger part is a licence file and
speaks for its directory; a file without a
licence of its own takes that of the nearest directory above it that has one, found by joining
the paths of its ancestors.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from storepulse.llm.common import stored

#: Licence names and notices.
TEMPLATES = [
    ("AGPL-3.0", "licensed under the GNU Affero General Public License version 3"),
    ("Apache-2.0", "licensed under the Apache License Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License you may obtain a copy of the License at"),
    ("BSD-2-Clause", "licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("CC-BY-4.0", "licensed under CC BY 4.0"),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "dedicated to the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "licensed under the GNU General Public License version 2"),
    ("GPL-3.0", "this work is licensed under the GNU General Public License version 3"),
    ("ISC", "licensed under the ISC License"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License version 3"),
    ("MIT", "released under the MIT License"),
    ("MIT", "licensed under the MIT License"),
    ("MIT", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "this source code form is subject to the terms of the Mozilla Public License version 2.0"),
    ("Unlicense", "this is free and unencumbered software released into the public domain"),
]
_WORD = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")
#: Words that are no template word but may stand inside the rest of a notice, one at a time.
_GAP = 1


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def terms_of(words: list[str]) -> Counter:
    return Counter(words) + Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


_TERMS = [(name, terms_of(words_of(text))) for name, text in TEMPLATES]
_VOCABULARY = {w for _, t in TEMPLATES for w in words_of(t)}
_ALL_TERMS = sorted({t for _, c in _TERMS for t in c})


def document_frequencies(files: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of files and, for each template term, of files that hold it; over all whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                w = words_of(text)
                own = _VOCABULARY.intersection(w)
                seen.update(own)
                if len(own) > 1:
                    seen.update({f"{a} {b}" for a, b in zip(w, w[1:]) if a in own and b in own}.intersection(_ALL_TERMS))
        yield pa.RecordBatch.from_arrays([pa.array(["", *seen]), pa.array([n, *seen.values()], pa.int64())], names=["term", "n"])

    rows = files.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row per template term
    found = {r.term: r.n for r in rows}
    return found.pop("", 0), found


class Matcher:
    """Finds the window of a text that is closest to a template, among those of cosine ``floor`` and more."""

    def __init__(self, n: int, seen: dict[str, int], floor: float = 0.0):
        self.row = {t: i for i, t in enumerate(_ALL_TERMS)}
        self.other = len(self.row)  # row of all terms of no template, which weigh as if no file held them
        self.weight = np.array([math.log((1 + n) / (1 + seen.get(t, 0))) + 1 for t in _ALL_TERMS] + [math.log(1 + n) + 1])
        unit = np.zeros((self.other + 1, len(_TERMS)))
        for j, (_, terms) in enumerate(_TERMS):
            for t, k in terms.items():
                unit[self.row[t], j] = k * self.weight[self.row[t]]
        unit /= np.sqrt((unit * unit).sum(0))
        self.cover = unit * unit  # share of a template's square that a term is
        self.gain = self.weight[:, None] * unit  # what an occurrence of a term adds to the product with a template
        self.bad = (self.weight * self.weight)[:, None] * (unit == 0)  # the least it adds to the square outside the template
        self.floor = max(floor, 1e-6)

    def scan(self, text: str | None) -> tuple[str | None, float, float]:
        """Licence, cosine and share of the text's words of the best window and the notice behind it."""
        w = words_of(text)
        own = _VOCABULARY.intersection(w)
        if not own:
            return None, 0.0, 0.0
        held = [self.row[t] for t in own.union(f"{a} {b}" for a, b in zip(w, w[1:]) if a in own and b in own) if t in self.row]
        # a cosine is at most the root of the share of the template's square whose terms the text holds
        near = np.flatnonzero(self.cover[held].sum(0) >= self.floor ** 2 - 1e-9)
        if not len(near):
            return None, 0.0, 0.0
        which, c, start, end = self._best(w, near)
        if which is None:
            return None, 0.0, 0.0
        while end < len(w) - 1 and any(x in _VOCABULARY for x in w[end + 1:end + 2 + _GAP]):
            end += 1
        return _TERMS[which][0], c, (end + 1 - start) / len(w)

    def _best(self, w: list[str], near: np.ndarray) -> tuple[int | None, float, int, int]:
        """Template, cosine, first and last word of the best window, by the templates ``near``.

        Sums of occurrences over a window are differences of running sums: the product ``d`` with a template, and ``bad``,
        the least square of the window's terms outside it. cosine ** 2 <= d ** 2 / (d ** 2 + bad), which bounds how far
        a window from each start can reach. Squares of counts are then summed exactly along the windows left.
        """
        n, ids, count = len(w), {}, Counter()
        term, rank = np.zeros((2, n), np.int64), np.zeros((2, n))  # words, and pairs by their last word
        rows = []
        for i, x in enumerate(w):
            for k, t in ((0, x), (1, f"{w[i - 1]} {x}")) if i else ((0, x),):
                if t not in ids:
                    ids[t] = len(ids)
                    rows.append(self.row.get(t, self.other))
                term[k, i], rank[k, i] = ids[t], count[t]
                count[t] += 1
        rows = np.array(rows)
        square = (self.weight * self.weight)[rows]

        def running(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Running sums of words and pairs, and with them what lies before a window from each start."""
            a, b = of[:, near][rows[term[0]]], of[:, near][rows[term[1]]]
            b[0] = 0
            sums = np.concatenate([np.zeros((1, len(near))), np.cumsum(a + b, 0)])
            return sums, sums[:-1] + b

        (gain, gain_at), (bad, bad_at), (cover, cover_at) = running(self.gain), running(self.bad), running(self.cover)
        at, last = np.arange(n), np.full((n, len(near)), n - 1)
        ratio = (1 - self.floor ** 2) / self.floor ** 2 if self.floor < 1 else 0.0
        for j in range(len(near)):
            while True:
                reach = np.maximum(gain[last[:, j] + 1, j] - gain_at[:, j], 0) ** 2 * ratio * (1 + 1e-9) + 1e-9 * (1 + bad[-1, j])
                to = np.minimum(last[:, j], np.maximum(at - 1, np.searchsorted(bad[1:, j], bad_at[:, j] + reach, "right") - 1))
                if (to == last[:, j]).all():
                    break
                last[:, j] = to
            last[cover[last[:, j] + 1, j] - cover_at[:, j] < self.floor ** 2 - 1e-9, j] = -1
        upto = last.max(1)
        best, value, first, final, done, before = None, self.floor - 1e-12, 0, 0, 0, np.zeros(len(ids))
        for s in np.flatnonzero((rows[term[0]] != self.other) & (upto >= at)).tolist():
            np.add.at(before, term[0, done:s], 1)  # words before the window, and pairs up to its first word
            np.add.at(before, term[1, max(done, 1):s], 1)
            done, e = s, int(upto[s]) + 1
            pair = term[1, s] if s else -1
            ranks = rank[:, s:e] - before[term[:, s:e]]
            if s:
                ranks[1, term[1, s:e] == pair] -= 1
            added = square[term[:, s:e]] * (2 * ranks + 1)
            added[1, 0] = 0
            c = (gain[s + 1:e + 1] - gain_at[s]) / np.sqrt(np.cumsum(added.sum(0)))[:, None]
            top = float(c.max())
            if top > value + 1e-12:
                j = int(np.flatnonzero(c.max(0) >= top - 1e-12)[0])
                best, value, first, final = int(near[j]), top, s, s + int(np.flatnonzero(c[:, j] >= top - 1e-12)[0])
                if value >= 1 - 1e-12:  # none is closer
                    break
        return best, min(value, 1.0) if best is not None else 0.0, first, final


def scan(files: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path", threshold: float = 0.7) -> DataFrame:
    """(``id_col``, license, found, score): the licence of every file.

    ``found`` is 'file' (a licence file), 'header' (a notice in the file), 'inherited' (from the nearest
    directory above with a licence file; score is that file's) or 'none' (license null, score 0). Where a
    directory has several licence files the highest score decides, then the name. Null or empty texts
    have no licence of their own; files without a path inherit nothing. One row per input row.
    """
    spark = files.sparkSession
    plain = files.select(files[id_col].cast("long").alias("id"), files[text_col].alias("text"), files[path_col].cast("string").alias("path"))
    shared = spark.sparkContext.broadcast(document_frequencies(plain))  # a count per template term

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(*shared.value, threshold)
        for batch in batches:
            found = [m.scan(t) for t in batch.column(1).to_pylist()]
            own = [(n, c, s) if c >= threshold else (None, 0.0, 0.0) for n, c, s in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([x[0] for x in own], pa.string()), pa.array([x[1] for x in own], pa.float64()),
                                              pa.array([x[2] for x in own], pa.float64())], names=["id", "path", "license", "score", "part"])

    scanned = stored(plain.mapInArrow(run, "id long, path string, license string, score double, part double"), "scanned")
    parts = F.split("path", "/")
    marked = scanned.withColumn("dir", F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/"))
    speaks = marked.where((F.col("part") >= 0.5) & F.col("path").isNotNull()).groupBy("dir").agg(
        F.min(F.struct((-F.col("score")).alias("less"), "license")).alias("best"))
    orphan = F.col("license").isNull() & F.col("path").isNotNull()
    # Neither side of these joins is bounded, and a stored table is far smaller than its rows: no broadcast by its size.
    dirs = marked.where(orphan).select("dir").distinct().withColumn("up", F.split("dir", "/"))
    above = dirs.select(F.col("dir").alias("own"), F.posexplode(F.transform(F.sequence(F.lit(0), F.size("up")), lambda k: F.array_join(F.slice("up", 1, k), "/"))).alias("depth", "dir"))
    nearest = above.join(speaks.hint("merge"), "dir").groupBy(F.col("own").alias("dir")).agg(F.max(F.struct("depth", "best")).alias("near"))
    out = marked.where(orphan).join(nearest.hint("merge"), "dir", "left")
    out = out.unionByName(marked.where(~orphan), allowMissingColumns=True)
    from_above = F.col("license").isNull() & F.col("near").isNotNull()
    return out.select(
        F.col("id").alias(id_col), F.when(from_above, F.col("near.best.license")).otherwise(F.col("license")).alias("license"),
        F.when(from_above, "inherited").when(F.col("license").isNull(), "none").when(F.col("part") >= 0.5, "file").otherwise("header").alias("found"),
        F.round(F.when(from_above, -F.col("near.best.less")).otherwise(F.col("score")), 6).alias("score"))
