"""Near-duplicate documents by b-bit MinHash (operator 6).

A document is its set of distinct word shingles. HASHES minima are taken of every set; bands
of ROWS minima make candidate buckets (at a similarity of 0.8 a pair misses every bucket with
a chance of 3e-6). Only the low BITS bits of each minimum are kept, packed to one signature;
equal positions are counted on the bits of two signatures and the count is corrected for the
chance collisions, 2**-BITS of the other positions. Pairs whose estimate is five standard
errors below the threshold are dropped; every other pair is confirmed on the full sets.

Documents with the same set are one node, so copies make no pairs. A small bucket emits its
pairs, which are confirmed by a join with the sets. A larger one only ties its members to its
first: what such ties connect is a cluster, cut into blocks of BLOCK documents by a hash; a task
gets two blocks with their full sets, counts all shared shingles by matrix products, and returns
a spanning forest of the links. So every pair of a cluster is compared on full sets, none is emitted,
and no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from storepulse.llm.common import components, forest, record_batch, slices, stored, worker_tables

HASHES, ROWS, BITS = 96, 4, 2
BANDS = HASHES // ROWS
#: Buckets up to this size emit their pairs; documents of a cluster that are compared in one task with as many others.
SMALL, BLOCK = 8, 1024
_rng = np.random.default_rng(20240611)
_MULT = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space, A-Z lower-cased."""
    words = (text or "").encode().lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(w: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the shingles in order of their place; a shorter text is one shingle, an empty one has none."""
    if not len(w):
        return w
    n = min(words, len(w))
    out = np.full(len(w) - n + 1, n, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + w[k:len(w) - n + 1 + k])
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES minima (uint32) of every non-empty set."""
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    x = np.concatenate(sets)
    out = np.empty((len(sets), HASHES), np.uint32)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(((x * _MULT[k] + _ADD[k]) >> np.uint64(32)).astype(np.uint32), at)
    return out


def packed(mins: np.ndarray) -> np.ndarray:
    """The low bits of the minima, as bytes."""
    bits = (mins[:, :, None] >> np.arange(BITS, dtype=np.uint32)) & 1
    return np.packbits(bits.reshape(len(mins), -1).astype(np.uint8), axis=1)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of packed signatures along the last axis (BITS is 2)."""
    d = a ^ b
    differ = np.bitwise_count((d | (d >> 1)) & 0x55).sum(-1, dtype=np.int32)
    chance = 2.0 ** -BITS
    return ((HASHES - differ) / HASHES - chance) / (1 - chance)


def floor_of(threshold: float) -> float:
    chance = 2.0 ** -BITS
    p = chance + (1 - chance) * threshold
    return threshold - 5 * (p * (1 - p) / HASHES) ** 0.5 / (1 - chance)


def signatures(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, fp, keys, sig) of every row; fp is null for texts without a word."""
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("fp", pa.binary()), ("keys", pa.list_(pa.int64())), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("near copies")
        salt = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                sets = [np.unique(shingles(word_hashes(t), words)) for t in texts[a:b]]
                full = [i for i, s in enumerate(sets) if len(s)]
                fps, keys, sigs = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if full:
                    mins = minima([sets[i] for i in full])
                    bands = np.broadcast_to(salt, (len(full), BANDS)).copy()
                    for r in range(ROWS):
                        bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + mins[:, r::ROWS].astype(np.uint64))
                    low = packed(mins)
                    for j, i in enumerate(full):
                        fps[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                        keys[i] = bands[j].view(np.int64)
                        sigs[i] = low[j].tobytes()
                yield record_batch({"id": ids[a:b], "n_shingles": [len(s) for s in sets], "fp": fps, "keys": keys, "sig": sigs}, schema)

    out = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    return out.mapInArrow(run, "id long, n_shingles long, fp binary, keys array<long>, sig binary")


def _groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Whole buckets of two or more rows from a stream sorted by key; signatures as a matrix."""
    held: list[list[np.ndarray]] = []

    def flush():
        if held and sum(len(h[0]) for h in held) > 1:
            yield int(held[0][0][0]), [np.concatenate([h[i] for h in held]) for i in range(1, width)]

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(width - 1)]
        cols.append(np.frombuffer(b"".join(batch.column(width - 1).to_pylist()), np.uint8).reshape(batch.num_rows, -1))
        edge = np.flatnonzero(cols[0][1:] != cols[0][:-1]) + 1
        starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [batch.num_rows]])
        if held and held[0][0][0] != cols[0][0]:
            yield from flush()
            held = []
        for s, e in zip(starts[:-1].tolist(), ends[:-1].tolist()):
            if held:
                held.append([c[s:e] for c in cols])
                yield from flush()
                held = []
            elif e - s > 1:
                yield int(cols[0][s]), [c[s:e] for c in cols[1:]]
        held.append([c[starts[-1]:] for c in cols])
    yield from flush()


def _pairs(rows: DataFrame, least: float) -> DataFrame:
    """(a, b, tie) from bucket rows sorted by key: candidate pairs of small buckets, ties of large ones to their first member."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for _, (ids, sigs) in _groups(batches, 3):
            n = len(ids)
            if n <= SMALL:
                i, j = np.triu_indices(n, 1)
                ok = estimate(sigs[i], sigs[j]) >= least
                i, j = i[ok], j[ok]
            else:
                j = np.arange(1, n)
                i = np.zeros(len(j), int)
            out.append((ids[i], ids[j], np.full(len(i), n > SMALL)))
            size += len(i)
            if size > 100_000:
                yield _batch(out)
                out, size = [], 0
        if out:
            yield _batch(out)

    def _batch(out: list) -> pa.RecordBatch:
        a, b, tie = (np.concatenate(c) for c in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(tie)], names=["a", "b", "tie"])

    return rows.mapInArrow(run, "a long, b long, tie boolean")


def shared_counts(a: list[np.ndarray], b: list[np.ndarray], width: int = 1 << 13) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all of ``b``, by products of 0/1 matrices ``width`` shingles at a time."""
    values = np.concatenate(a + b)
    row = np.repeat(np.arange(len(a) + len(b)), [len(s) for s in a + b])
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    column, count = np.cumsum(new) - 1, np.diff(np.append(np.flatnonzero(new), len(values)))
    keep = count[column] > 1  # a shingle of one set is shared with none
    row, column = row[keep], np.unique(column[keep], return_inverse=True)[1]
    total = np.zeros((len(a), len(b)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        here = slice(*np.searchsorted(column, [start, start + width]))
        m = np.zeros((len(a) + len(b), width), np.float32)
        m[row[here], column[here] - start] = 1
        total += m[:len(a)] @ m[len(a):].T
    return total


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """``rows`` (id, text, more columns) with the text replaced by the sorted hashes of its shingles, ``s``."""
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text") + ", s binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != "text"]
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                part = batch.slice(a, b - a)
                s = pa.array([np.unique(shingles(word_hashes(t), words)).tobytes() for t in texts[a:b]], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [s], names=names + ["s"])

    return rows.mapInArrow(run, out)


def _clustered(ties: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) inside the clusters that ``ties`` connect: a spanning forest from each pair of blocks."""
    clusters = components(ties)
    sizes = clusters.groupBy("component").agg(F.count("*").alias("n")).select("component", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    dealt = clusters.join(sizes, "component").select(F.col("node").alias("id"), "component", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    sets = stored(_sets(dealt.join(docs, "id").select("id", "component", "blocks", "block", "text"), words), "sets")
    met = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("id", "s", "component", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    def compare(key, rows):
        block = rows.column("block").to_numpy()
        ids = rows.column("id").to_numpy()
        s = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("s")]
        lo, hi = np.flatnonzero(block == key[1].as_py()), np.flatnonzero(block == key[2].as_py())
        if not len(lo) or not len(hi):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        both = shared_counts([s[i] for i in lo], [s[i] for i in hi])
        n = np.array([len(x) for x in s], np.float64)
        i, j = np.nonzero(100 * both >= percent * (n[lo][:, None] + n[hi][None] - both))
        pairs = forest(ids[lo[i]], ids[hi[j]])
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})

    return met.groupBy("component", "lo", "hi").applyInArrow(compare, "a long, b long")


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "pairs")
    used = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, keep = batch.column(0).to_numpy(), batch.column(1).to_numpy(), np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep], pa.int64()), pa.array(b[keep], pa.int64())], names=["a", "b"])

    of = stored(_sets(docs.join(used, "id", "left_semi").select("id", "text"), words), "sets")
    left, right = of.select(F.col("id").alias("a"), F.col("s").alias("x")), of.select(F.col("id").alias("b"), F.col("s").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _classes(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """(id, n_shingles, component) of rows (id, text) whose id has one text: the smallest id reachable over links."""
    least = floor_of(percent / 100)
    sig = stored(signatures(rows, words, "id", "text"), "signatures")
    real = sig.where("id is not null and fp is not null")
    reps = real.groupBy("fp").agg(F.min("id").alias("rep"))
    nodes = real.join(reps, (real["fp"] == reps["fp"]) & (real["id"] == reps["rep"]), "left_semi").dropDuplicates(["id", "fp"])
    bands = nodes.select(F.explode("keys").alias("key"), "id", "sig")
    dealt = bands.repartition("key").sortWithinPartitions("key", "id")
    found = stored(_pairs(dealt, least).distinct(), "candidates")
    # rows that repeat an id and its text would be repeated in its links
    links = _confirmed(found.where("not tie"), rows, words, percent).unionByName(_clustered(found.where("tie"), rows, words, percent))
    comps = stored(components(links), "components")
    # a document's class is that of its set's first document
    out = sig.join(reps, "fp", "left").withColumn("node", F.coalesce("rep", "id"))
    out = out.select("id", "n_shingles", "node").join(comps, "node", "left")
    return out.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "node")).alias("component"))


def _ids_of_texts(rows: DataFrame) -> DataFrame | None:
    """(id, text_hash, node) of every text of an id that has several, None if no id has: the text with the smallest hash keeps the id as its node."""
    hashes = rows.where("id is not null").select("id", F.xxhash64("text").alias("text_hash"))
    several = hashes.groupBy("id").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high")).where("low < high")
    texts = stored(hashes.join(several.select("id", "low"), "id").distinct(), "texts")
    if texts.isEmpty():
        return None
    below = rows.agg(F.min("id")).first()[0] - 1  # new ids lie below all others
    node = F.when(F.col("text_hash") == F.col("low"), F.col("id")).otherwise(F.lit(below) - F.monotonically_increasing_id())
    return stored(texts.select("id", "text_hash", node.alias("node")), "nodes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
                    by_text: bool = False) -> DataFrame:
    """(``id_col``, n_shingles, component_id, kept): classes of documents linked by sets that share ``percent`` of their union.

    One row per input row; ``component_id`` is the smallest id of the class. Null or empty texts and texts of white
    space have no shingles and no links. Rows with a null id have no links, a null component and are kept. A document
    is an id and a text: rows that repeat both are one document, the texts of an id that has several are
    documents of their own (told apart by a 64-bit hash), each in its own text's class. An empty table gives an
    empty result.

    With ``by_text`` also ``text_hash``, the xxhash64 of the row's text where its id has several (else null), and
    ``first``: whether the row's document is the one that stands for its class, the only one of it, while several texts of
    the smallest id in one class are all ``kept``.
    """
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    nodes = _ids_of_texts(rows)
    if nodes is None:
        out = _classes(rows, words, percent).select("id", "n_shingles", "component", F.lit(None).cast("long").alias("text_hash"),
                                                    F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("first"))
    else:
        named = rows.withColumn("text_hash", F.xxhash64("text")).join(nodes, ["id", "text_hash"], "left")
        out = stored(_classes(named.select(F.coalesce("node", "id").alias("id"), "text"), words, percent), "classes")
        out = out.withColumnRenamed("id", "node").join(nodes, "node", "left").withColumn("id", F.coalesce("id", "node"))
        heads = out.where("component is not null").groupBy("component").agg(F.min(F.struct("id", F.col("node").alias("head_node"))).alias("head"))
        out = out.join(heads, "component", "left").select("id", "n_shingles", F.col("head.id").alias("component"), "text_hash",
                                                          F.coalesce(F.col("node") == F.col("head.head_node"), F.lit(True)).alias("first"))
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept")
    more = ["text_hash", "first"] if by_text else []
    return out.select(F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"), kept, *more)
