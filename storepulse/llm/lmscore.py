"""Language-model scoring by cross-entropy difference (operator 7).

Two bigram models, one of the target documents and one of the background, share one
vocabulary: the words of all documents. A word is the 63-bit hash of its bytes, and every word and
bigram has a count of its own however many there are. A bigram backs off to its word, a word to the
uniform share. Per token the loss is the negative log probability; a document's score is its mean
loss under the target model less its mean loss under the background model, so the smaller, the more
it reads like the target.

``matched`` scales the background's counts to the target's number of tokens: the models are as large as
one another, and the background is what a sample of that size holds on average, from all of its rows.
``leave_out`` takes a document's own counts from the model that holds it, so none is scored by itself.

Three passes read the texts. The first counts the words; those that make one token in HOT or more, at most HOT of them, are
hot. The second counts bigrams of two hot words, HOT * HOT at most, which are scored where the text is
read. In the third every other bigram goes to the shard of its word, or of the word before where the word itself is hot:
it travels once, in packed columns, and is counted and scored there. So a key of a shard is never more than one token in HOT;
a shard has SHARD_TOKENS tokens on average, and what it returns are packed sums for
each slice of texts that it met, by the place of the document. Frequent words, KNOWN at
most, travel by their number instead of their hash. Texts are joined with their side once and kept packed for all passes.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from storepulse.llm.common import stored
from storepulse.llm.minhash import mix

#: Weight of the back-off distribution, in occurrences.
BACK_OFF = 4.0
#: A word with one token in so many is hot; at most so many are.
HOT = 1024
#: Tokens of a shard on average, and words a task counts before it passes them on.
SHARD_TOKENS, HELD_WORDS = 1 << 21, 1 << 21
#: Bytes of texts that are read at once.
SLICE = 1 << 22
#: Frequent words that are numbered, at the most (2 MB).
KNOWN = 1 << 18
#: Losses are added as whole numbers of this part, so sums don't depend on their order.
UNIT = 2.0 ** -30
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_COLUMNS = ("lengths", "docs", "target", "words", "n_words", "contexts", "context", "doc", "n", "last",
            "hot", "hot_contexts", "hot_context", "hot_doc", "hot_n", "hot_own")
_SORTED = ("words", "contexts", "hot_contexts")


def word_ids(text: bytes | None) -> np.ndarray:
    """Hashes of the words in order; 0 is kept for the start of a text."""
    words = _WORD.findall((text or b"").lower())
    return np.maximum(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) >> np.uint64(1), np.uint64(1))


def _tokens(packed: list) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, lengths, words) of slices of packed texts of about SLICE bytes, one text at least."""
    open_ = zstandard.ZstdDecompressor()
    size = np.array([0 if t is None else zstandard.frame_content_size(t) for t in packed], np.int64)
    part = (np.cumsum(size) - size) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(packed)]
    for a, b in zip(cuts, cuts[1:]):
        if a == b:
            continue
        each = [word_ids(t if t is None else open_.decompress(t)) for t in packed[a:b]]
        yield a, b, np.array([len(x) for x in each], np.int64), np.concatenate(each)


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by ``columns`` (the last first), where a new value begins in it, and the number of every row's value."""
    order = np.lexsort(columns) if len(columns) > 1 else np.argsort(columns[0], kind="stable")
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), of


def _sums(values: np.ndarray, order: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values[order], at, axis=0) if len(at) else values[:0]


def _sides(n: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``n`` as the column of its side, zero in the other."""
    out = np.zeros((len(n), 2), np.int64)
    out[np.arange(len(n)), np.where(target, 0, 1)] = n
    return out


def _add(total: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    for k in range(2):
        column = np.zeros(len(total), np.int64)
        np.add.at(column, at, np.ascontiguousarray(values[:, k]))
        total[:, k] += column


def _place(words: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Place of every word among the sorted ``hot`` ones, -1 for others."""
    at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
    return np.where(hot[at] == words, at, -1)


class Model:
    """What every task knows: totals of both sides, and the counts of hot words, their contexts and their pairs."""

    def __init__(self, known: np.ndarray, hot: np.ndarray, words: np.ndarray, pairs: np.ndarray, contexts: np.ndarray, totals: np.ndarray, vocabulary: int, matched: bool, leave_out: bool):
        self.known, self.hot, self.words, self.pairs, self.contexts = known, self.numbers(hot, known), words, pairs, contexts
        self.totals, self.vocabulary, self.leave_out = totals, vocabulary, leave_out
        both = matched and totals.min() > 0
        self.scale = np.array([1.0, totals[0] / totals[1] if both else 1.0])

    @staticmethod
    def numbers(words: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Places of known words among the sorted ``known``; other words keep their hash, the highest bit set."""
        at = _place(words, known)
        return np.where(at >= 0, at.astype(np.uint64), words | np.uint64(1 << 63))

    def _rest(self, counts: np.ndarray, own: np.ndarray, target: np.ndarray) -> np.ndarray:
        return self.scale * (counts - _sides(own, target) if self.leave_out else counts)

    def seen(self, n, pair, word, own_word, length, target) -> np.ndarray:
        """Losses of ``n`` equal bigrams of a document, without their context's part."""
        if not len(n):
            return np.zeros((0, 2), np.int64)
        share = (self._rest(word, own_word, target) + 0.5) / (self._rest(np.broadcast_to(self.totals, word.shape), length, target) + 0.5 * self.vocabulary)
        return np.rint(-n[:, None] * np.log(self._rest(pair, n, target) + BACK_OFF * share) / UNIT).astype(np.int64)

    def context(self, n, counts, target) -> np.ndarray:
        """Losses' part of ``n`` bigrams of a document that share their context."""
        if not len(n):
            return np.zeros((0, 2), np.int64)
        return np.rint(n[:, None] * np.log(self._rest(counts, n, target) + BACK_OFF) / UNIT).astype(np.int64)


def _pack(columns: dict[str, np.ndarray]) -> bytes:
    heads, data = [], []
    for name in _COLUMNS:
        c = columns[name]
        if name in _SORTED:
            c = np.diff(c, prepend=c.dtype.type(0))
        if c.dtype.kind in "iu" and c.dtype.itemsize == 8 and name not in _SORTED:
            c = c.astype(np.uint32) if len(c) == 0 or c.max() < 1 << 32 else c
            if c.dtype == np.uint32 and (len(c) == 0 or c.max() < 1 << 16):
                c = c.astype(np.uint16)
        heads.append(struct.pack("<cBq", c.dtype.kind.encode(), c.dtype.itemsize, len(c)))
        # bytes of one weight together, so that the high ones, mostly zero, take no room
        data.append(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.dtype.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(heads + data))


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    raw, out = zstandard.ZstdDecompressor().decompress(blob), {}
    at = 10 * len(_COLUMNS)
    for k, name in enumerate(_COLUMNS):
        kind, size, n = struct.unpack_from("<cBq", raw, 10 * k)
        c = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T
        c = np.ascontiguousarray(c).view(f"{kind.decode()}{size}").reshape(n)
        out[name] = np.cumsum(c, dtype=c.dtype) if name in _SORTED else c
        at += n * size
    return out


def _packed(rows: DataFrame) -> DataFrame:
    """(id, hash, text) with the text as zstd bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            text = [t if t is None else c.compress(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("hash"), pa.array(text, pa.binary())], names=["id", "hash", "text"])

    return rows.mapInArrow(run, "id long, hash long, text binary")


def word_counts(marked: DataFrame) -> DataFrame:
    """(word, target, background) of every word, summed over all rows of (text, is_target)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)

        def merged(more: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
            w, c = np.concatenate(more), np.concatenate(counts)
            order, at, _ = _runs(w)
            return w[order][at], _sums(c, order, at)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n[:, 0]), pa.array(n[:, 1])], names=["word", "target", "background"])

        for batch in batches:
            texts, target = batch.column("text").to_pylist(), np.array(batch.column("target").to_pylist(), bool)
            for a, b, lengths, ids in _tokens(texts):
                words, n = merged([words, ids], [n, _sides(np.ones(len(ids), np.int64), np.repeat(target[a:b], lengths))])
                if len(words) >= HELD_WORDS:
                    yield out()
                    words, n = words[:0], n[:0]
        if len(words):
            yield out()

    rows = marked.mapInArrow(run, "word long, target long, background long")
    return rows.groupBy("word").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def hot_counts(marked: DataFrame, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts by side of every pair of hot words (square, the context first) and of each as a context."""
    n_hot, shared = len(hot), marked.sparkSession.sparkContext.broadcast(hot)  # HOT + 1 words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_hot * n_hot + n_hot, 2), np.int64)
        for batch in batches:
            texts, target = batch.column("text").to_pylist(), np.array(batch.column("target").to_pylist(), bool)
            for a, b, lengths, ids in _tokens(texts):
                if not len(ids):
                    continue
                at = _place(ids, shared.value)
                before = np.concatenate([[0], at[:-1]])
                before[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0  # the start, word 0, is the first hot one
                good = np.repeat(target[a:b], lengths)
                for side, of in enumerate((good, ~good)):
                    known = of & (before >= 0)
                    total[n_hot * n_hot:, side] += np.bincount(before[known], minlength=n_hot)
                    known &= at >= 0
                    total[:n_hot * n_hot, side] += np.bincount(before[known] * n_hot + at[known], minlength=n_hot * n_hot)
        some = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some, 0]), pa.array(total[some, 1])], names=["place", "target", "background"])

    rows = marked.mapInArrow(run, "place long, target long, background long").groupBy("place").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))
    rows = rows.toArrow()  # (HOT + 1) * (HOT + 2) rows at most
    total = np.zeros((n_hot * n_hot + n_hot, 2), np.int64)
    total[rows.column("place").to_numpy()] = np.stack([rows.column(c).to_numpy() for c in ("target", "background")], 1)
    return total[:n_hot * n_hot].reshape(n_hot, n_hot, 2), total[n_hot * n_hot:]


def _read(m: Model, target: np.ndarray, lengths: np.ndarray, words: np.ndarray, shards: int) -> tuple[np.ndarray, dict[int, bytes]]:
    """What a slice of texts gives: sums by document of all that hot counts decide, and a blob for every shard."""
    n_docs, of = len(lengths), np.repeat(np.arange(len(lengths)), lengths)
    words = m.numbers(words, m.known)
    ends = np.cumsum(lengths)
    before = np.concatenate([np.zeros(1, np.uint64), words[:-1]]) if len(words) else words
    before[(ends - lengths)[lengths > 0]] = 0
    last = np.zeros(len(words), np.int64)
    last[ends[lengths > 0] - 1] = 1
    total = np.zeros((n_docs, 2), np.int64)
    if not len(words):
        return total, {}
    # equal bigrams of a document become one; the last one of a text is no context
    order, at, _ = _runs(before, words, of)
    n, ended = np.diff(np.append(at, len(order))), _sums(last, order, at)
    w, b, doc = (x[order][at] for x in (words, before, of))
    iw, ib = _place(w, m.hot), _place(b, m.hot)
    group = doc * len(m.hot)
    # counts of hot words in their documents, as words and as contexts
    own = np.zeros(len(w), np.int64)
    h = np.flatnonzero(iw >= 0)
    o, s, num = _runs((group + iw)[h])
    own[h] = _sums(n[h], o, s)[num]
    c = np.flatnonzero(ib >= 0)
    o, s, _ = _runs((group + ib)[c])
    first = c[o[s]]
    _add(total, doc[first], m.context(_sums(n[c], o, s), m.contexts[ib[first]], target[doc[first]]))
    h = np.flatnonzero((iw >= 0) & (ib >= 0))
    _add(total, doc[h], m.seen(n[h], m.pairs[ib[h], iw[h]], m.words[iw[h]], own[h], lengths[doc[h]], target[doc[h]]))
    cold = np.flatnonzero((iw < 0) | (ib < 0))
    shard = (mix(np.where(iw < 0, w, b)[cold]) % np.uint64(shards)).astype(np.int64)
    out, order = {}, np.lexsort((w[cold], iw[cold] >= 0, shard))
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1, append=shards))
    for x, y in zip(cuts[:-1], cuts[1:]):
        rows = cold[order[x:y]]
        docs, of_doc = np.unique(doc[rows], return_inverse=True)
        plain = iw[rows] < 0
        r, s = rows[plain], rows[~plain]
        own_words, n_words = np.unique(w[r], return_counts=True)
        contexts, context = np.unique(b[r], return_inverse=True)
        hot_contexts, hot_context = np.unique(b[s], return_inverse=True)
        out[int(shard[order[x]])] = _pack(dict(
            lengths=lengths[docs], docs=docs, target=target[docs].astype(np.uint8), words=own_words, n_words=n_words,
            contexts=contexts, context=context, doc=of_doc[plain], n=n[r], last=ended[r], hot=iw[s], hot_contexts=hot_contexts,
            hot_context=hot_context, hot_doc=of_doc[~plain], hot_n=n[s], hot_own=own[s]))
    return total, out


def _shard(m: Model, blobs: list[bytes]) -> list[bytes]:
    """The bigrams of a shard counted and scored: for every blob, places of documents and what their losses grow by."""
    parts = [_unpack(x) for x in blobs]
    shift = np.cumsum([0] + [len(p["docs"]) for p in parts])
    lengths, target = (np.concatenate([p[c] for p in parts]) for c in ("lengths", "target"))
    target, total = target.astype(bool), np.zeros((len(lengths), 2), np.int64)
    lengths = lengths.astype(np.int64)
    w = np.concatenate([np.repeat(p["words"], p["n_words"]) for p in parts])
    b = np.concatenate([p["contexts"][p["context"]] for p in parts])
    doc = np.concatenate([p["doc"].astype(np.int64) + k for p, k in zip(parts, shift)])
    n, ended = (np.concatenate([p[c] for p in parts]).astype(np.int64) for c in ("n", "last"))
    mine = target[doc]
    order, at, of_word = _runs(w)
    words = _sums(_sides(n, mine), order, at)
    contexts = _sums(_sides(n - ended, mine), order, at)
    order, at, of_pair = _runs(b, w)
    pairs = _sums(_sides(n, mine), order, at)
    order, at, of_own = _runs(doc, of_word)
    own, follow, first = _sums(n, order, at), _sums(n - ended, order, at), order[at]
    _add(total, doc, m.seen(n, pairs[of_pair], words[of_word], own[of_own], lengths[doc], mine))
    _add(total, doc[first], m.context(follow, contexts[of_word[first]], mine[first]))
    # hot words after one of this shard
    iw = np.concatenate([p["hot"] for p in parts]).astype(np.int64)
    b = np.concatenate([p["hot_contexts"][p["hot_context"]] for p in parts])
    doc = np.concatenate([p["hot_doc"].astype(np.int64) + k for p, k in zip(parts, shift)])
    n, own = (np.concatenate([p[c] for p in parts]).astype(np.int64) for c in ("hot_n", "hot_own"))
    order, at, of_pair = _runs(b, iw)
    pairs = _sums(_sides(n, target[doc]), order, at)
    _add(total, doc, m.seen(n, pairs[of_pair], m.words[iw], own, lengths[doc], target[doc]))
    return [_answer(p["docs"].astype(np.int64), total[a:b]) for p, a, b in zip(parts, shift, shift[1:])]


def _answer(docs: np.ndarray, total: np.ndarray) -> bytes:
    """Places (as steps) and sums, bytes of one weight together."""
    columns = np.stack([np.diff(docs, prepend=0), total[:, 0], total[:, 1]])
    planes = np.ascontiguousarray(columns.view(np.uint8).reshape(3, len(docs), 8).transpose(0, 2, 1))
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _answered(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(3, 8, -1)
    columns = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64).reshape(3, -1)
    return np.cumsum(columns[0]), columns[1:].T


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", quality_col: str = "quality",
          matched: bool = False, leave_out: bool = False) -> DataFrame:
    """(``id_col``, n_tokens, loss_target, loss_background, score) of every whole text.

    Target documents have quality 1 in ``labels`` (in any row of their id), all others are background.
    Null texts and texts without words have 0 tokens and null losses. One row per input row; rows with
    null or repeated ids are scored like any other, each a document of its own: ``leave_out`` takes out that row,
    not its copies. Without target or background that model is uniform, and nothing is matched.
    """
    spark = docs.sparkSession
    good = labels.where(labels[quality_col] == 1).select(labels[label_id].cast("long").alias("id"), F.lit(True).alias("target")).distinct()
    plain = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    plain = plain.withColumn("hash", F.xxhash64("id", "text"))
    marked = _packed(plain).join(good.hint("shuffle_hash"), "id", "left").withColumn("target", F.coalesce("target", F.lit(False)))
    marked = stored(marked, "marked")

    words = stored(word_counts(marked), "words")
    size = words.agg(F.count("*"), F.coalesce(F.sum("target"), F.lit(0)), F.coalesce(F.sum("background"), F.lit(0))).first()  # one row
    vocabulary, totals = size[0], np.array([size[1], size[2]], np.int64)
    total = F.col("target") + F.col("background")
    spread = words.groupBy(F.floor(F.log2(total)).alias("power")).count().collect()  # 64 rows at most
    least = min((1 << r.power for r in spread if sum(x["count"] for x in spread if x.power >= r.power) <= KNOWN), default=1 << 62)
    often = words.where(total >= least).toArrow()  # KNOWN rows at most
    known = np.concatenate([np.zeros(1, np.int64), often.column("word").to_numpy()]).view(np.uint64)
    counts = np.concatenate([np.zeros((1, 2), np.int64), np.stack([often.column(c).to_numpy() for c in ("target", "background")], 1)])
    order = np.argsort(known)
    known, counts = known[order], counts[order]
    is_hot = counts.sum(1) * HOT >= totals.sum()
    is_hot[0] = True
    hot, counts = known[is_hot], counts[is_hot]
    pairs, contexts = hot_counts(marked, hot)
    model = spark.sparkContext.broadcast(Model(known, hot, counts, pairs, contexts, totals, vocabulary, matched, leave_out))  # 16 * HOT * HOT bytes at most
    shards = max(1, math.ceil(int(totals.sum()) / SHARD_TOKENS))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("id").fill_null(0).to_numpy(), batch.column("hash").to_numpy()
            texts, target = batch.column("text").to_pylist(), np.array(batch.column("target").to_pylist(), bool)
            for a, b, lengths, words in _tokens(texts):
                total, blobs = _read(model.value, target[a:b], lengths, words, shards)
                sums = b"".join(np.ascontiguousarray(x, np.int64).tobytes() for x in (ids[a:b], hashes[a:b], lengths, total[:, 0], total[:, 1]))
                own, to = xxhash.xxh3_64_intdigest(sums) >> 1, int(hashes[a]) % shards
                for k in sorted({to, *blobs}):
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([own]), pa.array([b - a]), pa.array([blobs.get(k)], pa.binary()),
                                                      pa.array([sums if k == to else None], pa.binary())], names=["shard", "slice", "size", "blob", "sums"])

    def scored(table: pa.Table) -> pa.Table:
        some = table.filter(table.column("blob").is_valid())
        answers = _shard(model.value, some.column("blob").to_pylist()) if some.num_rows else []
        own = table.filter(table.column("sums").is_valid())
        rows = [some.select(["slice", "size"]).append_column("sums", pa.array([None] * some.num_rows, pa.binary())).append_column("answer", pa.array(answers, pa.binary())),
                own.select(["slice", "size", "sums"]).append_column("answer", pa.array([None] * own.num_rows, pa.binary()))]
        return pa.concat_tables(rows)

    def added(table: pa.Table) -> pa.Table:
        """Sums of the documents of a slice; slices of equal rows have equal sums, so they are added together."""
        n, sums = table.column("size")[0].as_py(), [x for x in table.column("sums").to_pylist() if x is not None]
        ids, hashes, lengths, *_ = np.frombuffer(sums[0], np.int64).reshape(5, n)
        total = np.zeros((n, 2), np.int64)
        for x in sums:
            total += np.frombuffer(x, np.int64).reshape(5, n)[3:].T
        for x in table.column("answer").to_pylist():
            if x is not None:
                docs, more = _answered(x)
                total[docs] += more
        columns = (ids, hashes, np.full(n, len(sums)), lengths * len(sums), total[:, 0], total[:, 1])
        return pa.table([pa.array(np.ascontiguousarray(c)) for c in columns], names=["key", "hash", "copies", "n", "target", "background"])

    blobs = marked.mapInArrow(read, "shard int, slice long, size long, blob binary, sums binary").repartition(shards, "shard")
    answers = blobs.groupBy("shard").applyInArrow(scored, "slice long, size long, sums binary, answer binary")
    parts = answers.groupBy("slice").applyInArrow(added, "key long, hash long, copies long, n long, target long, background long")
    sums = parts.groupBy("key", "hash").agg(*[F.sum(c).alias(c) for c in ("copies", "n", "target", "background")])
    some = F.col("n") > 0
    means = sums.select("key", "hash", F.expr("n div copies").alias("n_tokens"), *[
        F.when(some, F.col(c) * F.lit(UNIT) / F.col("n")).alias(f"loss_{c}") for c in ("target", "background")])
    out = marked.select("id", "hash", F.coalesce("id", F.lit(0)).alias("key")).join(means, ["key", "hash"], "left")
    return out.select(F.col("id").alias(id_col), "n_tokens", "loss_target", "loss_background", (F.col("loss_target") - F.col("loss_background")).alias("score"))
