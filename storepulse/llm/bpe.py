"""BPE encoding and decoding by content-defined chunk reuse (operator 10).

A text is cut where a rolling hash over the last bytes says so, so passages that documents
share are cut alike wherever they stand. Every distinct chunk is encoded once per worker
while a bounded table holds it. Cuts are taken only in front of a single space between two
characters that are no white space: the byte-level pattern starts a pre-token there whatever
surrounds it, so the two sides agree with the whole by construction. A cut that the hash
asks for anywhere else is an unproven join; it is repaired before it is made: the two sides
are encoded again as one chunk, which grows until both its ends are proven joins or ends of
the text. Vocabularies of another build (normalizer, other pre-tokenizer) have no proven
joins, so there the chunk grows to the whole text.

Chunks are merged by the rank table of the vocabulary file (tiktoken's merge loop; the file's
merges must be in order of their ids, which is checked), texts with characters whose letter
class could differ between libraries by the ``tokenizers`` library itself.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from storepulse.llm.common import record_batch, slices, worker_tables

#: Bounds of a worker's tables, in entries; a full table is started anew.
MAX_WORDS = 500_000
MAX_CHUNKS = 100_000
#: About every so many'th proven join ends a chunk.
CHUNK_JOINS = 64
#: Fixed value: the byte-level pre-token pattern that the vocabulary files name.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Beyond these blocks letter classes differ between Unicode versions of two libraries; such texts are the library's.
FAR = re.compile("[\u0530-\U0010ffff\x1c-\x1f]")
_ODD = re.compile(r"\s\s")
#: White space beyond ASCII.
_WIDE = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_JOIN = re.compile(r"(?<=\S) (?=\S)")
_WEIGHTS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD6E8FEB9, 0xA5CB9243, 0x7FEB352D], np.uint32)


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from U+0100 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


def odd(texts: list[str]) -> list[bool]:
    """Whether a text may hold white space beside white space or at an end, so that not every space in it is a proven join."""
    if _calm("x".join(texts)) and not any(t[:1].isspace() or t[-1:].isspace() for t in texts):
        return [False] * len(texts)
    return [bool(_ODD.search(t)) or t != t.strip() for t in texts]


def _calm(text: str) -> bool:
    space = np.frombuffer(text.encode(), np.uint8) <= 32
    return not (space[1:] & space[:-1]).any() and (text.isascii() or not any(w in text for w in _WIDE))


def cuts(data: bytes) -> np.ndarray:
    """Starts of chunks: proven joins that a hash of the 8 bytes before them picks."""
    buf = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(buf == 32)
    at = at[(at >= 8) & (at < len(buf) - 1)]
    before, after = buf[at - 1], buf[at + 1]
    ok = (before > 32) & (after > 32) & ~((after == 0xC2) | (after >= 0xE1) & (after <= 0xE3))  # lead bytes of wide white space
    third = buf[at - 3]
    ok &= ~((buf[at - 2] == 0xC2) & ((before == 0x85) | (before == 0xA0))) & ~((third >= 0xE1) & (third <= 0xE3))
    at = at[ok]
    rolled = np.zeros(len(at), np.uint32)
    for k, w in enumerate(_WEIGHTS, 1):
        rolled += buf[at - k] * w
    rolled ^= rolled >> np.uint32(15)
    rolled = (rolled * np.uint32(0x2C1B3C6D)) >> np.uint32(16)
    return at[rolled & np.uint32(CHUNK_JOINS - 1) == 0]


class ChunkCodec:
    """Encodes texts to little-endian uint32 ids and decodes ids, equal to the library's results."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.proven = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                       and not pre.get("add_prefix_space") and (spec.get("post_processor") or {}).get("type") in (None, "ByteLevel")
                       and all(not (t["single_word"] or t["lstrip"] or t["rstrip"]) for t in spec["added_tokens"]))
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = {k: np.uint32(v).tobytes() for k, v in added.items()}
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.words: dict[str, bytes] = {}  # ids of words after a space
        self.again: set[str] = set()  # words met in more than one slice
        self.chunks: dict[bytes, bytes] = {}
        vocab = self.lib.get_vocab(with_added_tokens=True)
        letters = byte_alphabet()
        self.bytes_of = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.spaced = np.array([b[:1] == b" " for b in self.bytes_of])
        self.ranks = self._rank_table(spec) if self.proven else None

    def _rank_table(self, spec: dict):
        """The merge loop over the file's own vocabulary, or None if its merges aren't in order of ids."""
        vocab = spec["model"]["vocab"]
        merged = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "", 1)) for m in spec["model"]["merges"]]
        ranks = {self.bytes_of[i]: i for i in vocab.values() if i not in {t["id"] for t in spec["added_tokens"]}}
        if None in merged or merged != sorted(merged) or len(ranks) < 256 or spec["model"].get("ignore_merges"):
            return None
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _merge(self, texts: list[str]) -> list[bytes]:
        """Ids of chunks without special strings."""
        far = [self.ranks is None or FAR.search(t) is not None for t in texts]
        out = [b"" if f else self.ranks.encode_to_numpy(t, disallowed_special=()).tobytes() for t, f in zip(texts, far)]
        for i, ids in zip([i for i, f in enumerate(far) if f], self._library([t for t, f in zip(texts, far) if f])):
            out[i] = ids
        return out

    def _learn(self, used: set[str]) -> None:
        """Put all of ``used`` into the table of words; if it overflows, words met in two slices stay."""
        new = used.difference(self.words)
        if len(self.words) + len(new) > MAX_WORDS:
            self.words = {w: self.words[w] for w in (self.again | used).intersection(self.words)} if len(self.again) < MAX_WORDS // 2 else {}
            self.again = set()
            new = used.difference(self.words)
        self.again.update(used.difference(new))
        alone = [w for w in new if " " in w or not w]
        self.words.update(zip(alone, self._library([" " + w for w in alone])))
        rest = [w for w in new if w and " " not in w]
        # words joined by proven joins are one text; each begins at the only token that starts with a space
        for a in range(0, len(rest), 256):
            part = rest[a:a + 256]
            ids = self._library([" " + " ".join(part)])[0]
            at = (np.flatnonzero(self.spaced[np.frombuffer(ids, np.uint32)]) * 4).tolist() + [len(ids)]
            self.words.update(zip(part, [ids[x:y] for x, y in zip(at, at[1:])], strict=True))

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """Encode texts without special strings from words cut at proven joins, each met once by the library."""
        split = [_JOIN.split(t) if o else t.split(" ") for t, o in zip(texts, odd(texts))]
        first = list({p[0] for p in split})
        start = dict(zip(first, self._library(first)))
        used: set[str] = set()
        for p in split:
            used.update(p[1:])
        self._learn(used)
        get = self.words.__getitem__
        return [start[p[0]] + b"".join(map(get, p[1:])) for p in split]

    def _segments(self, texts: list[str], encode) -> list[bytes]:
        """Split at special strings, which the library takes out before anything else."""
        flat, shape = [], []
        for t in texts:
            if self.special is not None and self.special.search(t):
                shape.append((len(flat), self.special.findall(t)))
                flat.extend(self.special.split(t))
            else:
                shape.append((len(flat), None))
                flat.append(t)
        ids = encode(flat)
        out = []
        for at, marks in shape:
            part = ids[at]
            for k, mark in enumerate(marks or (), 1):
                part += self.added[mark] + ids[at + k]
            out.append(part)
        return out

    def encode_words(self, texts: list[str]) -> list[bytes]:
        return self._segments(texts, self._by_words) if self.proven else self._library(texts)

    def _by_chunks(self, texts: list[str]) -> list[bytes]:
        if len(self.chunks) > MAX_CHUNKS:
            self.chunks = {}
        coded = [t.encode() for t in texts]
        data = b"\0".join(coded)
        ends = np.cumsum([len(c) + 1 for c in coded])
        cut = cuts(data)
        at = np.sort(np.concatenate([[0], ends, cut]))
        each = [data[a:b] for a, b in zip(at[:-1].tolist(), (at[1:] - np.isin(at[1:], ends)).tolist())]
        new = list(dict.fromkeys(c for c in each if c not in self.chunks))
        self.chunks.update(zip(new, self._merge([c.decode() for c in new])))
        count = np.searchsorted(at, ends).tolist()
        get = self.chunks.__getitem__
        return [b"".join(map(get, each[a:b])) for a, b in zip([0, *count], count)]

    def encode_chunks(self, texts: list[str]) -> list[bytes]:
        return self._segments(texts, self._by_chunks) if self.proven else self._library(texts)

    def decode(self, ids: list[int]) -> str:
        """As the library's decode(ids, skip_special_tokens=False) for byte-level vocabularies; ids out of range are skipped."""
        if not self.proven:
            return self.lib.decode(ids, skip_special_tokens=False)
        table, n = self.bytes_of, len(self.bytes_of)
        return b"".join([table[i] for i in ids if i < n]).decode("utf-8", "replace")


def codec(path: str) -> ChunkCodec:
    """The worker's codec of a vocabulary file."""
    own = worker_tables(f"bpe {path}")
    if not own:
        own["codec"] = ChunkCodec(path)
    return own["codec"]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_text: bool = False) -> DataFrame:
    """(``id_col``, ids array<int>, decoded string): every text encoded, and decoded again from its ids.

    One row per input row; null and empty texts have no ids and decode to ''. Rows with a
    null or repeated id are encoded like any other; other columns are not read.
    """
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for ids, coded in _coded(batches, c):
            arrays = [np.frombuffer(x, np.uint32) for x in coded]
            yield record_batch({"id": ids, "ids": [a.astype(np.int32) for a in arrays],
                                "decoded": [c.decode(a.tolist()) for a in arrays]}, schema)

    out = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    return out.mapInArrow(run, "id long, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def _coded(batches: Iterator[pa.RecordBatch], c: ChunkCodec) -> Iterator[tuple[list, list[bytes]]]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in slices(texts):
            yield ids[a:b], c.encode_chunks([t or "" for t in texts[a:b]])


def encode_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_tokens, ids_sha256, decoded_sha256): digests of :func:`encode_documents`, taken where the ids
    are made so that no id array leaves its task."""
    schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        text_of = [str(i) for i in range(len(c.bytes_of))]
        for ids, coded in _coded(batches, c):
            rows = [np.frombuffer(x, np.uint32).tolist() for x in coded]
            yield record_batch({
                "id": ids, "n_tokens": [len(r) for r in rows],
                "ids_sha256": [hashlib.sha256(",".join([text_of[i] for i in r]).encode()).hexdigest() for r in rows],
                "decoded_sha256": [hashlib.sha256(c.decode(r).encode()).hexdigest() for r in rows]}, schema)

    out = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    return out.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
