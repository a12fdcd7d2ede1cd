"""Token-id output as static range asymmetric numeral system files (operator 2).

Layout of a dataset folder::

    freqs.npy            shared table: one scaled frequency per token id, sum 2**SCALE_BITS
    part-00000.rans      documents in ascending id order; file k precedes file k+1
    manifest/            Parquet: one row per file and one per block

A file is a sequence of independent blocks followed by nothing else; everything needed to
open it is in the manifest. A block holds up to BLOCK_TOKENS ids dealt round robin to LANES
interleaved coders: 64-bit states, 32-bit words, words in the order the decoder takes them.
Its checkpoint (the lanes' final states) stands in front of the words, so any block decodes
without its neighbours and blocks decode in parallel. Each block carries a CRC-32 of its
bytes and one of its ids. Document ends are kept as lengths beside the blocks, because no
token id is free to mark them.

Ids are counted over the whole corpus; an id that the table does not hold cannot occur,
since the table is made of the ids that are written.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from storepulse.llm.bpe import codec
from storepulse.llm.common import record_batch, slices, stored
from storepulse.session import scratch_path

SCALE_BITS = 20
LANES = 1024
BLOCK_TOKENS = 1 << 18
#: Ids a file aims at; one file is written and read by one task at a time.
FILE_TOKENS = 1 << 22
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sIIII")  # magic, ids, words, crc of ids, crc of body
_MAGIC = b"SPR1"


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies summing to 2**SCALE_BITS: at least 1 for every id that occurs, 0 for the others."""
    out = np.zeros(len(counts), np.int64)
    there = counts > 0
    total = int(counts.sum())
    if not total:
        return out
    room = (1 << SCALE_BITS) - int(there.sum())
    out[there] = 1 + (counts[there].astype(object) * room // total).astype(np.int64)
    out[int(counts.argmax())] += (1 << SCALE_BITS) - int(out.sum())
    return out


class Table:
    """Frequencies, cumulative frequencies and the slot table of the decoder."""

    def __init__(self, freqs: np.ndarray):
        self.freqs = freqs.astype(np.uint64)
        self.cum = (np.cumsum(freqs) - freqs).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freqs), dtype=np.uint32), freqs)


def encode_block(ids: np.ndarray, t: Table) -> bytes:
    """One self-contained block."""
    n = len(ids)
    rows = -(-n // LANES)
    padded = np.full(rows * LANES, ids[0] if n else 0, np.int64)
    padded[:n] = ids
    freq, cum = t.freqs[padded].reshape(rows, LANES), t.cum[padded].reshape(rows, LANES)
    if n and (freq == 0).any():
        raise ValueError("an id is not in the frequency table")
    limit = freq << np.uint64(63 - SCALE_BITS)
    state, words = np.full(LANES, _LOW, np.uint64), []
    for k in range(rows - 1, -1, -1):
        f = freq[k]
        full = state >= limit[k]
        if full.any():
            words.append(state[full].astype(np.uint32))
            state = np.where(full, state >> np.uint64(32), state)
        q = state // f
        state = (q << np.uint64(SCALE_BITS)) + (state - q * f) + cum[k]
    body = state.tobytes() + (np.concatenate(words[::-1]).tobytes() if words else b"")
    return _HEAD.pack(_MAGIC, n, (len(body) - 8 * LANES) // 4, zlib.crc32(np.asarray(ids, np.uint32).tobytes()), zlib.crc32(body)) + body


def decode_block(data: bytes, t: Table) -> np.ndarray:
    """Ids of a block; ValueError if a checksum fails."""
    magic, n, n_words, crc_ids, crc_body = _HEAD.unpack_from(data)
    body = data[_HEAD.size:]
    if magic != _MAGIC or len(body) != 8 * LANES + 4 * n_words or zlib.crc32(body) != crc_body:
        raise ValueError("broken block")
    state = np.frombuffer(body, np.uint64, LANES).copy()
    words, at = np.frombuffer(body, np.uint32, n_words, 8 * LANES), 0
    rows = -(-n // LANES)
    out = np.empty((rows, LANES), np.uint32)
    low, bits = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS)
    for k in range(rows):
        slot = state & low
        out[k] = s = t.symbol[slot]
        state = t.freqs[s] * (state >> bits) + slot - t.cum[s]
        short = np.flatnonzero(state < _LOW)
        if len(short):
            state[short] = (state[short] << np.uint64(32)) | words[at:at + len(short)]
            at += len(short)
    ids = out.reshape(-1)[:n]
    if zlib.crc32(ids.tobytes()) != crc_ids:
        raise ValueError("ids do not match their checksum")
    return ids


def _fs(path: str):
    """File system and path of a folder that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def tokenize(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """(doc_id, n_tokens, ids): ids of every whole text, the end id appended; null texts are empty.

    Ids are little-endian and as wide as :func:`id_type` of the vocabulary's size says.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, end = codec(path), np.uint32(end_id).tobytes()
        kind = id_type(len(c.bytes_of))
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts, 1 << 22):
                coded = [np.frombuffer(x + end, np.uint32).astype(kind) for x in c.encode_chunks([t or "" for t in texts[a:b]])]
                yield record_batch({"doc_id": ids[a:b], "n_tokens": [len(x) for x in coded], "ids": [x.tobytes() for x in coded]}, schema)

    out = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return out.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def id_type(vocabulary: int) -> type:
    return np.uint16 if vocabulary <= 1 << 16 else np.uint32


def token_counts(coded: DataFrame, kind: type = np.uint32) -> np.ndarray:
    """Occurrences of every id over all documents; as long as the largest id, so bounded by the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(x or b"" for x in batch.column(0).to_pylist()), kind)
            found = np.bincount(ids)
            if len(found) > len(total):
                total = np.pad(total, (0, len(found) - len(total)))
            total[:len(found)] += found
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there], pa.int64())], names=["id", "n"])

    rows = coded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.int64)
    out[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return out


MANIFEST = "file int, block int, offset long, bytes long, tokens long, doc_ids binary, lengths binary"
_SCHEMA = pa.schema([("file", pa.int32()), ("block", pa.int32()), ("offset", pa.int64()), ("bytes", pa.int64()),
                     ("tokens", pa.int64()), ("doc_ids", pa.binary()), ("lengths", pa.binary())])


def write_tokens(coded: DataFrame, folder: str, kind: type = np.uint32) -> str:
    """Write (doc_id, n_tokens, ids) as a dataset in ascending doc_id order (null ids first, ties by content).

    Each range of ids is one sorted partition and one file, written under a name of the attempt's own and then renamed,
    so a task that is run again leaves one whole file. The manifest has a row per block; the rows of a file's first
    block also hold its documents' ids and lengths. Empty input gives an empty manifest.
    """
    import uuid

    spark = coded.sparkSession
    counts = token_counts(coded, kind)
    freqs = scaled(counts)
    fs, root = _fs(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/freqs.npy") as f:
        buf = io.BytesIO()
        np.save(buf, freqs)
        f.write(buf.getvalue())
    shared = spark.sparkContext.broadcast(freqs)  # bounded by the vocabulary
    parts = max(1, -(-int(counts.sum()) // FILE_TOKENS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        t, part = Table(shared.value), TaskContext.get().partitionId()
        here, base = _fs(folder)
        temp, offset, block = f"{base}/.{uuid.uuid4().hex}", 0, 0
        docs, lengths, rows, left = [], [], [], np.zeros(0, kind)
        with here.open_output_stream(temp) as out:
            def put(ids):
                nonlocal offset, block
                data = encode_block(ids, t)
                out.write(data)
                rows.append((block, offset, len(data), len(ids)))
                offset, block = offset + len(data), block + 1

            for batch in batches:
                docs.extend(batch.column(0).to_pylist())
                lengths.extend(batch.column(1).to_pylist())
                whole = [left]
                for x in batch.column(2):
                    whole.append(np.frombuffer(x.as_buffer(), kind))
                left = np.concatenate(whole)
                for a in range(0, len(left) - BLOCK_TOKENS + 1, BLOCK_TOKENS):
                    put(left[a:a + BLOCK_TOKENS])
                left = left[len(left) // BLOCK_TOKENS * BLOCK_TOKENS:]
            if len(left):
                put(left)
        if not rows:
            here.delete_file(temp)
            return
        here.move(temp, f"{base}/part-{part:05d}.rans")
        null = np.iinfo(np.int64).min  # stands for a null id
        first = (np.array([null if d is None else d for d in docs], np.int64).tobytes(), np.array(lengths, np.int64).tobytes())
        for i, (b, o, size, n) in enumerate(rows):
            yield record_batch({"file": [part], "block": [b], "offset": [o], "bytes": [size], "tokens": [n],
                                "doc_ids": [first[0] if not i else b""], "lengths": [first[1] if not i else b""]}, _SCHEMA)

    ranged = coded.repartitionByRange(parts, "doc_id") if parts > 1 else coded.coalesce(1)
    ranged.sortWithinPartitions("doc_id", "ids").mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


def _starts(manifest: DataFrame) -> DataFrame:
    """(file, base): ids in all files before; one row per file."""
    sums = manifest.groupBy("file").agg(F.sum("tokens").alias("n")).toPandas().sort_values("file")  # a row per file of FILE_TOKENS ids
    sums["base"] = sums["n"].cumsum() - sums["n"]
    return manifest.sparkSession.createDataFrame(sums[["file", "base"]], "file int, base long")


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """(file, block, first, ids array<int>): every block decoded by itself, in parallel; first = place of its first id."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").drop("doc_ids", "lengths")
    schema = pa.schema([("file", pa.int32()), ("block", pa.int32()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(folder)
        t = Table(np.load(io.BytesIO(fs.open_input_stream(f"{base}/freqs.npy").read())))
        for batch in batches:
            for r in batch.to_pylist():
                with fs.open_input_file(f"{base}/part-{r['file']:05d}.rans") as f:
                    f.seek(r["offset"])
                    ids = decode_block(f.read(r["bytes"]), t)
                yield record_batch({"file": [r["file"]], "block": [r["block"]], "ids": [ids.astype(np.int32)]}, schema)

    out = manifest.repartition("file", "block").mapInArrow(run, "file int, block int, ids array<int>")
    places = manifest.join(_starts(manifest), "file").select("file", "block", (F.col("base") + F.col("block") * BLOCK_TOKENS).alias("first"))
    return out.join(places, ["file", "block"])


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    A task streams one file block by block and carries the checksum of the document that a block
    end cuts, so a document of any length takes the memory of one block.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    files = manifest.groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct("block", "offset", "bytes"))).alias("blocks"),
        F.max(F.when(F.col("block") == 0, F.col("doc_ids"))).alias("doc_ids"), F.max(F.when(F.col("block") == 0, F.col("lengths"))).alias("lengths"))
    files = files.join(_starts(manifest), "file")
    n_files = max(1, manifest.select("file").distinct().count())
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    null = np.iinfo(np.int64).min

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(folder)
        t = None
        for batch in batches:
            for r in batch.to_pylist():
                t = t or Table(np.load(io.BytesIO(fs.open_input_stream(f"{base}/freqs.npy").read())))
                docs, lengths = np.frombuffer(r["doc_ids"], np.int64), np.frombuffer(r["lengths"], np.int64)
                ends = np.cumsum(lengths)
                crcs, k, crc, seen = [], 0, 0, 0
                with fs.open_input_file(f"{base}/part-{r['file']:05d}.rans") as f:
                    for b in r["blocks"]:
                        f.seek(b["offset"])
                        data = memoryview(decode_block(f.read(b["bytes"]), t)).cast("B")
                        at, upto = 0, seen + len(data) // 4
                        while k < len(ends) and ends[k] <= upto:
                            to = int(ends[k] - seen) * 4
                            crcs.append(zlib.crc32(data[at:to], crc))
                            at, crc, k = to, 0, k + 1
                        crc, seen = zlib.crc32(data[at:], crc), upto
                yield record_batch({"doc_id": pd.Series(docs, dtype=object).where(docs != null, None).tolist(),
                                    "start": ends - lengths + r["base"], "n_tokens": lengths, "ids_crc32": crcs}, schema)

    return files.repartition(n_files, "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def pack_documents(docs: DataFrame, path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode every whole text and write the dataset; returns its folder (a new shared one unless given)."""
    folder = folder or scratch_path(docs.sparkSession, "rans")
    kind = id_type(len(codec(path).bytes_of))
    return write_tokens(stored(tokenize(docs, path, id_col, text_col), "ids"), folder, kind)
