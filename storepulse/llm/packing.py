"""Packing by power-of-two decomposition (operator 11).

A document of n ids is cut into whole sequences of ``limit`` ids (a power of two) and then into
one piece per binary digit of the rest, longest first. Every piece is a sequence of its own,
so no sequence crosses documents and none needs padding; pieces of equal length lie together
in one bucket, from which a trainer draws batches of one shape.

Pieces are cut where the ids are made and shuffled once, by length, into their buckets. The
buckets are few and one of them may hold most ids: the shuffle is a rebalance, which splits
a large bucket over many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from storepulse.llm.bpe import codec
from storepulse.llm.common import record_batch, slices
from storepulse.session import scratch_path

LIMIT = 2048
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                     ("id_bytes", pa.int32()), ("ids", pa.binary())])
_TABLE = "sequence_id long, doc_id long, start long, doc_tokens long, id_bytes int, ids binary, length long"


def pieces(n: int, limit: int = LIMIT) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: whole sequences of ``limit``, then the binary digits of the rest."""
    whole, rest = divmod(n, limit)
    lengths = [limit] * whole + [1 << k for k in range(limit.bit_length() - 2, -1, -1) if rest >> k & 1]
    starts = np.cumsum([0, *lengths[:-1]]).tolist()
    return list(zip(starts, lengths))


def cut_documents(docs: DataFrame, path: str, limit: int = LIMIT, end_id: int | None = 1, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, doc_tokens, id_bytes, ids): the pieces of every whole text.

    Ids are those of the tokenizers library for the vocabulary file at ``path``, with ``end_id`` behind each
    document (None: nothing, and a document without ids has no piece), little-endian, ``id_bytes`` wide: two
    where the vocabulary fits in 16 bits. Null texts are empty; null and repeated ids are documents of their
    own, row by row; other columns are not read; an empty table has no pieces.
    """
    if limit < 1 or limit & (limit - 1):
        raise ValueError("limit must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        end = b"" if end_id is None else np.uint32(end_id).tobytes()
        kind = np.dtype("<u2" if max(len(c.bytes_of), (end_id or 0) + 1) <= 1 << 16 else "<u4")
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                out: dict[str, list] = {f.name: [] for f in _PIECES}
                for doc, coded in zip(ids[a:b], c.encode_chunks([t or "" for t in texts[a:b]])):
                    data = np.frombuffer(coded + end, np.uint32)
                    n, data = len(data), data.astype(kind).tobytes()
                    for start, length in pieces(n, limit):
                        out["doc_id"].append(doc)
                        out["start"].append(start)
                        out["length"].append(length)
                        out["ids"].append(data[start * kind.itemsize:(start + length) * kind.itemsize])
                    more = len(out["ids"]) - len(out["doc_tokens"])
                    out["doc_tokens"].extend([n] * more)
                    out["id_bytes"].extend([kind.itemsize] * more)
                yield record_batch(out, _PIECES)

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, id_bytes int, ids binary")


def pack(docs: DataFrame, path: str, folder: str | None = None, limit: int = LIMIT, end_id: int | None = 1,
         id_col: str = "doc_id", text_col: str = "text") -> str:
    """Pack ``docs`` into the bucketed table at ``folder`` (default: new shared scratch); returns the folder.

    One row per sequence, in a folder ``length=<power of two>`` per bucket. ``sequence_id`` is unique, grows with
    the place of a piece in the input and is set before the shuffle, so a task that is run again gives its
    pieces the same ids. See :func:`cut_documents` for awkward rows.
    """
    folder = folder or scratch_path(docs.sparkSession, "packed")
    cut = cut_documents(docs, path, limit, end_id, id_col, text_col).withColumn("sequence_id", F.monotonically_increasing_id())
    cut.hint("rebalance", "length").write.option("compression", "zstd").partitionBy("length").parquet(folder)
    return folder


def read_packed(spark: SparkSession, folder: str) -> DataFrame:
    """The sequences of a packed table: sequence_id, doc_id, start, doc_tokens, id_bytes, ids, length, offset (0: a piece fills its sequence)."""
    return spark.read.schema(_TABLE).parquet(folder).withColumn("offset", F.lit(0).cast("long"))


def digests(packed: DataFrame) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of :func:`read_packed` rows; the checksum is over 32-bit ids."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = [zlib.crc32(data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes())
                    for data, width in zip(batch.column("ids").to_pylist(), batch.column("id_bytes").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(wide, pa.int64()) if f.name == "ids_crc32" else batch.column(f.name) for f in schema], schema=schema)

    return packed.mapInArrow(run, ", ".join(f"{f.name} long" for f in schema))
