"""Token counts by the whole-token shortcut (operator 9).

Offline, once per vocabulary, every vocabulary string is encoded alone; the strings that
come back as that one id and are one pre-token are proven whole tokens. A text is cut to
pre-tokens by the vocabulary's pattern; proven ones count one each, only the others are
merged by the library, each distinct one once per worker while its bounded table holds it.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from storepulse.llm.bpe import FAR, PATTERN, byte_alphabet
from storepulse.llm.common import record_batch, slices

MAX_PRE_TOKENS = 400_000

def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    lib.no_padding()
    return lib


def whole_tokens(path: str) -> frozenset[str] | None:
    """Vocabulary strings that encode alone as one token; None where the pattern isn't the vocabulary's own."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") is not None or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return None
    lib, letters, pattern = load(path), byte_alphabet(), regex.compile(PATTERN)
    found = []
    for token, i in lib.get_vocab(with_added_tokens=False).items():
        try:
            found.append((bytes(letters[c] for c in token).decode(), i))
        except (UnicodeDecodeError, KeyError):
            continue
    ids = lib.encode_batch_fast([s for s, _ in found], add_special_tokens=False)
    return frozenset(s for (s, i), e in zip(found, ids) if e.ids == [i] and not FAR.search(s) and pattern.findall(s) == [s])


_WORKER: dict[str, tuple] = {}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """(``id_col``, n_bytes, n_tokens, over_limit): tokens of every whole text as the library gives them.

    ``.json`` files are read by tokenizers, ``.model`` files by sentencepiece; no begin, end or
    added tokens. One row per input row; null and empty texts count 0; null or repeated ids pass
    through; other columns are not read.
    """
    spark = docs.sparkSession
    piece = path.endswith(".model")
    # bounded by the vocabulary
    proven = spark.sparkContext.broadcast(None if piece else whole_tokens(path))
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if piece:
            import sentencepiece

            lib = sentencepiece.SentencePieceProcessor(model_file=path)
            lengths = lambda texts: [len(x) for x in lib.encode(texts, num_threads=1)]
        else:
            if path not in _WORKER:
                lib = load(path)
                added = [t.content for t in lib.get_added_tokens_decoder().values()]
                odd = regex.compile("|".join(map(regex.escape, added))) if added else None
                _WORKER[path] = (lib, odd, dict.fromkeys(proven.value or (), 1))
            lib, odd, known = _WORKER[path]
            lengths = lambda texts: [len(x.ids) for x in lib.encode_batch_fast(texts, add_special_tokens=False)]
        find = regex.compile(PATTERN).findall
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                part = texts[a:b]
                if piece or proven.value is None:
                    counts = lengths(part)
                else:
                    own = [i for i, t in enumerate(part) if FAR.search(t) or odd is not None and odd.search(t)]
                    counts = [0] * len(part)
                    for i, n in zip(own, lengths([part[i] for i in own])):
                        counts[i] = n
                    skip = set(own)
                    cut = [[] if i in skip else find(t) for i, t in enumerate(part)]
                    if len(known) > MAX_PRE_TOKENS:
                        known = dict.fromkeys(proven.value, 1)
                        _WORKER[path] = (lib, odd, known)
                    rest: set[str] = set()
                    for p in cut:
                        rest.update(p)
                    new = list(rest.difference(known))
                    known.update(zip(new, lengths(new)))
                    for i, p in enumerate(cut):
                        if i not in skip:
                            counts[i] = sum(map(known.__getitem__, p))
                yield record_batch({"id": ids[a:b], "n_bytes": [len(t.encode()) for t in part], "n_tokens": counts}, schema)

    out = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    out = out.mapInArrow(run, "id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("id", id_col)
