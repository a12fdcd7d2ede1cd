"""Power-of-two packing against the tokenizers library and the binary digits."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from storepulse.llm import packing
from storepulse.llm.common import ship

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(deadline=None)
@given(st.integers(0, 20_000), st.integers(0, 12))
def test_pieces_are_the_binary_digits(n, k):
    limit = 1 << k
    got = packing.pieces(n, limit)
    assert [s for s, _ in got] == np.cumsum([0, *[x for _, x in got]])[:-1].tolist()
    lengths = [x for _, x in got]
    assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
    assert all(x & (x - 1) == 0 and x <= limit for x in lengths)
    small = [x for x in lengths if x < limit]
    assert len(small) == len(set(small)) and sum(small) == n % limit


def _rows():
    long = " ".join(f"word{i % 101} it's <|endoftext|> {i}" for i in range(30_000))
    texts = ["", None, "one", "one", "中文 “quoted” 😀", long, "x" * 50_000, " \n\n  "]
    return [(i, t, 5, "s", 1) for i, t in enumerate(texts)] + [(None, "no id", 5, "s", 2), (2, "a second row of id 2", 5, "s", 3)]


def test_packed_table(spark):
    ship(spark)
    df = spark.createDataFrame(_rows(), "doc_id long, text string, length int, sequence_id string, ids int")
    packed = packing.read_packed(spark, packing.pack(df, PATH))
    lib = Tokenizer.from_file(PATH)
    want = defaultdict(int)
    for i, t, *_ in _rows():
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        for start, length in packing.pieces(len(ids)):
            want[i, start, length, zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes()), len(ids)] += 1
    rows = packing.digests(packed).collect()
    got = defaultdict(int)
    for r in rows:
        got[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
    assert got == want
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    # a bucket's folder holds its length only
    assert {r.length for r in packed.where("length = 2048").collect()} == {2048}


def test_other_limits_and_no_end_id(spark):
    ship(spark)
    df = spark.createDataFrame([(1, "some words to cut"), (2, None)], "doc_id long, text string")
    rows = packing.cut_documents(df, PATH, limit=2, end_id=None).collect()
    n = len(Tokenizer.from_file(PATH).encode("some words to cut", add_special_tokens=False).ids)
    assert sorted((r.doc_id, r.start, r.length) for r in rows) == [(1, s, x) for s, x in packing.pieces(n, 2)]
    with pytest.raises(ValueError):
        packing.cut_documents(df, PATH, limit=3)


def test_empty_table(spark):
    ship(spark)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.digests(packing.read_packed(spark, packing.pack(df, PATH))).count() == 0
