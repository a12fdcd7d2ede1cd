"""Repeated ids and rows, columns named like the operators' own, numeric signs, and the filter of roots."""

import random

import numpy as np
import pytest

import corpus_pipeline as pipeline
from storepulse.llm import decontam, langid, minhash, windows
from storepulse.llm.common import fresh, ship

A, B, C, D = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows):
    ship(spark)
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def test_fresh_names():
    assert fresh("a", ["b"]) == "a" and fresh("a", ["A", "a_"]) == "a__"


ROWS = [(3, A, "x"), (5, A, "x"), (5, B, "x"), (7, C, "x"), (7, C, "y"), (9, D, "x"), (9, D + " more", "x"), (None, A, "x"), (None, A, "x"),
        (11, None, "x"), (11, None, "x"), (12, "", "x"), (12, A + " tail", "x")]


def test_an_id_with_several_texts(spark):
    rows = minhash.near_duplicates(_docs(spark, ROWS), by_text=True).collect()
    assert len(rows) == len(ROWS)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept, r.first) for r in rows if r.doc_id is not None))
    assert got == sorted([(3, 56, 3, True, True), (5, 56, 3, False, False), (5, 56, 5, True, True), (7, 56, 7, True, True), (7, 56, 7, True, True),
                          (9, 56, 9, True, got[5][4]), (9, 57, 9, True, not got[5][4]), (11, 0, 11, True, True), (11, 0, 11, True, True),
                          (12, 0, 12, True, True), (12, 57, 3, False, False)])
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)] * 2


def test_near_dedup_keeps_every_text_once(spark):
    kept = pipeline.near_dedup(spark, _docs(spark, ROWS), "").select("doc_id", "text").collect()
    got = sorted(((r.doc_id or 0, r.text or "") for r in kept))
    nine = [t for i, t in got if i == 9]
    assert len(nine) == 1 and nine[0] in (D, D + " more")
    assert [r for r in got if r[0] != 9] == sorted([(0, A), (0, A), (3, A), (5, B), (7, C), (11, ""), (12, "")])


@pytest.mark.parametrize("seed", [1, 2])
def test_near_dedup_of_random_rows(spark, seed):
    """What goes has its text, or one linked to it, among what stays; nothing that stays is linked to another document that stays."""
    rnd = random.Random(seed)
    texts = [A, B, C, D, A + " x", B + " y", "short one", ""]
    rows = [(rnd.randint(0, 12), rnd.choice(texts), "x") for _ in range(60)]
    stay = [(r.doc_id, r.text) for r in pipeline.near_dedup(spark, _docs(spark, rows), "").collect()]
    assert len(stay) == len(set(stay)) and set(stay) <= {(i, t) for i, t, _ in rows}
    group = {A: "a", A + " x": "a", B: "b", B + " y": "b", C: "c", D: "d", "short one": "s"}
    for g in set(group.values()):
        members = {i for i, t, _ in rows if group.get(t) == g}
        assert [i for i, t in stay if group.get(t) == g] == ([min(members)] if members else [])
    assert sorted(i for i, t in stay if not t) == sorted({i for i, t, _ in rows if not t})


def test_columns_named_like_the_operators(spark):
    odd = ["text_to_read", "gone_id", "gone_hash", "row_hash", "passage_marks", "passage_id", "passage_hash", "held_out", "lang_pred", "score", "n_words", "spans", "items",
           "id", "h", "key", "node", "first", "SCORE_", "text_hash", "component"]
    rows = [(i, t, "en", "s", len(t), *[f"{c}{i}" for c in odd]) for i, t in enumerate([A, A, B + " " + C, "some more words to read " * 20])]
    ship(spark)
    docs = spark.createDataFrame(rows, SCHEMA + ", " + ", ".join(f"`{c}` string" for c in odd))
    sf = "/root/testdata/sf0.001"
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert all(r[c] == f"{c}{r.doc_id}" for c in odd), name
    assert pipeline.encode(spark, docs, sf).count() == 4
    for find in (lambda: decontam.find(docs, spark.read.parquet(f"{sf}/benchmark.parquet"), keep=["doc_id", "spans"]), lambda: langid.identify(docs, keep=["score"])):
        with pytest.raises(ValueError):
            find()


def test_no_letter_is_no_language(spark):
    rows = [(1, "the cat sat on the mat " * 5, "x"), (2, "½ ² Ⅷ ³ ٣ 12 _ !", "x"), (3, "½the", "x"), (6, "a", "x"), (13, "le chat", "x")]
    got = {r.doc_id: r for r in langid.identify(_docs(spark, rows)).collect()}
    assert got[2].lang_pred == "und" and got[2].score == 0 and got[3].lang_pred == "en"
    assert langid.words_of("½the²x Ⅷé_ß３ a\U0001F101b \U00010400c") == ["the", "x", "é", "ß", "a", "b", "\U00010428c"]
    assert langid.words_of("a½ \U0001F101") == ["a"] and langid.words_of(None) == []


def test_the_sample_is_bounded_by_rows(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(langid, "FIT_ROWS", 5)
    rows = [(1, f"text {i}", "x") for i in range(40)] + [(1, "same", "x")] * 40 + [(i, "other", "x") for i in range(2, 20)]
    got = langid.sample(_docs(spark, rows), F.lit(True), "doc_id", "text", "lang").collect()
    assert len(got) == 5 and {r.text for r in got} <= {t for _, t, _ in rows}
    few = langid.sample(_docs(spark, rows[:3]), F.lit(True), "doc_id", "text", "lang").collect()
    assert sorted(r.text for r in few) == ["text 0", "text 1", "text 2"]


def test_the_filter_lets_every_shared_root_through(spark, monkeypatch):
    ship(spark)
    rng = np.random.default_rng(4)
    keys = rng.integers(-1 << 62, 1 << 62, 5000)
    bits = windows._filter(spark.createDataFrame([(int(k),) for k in keys], "key long"))
    k = keys.view(np.uint64)
    word = bits[(k % np.uint64(windows.FILTER_BITS)).astype(np.int64) >> 6].view(np.uint64)
    assert ((word >> (k % np.uint64(64))) & np.uint64(1) == 1).all() and np.bitwise_count(bits.view(np.uint64)).sum() <= 5000
    assert windows._filter(spark.createDataFrame([], "key long")).sum() == 0
