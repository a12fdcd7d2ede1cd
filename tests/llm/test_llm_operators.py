"""The training-data operators against brute force, the libraries themselves and awkward rows."""

import hashlib
import os
import re
import sys
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from storepulse.llm import bpe, common, decontam, hnsw, langid, license, lmscore, minhash, rans, tokencount, windows
from storepulse.llm.common import components, ship

PATH = public_tokenizers.path("byte_bpe_50k.json")
COPY = " ".join(f"word{i % 37}x{i}" for i in range(120))
ODD = ["", None, "   ", "\n\n", "a" * 3000, "the  cat\n sat　down <|endoftext|> it's 12", COPY, COPY, COPY + " one more", "中文 text 😀 und Straße"]


@pytest.fixture(scope="module")
def odd(spark):
    ship(spark)
    rows = [(i, t, None, "s", 0, 1.0) for i, t in enumerate(ODD)] + [(None, COPY, "en", None, None, None), (6, COPY, "en", "s", 1, 2.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens int, score double")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def test_encode_and_decode_as_the_library(lib):
    c, texts = bpe.codec(PATH), [t or "" for t in ODD]
    for text, a, b in zip(texts, c.encode_words(texts), c.encode_chunks(texts)):
        ids = lib.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(a, np.uint32).tolist() == np.frombuffer(b, np.uint32).tolist() == ids
        assert c.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_round_trip_and_counts(odd, empty, lib):
    got = sorted((r.n_tokens, r.ids_sha256) for r in bpe.encode_digest(odd, PATH).collect())
    texts = [t or "" for t in ODD] + [COPY] * 2
    ids = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert got == sorted((len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for x in ids)
    rows = tokencount.count_tokens(odd, PATH).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == sorted((len(t.encode()), len(x)) for t, x in zip(texts, ids))
    assert bpe.encode_digest(empty, PATH).count() == tokencount.count_tokens(empty, PATH).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, rans.LANES, rans.LANES + 1, 20_000])
def test_rans_block_round_trip(n):
    ids = np.random.default_rng(n).zipf(1.3, n) % 900
    t = rans.Table(rans.scaled(np.bincount(ids, minlength=1000)))
    data = rans.encode_block(ids, t) if n else rans.encode_block(ids, rans.Table(rans.scaled(np.array([1]))))
    if n:
        assert rans.decode_block(data, t).tolist() == ids.tolist()
        broken = bytearray(data)
        broken[-1] ^= 1
        with pytest.raises(ValueError):
            rans.decode_block(bytes(broken), t)


def test_rans_files(odd, empty, lib):
    got = rans.read_digests(odd.sparkSession, rans.pack_documents(odd, PATH)).orderBy("start").collect()
    rows = sorted([(None, COPY)] + list(enumerate(ODD)) + [(6, COPY)], key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for r, (i, t) in zip(got, rows, strict=True):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], np.uint32)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert rans.read_digests(odd.sparkSession, rans.pack_documents(empty, PATH)).count() == 0


def test_minhash_odd_rows(odd, empty):
    rows = minhash.near_duplicates(odd).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == odd.count()
    assert by[7].component_id == by[8].component_id == 6 and not by[7].kept and by[6].kept
    assert by[0].n_shingles == 0 and by[0].kept and by[None].kept and by[None].component_id is None
    assert minhash.near_duplicates(empty).count() == 0


def test_minhash_large_cluster_matches_brute_force(spark):
    ship(spark)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(60):
        w = list(base)
        for k in rng.integers(0, 150, rng.integers(0, 9)):
            w[k] = f"n{rng.integers(1 << 30)}"
        texts.append(" ".join(w))
    sets = [set(minhash.shingles(minhash.word_hashes(t), 4).tolist()) for t in texts]
    parent = list(range(60))
    for i in range(60):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = parent[i], parent[j]
                parent = [min(a, b) if p in (a, b) else p for p in parent]
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), words=4)
    assert {r.doc_id: r.component_id for r in got.collect()} == dict(enumerate(parent))


def test_passages(spark, odd, empty):
    share = " ".join(f"s{i}" for i in range(60))
    rows = [(1, "a b c " + share + " x y"), (2, "q w " + share + " e r t"), (3, "nothing like the others " * 20)]
    got = windows.duplicate_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.from_word, r.to_word, r.source_id) for r in got] == [(2, 2, 62, 1)]
    cut = {r.doc_id: r.text for r in windows.cut_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert cut[2] == "q w e r t" and cut[1] == rows[0][1] and cut[3] == rows[2][1]
    assert windows.cut_passages(odd).columns == odd.columns and windows.cut_passages(odd).count() == odd.count()
    assert windows.duplicate_passages(empty).count() == 0


def test_passage_after_a_repeated_line():
    line, other = [f"l{i}" for i in range(12)], [f"o{i}" for i in range(30)]
    for own in (40, 44, 60):  # passages of 52, 56 and 72 words
        passage = line + [f"u{i}" for i in range(own)]
        a = line + other + passage + ["end"]
        b = ["x", "y"] + passage + ["z"]
        sa, sb = (minhash.shingles(minhash.word_hashes(" ".join(t)), 5) for t in (a, b))
        assert windows.passages(sa, sb, 46, 80) == [(2, 2 + len(passage) - 4)]
    # each half stands earlier with another continuation, so no shingle's first place is in the passage
    left, right = [f"p{i}" for i in range(32)], [f"q{i}" for i in range(32)]
    middle = left[-4:] + right[:4]
    a, b = left + other + right + other[::-1] + middle + ["m"] + left + right, ["b"] * 3 + left + right + ["c"]
    sa, sb = (minhash.shingles(minhash.word_hashes(" ".join(t)), 5) for t in (a, b))
    assert windows.passages(sa, sb, 46, 80) == [(3, 3 + 60)]


def test_passages_cover_every_repeat_of_random_texts():
    rng = np.random.default_rng(4)
    lines = [[f"l{k}w{i}" for i in range(rng.integers(3, 25))] for k in range(9)]
    for _ in range(60):
        a, b = ([w for k in rng.integers(0, 9, 14) for w in lines[k]] for _ in range(2))
        sa, sb = (minhash.shingles(minhash.word_hashes(" ".join(t)), 5) for t in (a, b))
        got, longest = windows.passages(sa, sb, 46, 80), {}
        for i in range(len(sb)):
            for j in range(len(sa)):
                n = 0
                while i + n < len(sb) and j + n < len(sa) and sb[i + n] == sa[j + n]:
                    n += 1
                if n >= 46:
                    assert any(s <= i and i + n <= e for s, e in got)


def _drift(words, rng, edits):
    out = list(words)
    for k in rng.choice(len(words), edits, replace=False):
        out[k] = f"e{rng.integers(1 << 40)}"
    return out


def test_passages_of_frequent_lines_and_version_chains(spark):
    """Over many batches, against the comparison of every pair: each passage that some earlier document has is reported."""
    ship(spark)
    rng = np.random.default_rng(9)
    fresh = lambda n: [f"n{rng.integers(1 << 40)}" for _ in range(n)]
    line, texts = [f"line{i}" for i in range(14)], []
    for _ in range(30):  # a frequent line with another continuation in each, some of them twice
        texts.append(fresh(20) + line + fresh(60))
    for k in range(6):
        texts.append(fresh(5) + texts[4 * k + 3][20:90] + fresh(9))
    version = [f"v{i}" for i in range(120)]
    for _ in range(12):  # drifts away from the first
        texts.append(version)
        version = _drift(version, rng, 2)
    schema = "doc_id long, text string"
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, schema).repartition(6)
    got = {}
    for r in windows.duplicate_passages(docs).collect():
        got.setdefault(r.doc_id, set()).update(range(r.from_word, r.to_word))
    s = [minhash.shingles(minhash.word_hashes(t), 5) for _, t in rows]
    for j in range(len(rows)):
        every = {w for i in range(j) for a, b in windows.passages(s[i], s[j], 46, 80) for w in range(a, b + 4)}
        assert got.get(j, set()) <= every and len(got.get(j, set())) >= 0.9 * len(every), j
    assert len(got) == 6 + 11


def test_frequent_line_makes_comparisons_in_proportion(spark, monkeypatch):
    """200 documents share a line, some of them a passage: all passages are found, and the compared pairs don't grow with the square."""
    ship(spark)
    rng = np.random.default_rng(21)
    fresh = lambda n: [f"n{rng.integers(1 << 40)}" for _ in range(n)]
    line = [f"line{i}" for i in range(30)]
    texts = [fresh(20) + line + fresh(60) for _ in range(200)]
    texts += [fresh(5) + _drift(texts[9 * k + 3][10:100], rng, 1) + fresh(9) for k in range(20)]
    pairs, stored = [], windows.stored

    def counted(df, name):
        out = stored(df, name)
        if name == "links":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(windows, "stored", counted)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.source_id) for r in windows.duplicate_passages(docs).collect()}
    assert got >= {(200 + k, 9 * k + 3) for k in range(20)} and {b for b, _ in got} == set(range(200, 220))
    assert sum(pairs) < 20 * len(texts)


def test_cover_holds_the_same_places_with_few_spans():
    rng = np.random.default_rng(23)
    for _ in range(300):
        spans = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 60, 20), rng.integers(5, 15, 20))]
        got = windows.cover(spans)
        assert set(got) <= set(spans) and {i for a, b in got for i in range(a, b)} == {i for a, b in spans for i in range(a, b)}
        assert all(c[0] > a[1] for a, c in zip(got, got[2:]))
    assert windows.cover([]) == [] and windows.cover([(0, 9), (9, 12), (2, 9)]) == [(0, 9), (9, 12)]


def test_rows_follow_the_words_not_the_sources(spark):
    """Texts that go on in one line, each in another number of copies of it: every word, class and source is kept, in rows in proportion to the words."""
    ship(spark)
    rng = np.random.default_rng(24)
    fresh = lambda n: [f"n{rng.integers(1 << 40)}" for _ in range(n)]
    line = [f"line{i}" for i in range(17)]
    texts = [fresh(30) + line * (4 + k % 5) + fresh(30) for k in range(20)] + [fresh(10) + line * 60 + fresh(10) for _ in range(20)]
    passage = [f"p{i}" for i in range(150)]
    texts += [fresh(9) + passage[:80], fresh(9) + passage[:60] + fresh(20), fresh(9) + passage + fresh(9), fresh(200)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = windows.duplicate_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    of, links, held, n = {}, {}, {}, 0
    for r in found.collect():
        of.setdefault(r.doc_id, set()).update(range(r.from_word, r.to_word))
        links.setdefault(r.doc_id, set()).add(r.source_id)
    got = windows.representatives(found).collect()
    for r in got:
        assert r.to_word - r.from_word >= 50 and r.source_id in links[r.doc_id] and r.n_sources == len(links[r.doc_id])
        held.setdefault(r.doc_id, set()).update(range(r.from_word, r.to_word))
    assert held == of and {r.doc_id: r.component_id for r in got} == {i: 0 if i < 40 else 40 for i in of}
    assert {r.doc_id for r in got} | {r.source_id for r in got} == set(of) | {x for y in links.values() for x in y} == set(range(43))
    s = [minhash.shingles(minhash.word_hashes(t), 5) for _, t in rows]
    for j in range(len(rows)):
        every = {w for i in range(j) for a, b in windows.passages(s[i], s[j], 46, 80) for w in range(a, b + 4)}
        assert len(held.get(j, set())) >= 0.9 * len(every) and held.get(j, set()) <= every
    words = sum(len(t) for t in texts)
    assert len(got) <= 2 * words / 50 + len(texts)
    assert windows.representatives(found.limit(0)).count() == 0


def test_sketches_of_equal_passages_are_equal():
    rng = np.random.default_rng(22)
    s, before = rng.integers(0, 1 << 63, 90, dtype=np.uint64), rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    other = np.concatenate([before, s[20:80], before])
    here, there = (windows.sketch(v, np.array([at]), 46, [0, 17, 34], 1) for v, at in ((s, 30), (other, 60)))
    assert here.shape == (1, 3 * 6) and (here[0, :6] == there[0, :6]).all() and set(windows.sketch(s[:9], np.array([0, 3]), 46, [0], 0)[1].tolist())


def test_roots_are_those_of_the_compact_windows():
    v = np.random.default_rng(2).integers(0, 50, 400).astype(np.uint64)
    n = np.array([100, 3, 0, 97, 200])
    ends = np.cumsum(n)
    want = sorted(e - m + c for e, m in zip(ends, n) for _, c, _ in windows.compact_windows(v[e - m:e], 13))
    assert windows.roots(v, n, 13).tolist() == want


def test_wu_manber_against_brute_force(spark, odd, empty):
    rng = np.random.default_rng(5)
    text = lambda n: " ".join(f"v{x}" for x in rng.integers(0, 3, n))
    docs, items = [(i, text(60)) for i in range(40)], [(100 + i, text(n)) for i, n in enumerate([0, 1, 4, 9, 10, 11, 14])]
    got = {r.doc_id: r for r in decontam.report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for i, t in docs:
        w, hit, found = t.split(), set(), set()
        for item, x in items:
            p = x.split()
            m = min(10, len(p))
            for k in range(len(p) - m + 1 if m else 0):
                for j in range(len(w) - m + 1):
                    if w[j:j + m] == p[k:k + m]:
                        hit.update(range(j, j + m))
                        found.add(str(item))
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(found), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.report(odd, none).where("contaminated").count() == 0 and decontam.report(empty, none).count() == 0


def test_language(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    by = {r.doc_id: r for r in langid.identify(odd).collect()}
    assert by[0].lang_pred == by[1].lang_pred == by[2].lang_pred == "und" and by[0].score == 0
    assert langid.identify(empty).count() == 0


def test_embeddings_against_brute_force(spark):
    ship(spark)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    v = (centres[rng.integers(0, 12, 300)] + 0.12 * rng.normal(size=(300, 16))).astype(np.float32)
    rows = [(i, v[i].tolist(), int(i % 2)) for i in range(300)]
    rows += [(300, v[0].tolist(), 0), (301, None, 0), (302, [0.0] * 16, 0), (303, [float("nan")] * 16, 0), (304, v[0].tolist(), None), (None, v[0].tolist(), 0)]
    old, hnsw.SHARD_ROWS = hnsw.SHARD_ROWS, 40
    try:
        got = {r.vec_id: r for r in hnsw.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    finally:
        hnsw.SHARD_ROWS = old
    x = np.vstack([v, v[:1]]).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([i % 2 for i in range(300)] + [0])
    near = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    assert [got[i].n_links for i in range(301)] == near.sum(1).tolist()
    assert all(got[i].n_links == 0 and got[i].kept for i in (301, 302, 303, 304, None))


def test_licences(spark, empty):
    rows = [(1, "prose of no interest", "a/b/c.txt"), (2, "Licensed under the Apache License, Version 2.0.", "a/LICENSE"),
            (3, "long words " * 30 + "\nReleased under the MIT License.", "a/b/d.txt"), (4, None, None), (5, "x", "z/y.txt")]
    got = {r.doc_id: (r.license, r.found) for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string, path string")).collect()}
    assert got == {1: ("Apache-2.0", "inherited"), 2: ("Apache-2.0", "file"), 3: ("MIT", "header"), 4: (None, "none"), 5: (None, "none")}
    assert license.scan(empty.withColumnRenamed("source", "path")).count() == 0


def test_licences_in_every_window(spark):
    """Notices far behind a hint, with template words on both sides, broken lines, no hint at all; against all windows of short texts."""
    filler = "the of to in this and " * 30
    rows = [(1, f"license {filler}released under the MIT License"), (2, f"Released under the MIT License {filler}"),
            (3, "this is free and unencumbered software released into the public\ndomain"), (4, "prose " * 9 + "you may not use this file except in compliance with the " + "x " * 9),
            (5, "license of the house " + filler)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "cast(null as string) as path")
    got = {r.doc_id: (r.license, r.score) for r in license.scan(docs, threshold=0.6).collect()}
    assert got[1] == got[2] == ("MIT", 1.0) and got[3] == ("Unlicense", 1.0) and got[4][0] == "Apache-2.0" and got[5] == (None, 0.0)
    rng, names = np.random.default_rng(4), [license.words_of(t) for _, t in license.TEMPLATES]
    for floor in (0.7, 0.4) * 10:
        m = license.Matcher(100, {t: int(rng.integers(0, 90)) for t in license._ALL_TERMS}, floor)
        w = [x for k in rng.integers(0, len(names), 3) for x in ["foo", "of", *names[k], "the"] if rng.random() > 0.2][:30]
        best = (None, 0.0)
        for s in range(len(w)):
            for e in range(s, len(w)):
                v = {t: k * m.weight[m.row.get(t, m.other)] for t, k in license.terms_of(w[s:e + 1]).items()}
                for name, terms in license._TERMS:
                    u = {t: k * m.weight[m.row[t]] for t, k in terms.items()}
                    c = sum(x * u[t] for t, x in v.items() if t in u) / np.sqrt(sum(x * x for x in v.values()) * sum(x * x for x in u.values()))
                    best = (name, c) if c > best[1] + 1e-12 else best
        name, c, _ = m.scan(" ".join(w))
        assert (name, round(c, 9)) == ((best[0], round(best[1], 9)) if best[1] >= floor else (None, 0.0))


def test_cross_entropy_difference(spark, odd, empty):
    docs = spark.createDataFrame([(i, "red green blue " * 9 if i % 2 else "one two three " * 9) for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in lmscore.score(docs, labels).collect()}
    assert all((got[i].score < 0) == bool(i % 2) for i in range(20))
    rows = lmscore.score(odd, labels).collect()
    assert len(rows) == odd.count() and all(r.score is None for r in rows if not r.n_tokens)
    assert lmscore.score(empty, labels).count() == 0


def test_cross_entropy_against_brute_force(spark):
    """Exact counts of more words than 16 bits and of every bigram."""
    ship(spark)
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 30 if i % 3 else 90_000, 200 if i % 3 else 6000))) for i in range(90)]
    rows += [(90, rows[0][1]), (91, "never seen"), (None, rows[1][1])]
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(80)], "doc_id long, quality int, toxic int")
    sides = [[Counter(), Counter(), Counter()] for _ in range(2)]
    good = {i for i in range(80) if i % 2 == 0}
    for i, text in rows:
        w = text.split()
        word, pair, context = sides[i not in good]
        word.update(w)
        pair.update(zip([""] + w, w))
        context.update([""] + w[:-1])
    vocabulary = len(set(sides[0][0]) | set(sides[1][0]))
    assert vocabulary > 1 << 16
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_tokens, r.loss_target, r.loss_background)
                 for r in lmscore.score(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect())
    want = []
    for i, text in rows:
        w, mean = text.split(), []
        for word, pair, context in sides:
            total = word.total() + 0.5 * vocabulary
            mean.append(-np.mean([np.log((pair[a, b] + 4 * (word[b] + 0.5) / total) / (context[a] + 4)) for a, b in zip([""] + w, w)]))
        want.append((-1 if i is None else i, len(w), *mean))
    assert np.allclose(got, sorted(want), atol=1e-9)


def test_audit_without_links_in_the_sample():
    """A graph with most ties lost, rare pairs between two shards and a hot group: no sampled row is linked, yet the beam must widen."""
    rng = np.random.default_rng(12)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x, q = unit(rng.normal(size=(2500, 24))), unit(rng.normal(size=(hnsw.BLOCK, 24)))
    sampled = set(np.linspace(0, hnsw.BLOCK - 1, hnsw.AUDIT).astype(int).tolist())
    rare = [i for i in range(0, hnsw.BLOCK, 7) if i not in sampled]
    x[100:100 + len(rare)] = unit(q[rare] + 0.01 * rng.normal(size=(len(rare), 24)))
    x[1500:] = unit(unit(rng.normal(size=(1, 24))) + 0.01 * rng.normal(size=(1000, 24)))
    x = x[rng.permutation(len(x))]
    for hot in (False, True):
        if hot:
            q[0] = x[np.argmax((x @ x.T >= 0.93).sum(1))]  # a sampled row with a thousand links
        graph = hnsw.Graph.build(x.astype(np.float32))
        graph.layers[0][1][:, 3:] = -1
        got = hnsw.linked(graph, q.astype(np.float32), x, q, 0.93)
        true = np.nonzero(q @ x.T >= 0.93)
        found = set(zip(*(a.tolist() for a in got)))
        assert len(found & set(zip(*(a.tolist() for a in true)))) >= 0.999 * len(true[0]) - 1 and {i for i, _ in found} >= set(rare)


def test_wide_beam_in_bounded_memory():
    """A beam of 1,024 for a whole block finds the same in bounded memory; a block is searched once, after its sample."""
    rng = np.random.default_rng(31)
    x = rng.normal(size=(3000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph, q = hnsw.Graph.build(x), x[:hnsw.BLOCK]
    tracemalloc.start()
    ids, sims = graph.search(q, 1024)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20
    want = np.sort(q @ x.T, axis=1)[:, -10:]
    assert np.mean(np.abs(np.sort(sims, axis=1)[:, -10:] - want) < 1e-5) > 0.99 and (ids >= -1).all()
    rows, search = [], hnsw.Graph.search
    hnsw.Graph.search = lambda self, q, w: rows.append(len(q)) or search(self, q, w)
    try:
        hnsw.linked(graph, q, x.astype(float), q.astype(float), 0.93)
    finally:
        hnsw.Graph.search = search
    assert rows.count(hnsw.BLOCK) <= 1


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 1), (7, 7), (8, None)], "a long, b long")
    assert {r.node: r.component for r in components(edges).collect()} == {1: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8}


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for _, stage in pipeline.STAGES[:-1]:
        before, docs = docs.count(), stage(spark, docs, sf_dir)
        assert docs.columns == columns and 0 < docs.count() <= before
    assert pipeline.run(spark, sf_dir).count() == docs.count()


def test_language_sends_a_text_to_python_once_and_shuffles_none_for_its_sample(spark):
    docs = spark.createDataFrame([(i, f"ein kleiner text {i}" if i % 2 else f"some small text {i}", "de" if i % 2 else "en") for i in range(40)],
                                 "doc_id long, text string, lang string")
    sampled = langid.sample(docs, ~langid.held_out(docs["doc_id"]), "doc_id", "text", "lang")
    plan = sampled._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan
    assert sorted(sampled.collect()) == sorted((r.text, r.lang) for r in docs.where(~langid.held_out(docs["doc_id"])).collect())
    whole, narrow = langid.identify(docs, keep=docs.columns), langid.identify(docs)
    assert "text_to_read" not in whole._jdf.queryExecution().analyzed().toString()
    assert sorted(whole.select("doc_id", "lang_pred", "score").collect()) == sorted(narrow.select("doc_id", "lang_pred", "score").collect())


def test_scores_of_more_words_than_there_is_room_for(monkeypatch):
    monkeypatch.setattr(langid, "_MEMO", 3)
    model = langid.fit(iter([("the small house", "en"), ("das kleine haus", "de")]))
    scores = langid.Scores(model)
    for words in (["the", "hose", "kleiner"], ["houses", "hose", "smaller", "das"], [f"w{c}use" for c in "abcdefgh"], ["haus", "the"]):
        assert np.array_equal(scores.of(words), np.array([model.of_word(w) for w in words]))
        assert len(scores.at) <= len(scores.values)


def test_a_worker_keeps_tables_for_one_operator_at_a_time():
    first = common.worker_tables("test first")
    first["table"] = 1
    assert common.worker_tables("test first") is first
    assert common.worker_tables("test second") == {}
    assert common.worker_tables("test first") == {}


def test_first_document_of_a_root_is_found_without_a_sort_also_where_ids_repeat(spark):
    passage, other = " ".join(f"p{i}" for i in range(80)), " ".join(f"q{i}" for i in range(80))
    texts = [(3, f"{passage} {' '.join(f'a{i}' for i in range(30))}"), (3, f"{' '.join(f'b{i}' for i in range(30))} {passage}"),
             (3, other), (9, f"{passage} c1 c2 c3"), (9, f"d1 d2 {other}")]
    for part in (texts, texts[::-1]):
        docs = spark.createDataFrame(part, "doc_id long, text string").coalesce(1)
        h = {r.text: r.h for r in docs.select("text", F.hash("text").alias("h")).collect()}
        early, late = sorted(h[t] for i, t in texts[:2])
        got = {(r.doc_id, r.h, r.source_id) for r in windows.duplicate_passages(docs).collect()}
        assert got == {(3, late, 3), (9, h[texts[3][1]], 3), (9, h[texts[4][1]], 3)}
    roots = spark.createDataFrame([(1, 5, 7, 0), (1, 4, 2, 0), (2, 4, 2, 3), (2, 4, 2, 9), (3, 6, 8, 0), (3, 6, 1, 0)], "key long, id long, h int, at int")
    firsts = windows._firsts(roots)
    assert sorted((r.key, r.id_a) for r in firsts.collect()) == [(1, 4), (3, 6)]


def test_shingles_of_many_texts_at_once(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 50, n).astype(np.uint32).tobytes() for n in (0, 3, 5, 400, 4, 70_000, 12)]
    each = [minhash.shingles(np.frombuffer(t, np.uint32).astype(np.uint64), 5) for t in texts]
    for a, b in zip(each, windows._shingled(texts, 5), strict=True):
        assert np.array_equal(a, b)


def test_licences_of_many_files_are_joined_without_a_broadcast(spark):
    """Files by their folders: what an ancestor says goes to every folder once, and no side of a join whose rows grow with the files is sent to the driver."""
    notice = "Released under the MIT License."
    rows = [(0, notice, "top/LICENSE"), (1, "Licensed under the ISC License.", "top/a/LICENSE"), (2, None, "top/a/none"), (3, notice, None), (4, "x", None),
            (5, "x", "elsewhere/f"), (6, "x", "f"), (7, "x", "/f"), (8, "x", ""), (9, "Licensed under the ISC License.", "/LICENSE")]
    rows += [(10 + i, "prose", f"top/{'ab'[i % 2]}/{i % 7}/f{i}") for i in range(300)] + [(10, "prose", "top/b/0/f0")]
    out = license.scan(spark.createDataFrame(rows, "doc_id long, text string, path string"))
    got = sorted((r.doc_id, r.license, r.found, r.score) for r in out.collect())
    want = [(0, "MIT", "file", 1.0), (1, "ISC", "file", 1.0), (2, "ISC", "inherited", 1.0), (3, "MIT", "file", 1.0), (4, None, "none", 0.0), *[(k, "ISC", "inherited", 1.0) for k in (5, 6, 7, 8)],
            (9, "ISC", "file", 1.0)]
    want += [(10 + i, "MIT" if i % 2 else "ISC", "inherited", 1.0) for i in range(300)] + [(10, "MIT", "inherited", 1.0)]
    assert got == sorted(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_every_pair_of_a_group_at_once(monkeypatch):
    """Passages of all pairs from one index, against those of each pair: lines in any order, versions, repeated words, two sides, two clusters, few places at once."""
    rng = np.random.default_rng(31)
    lines = [[f"l{k}w{i}" for i in range(rng.integers(3, 40))] for k in range(9)] + [["again"] * 30]
    texts = [[w for k in rng.integers(0, 10, 12) for w in lines[k]] for _ in range(24)] + [["short"] * 12, []]
    version = [f"v{i}" for i in range(150)]
    for _ in range(12):
        texts.append([f"n{rng.integers(1 << 40)}" for _ in range(7)] + version)
        version = _drift(version, rng, 2)
        version = version[:60] + version[61:] if rng.random() < 0.3 else version
    of = [minhash.shingles(minhash.word_hashes(" ".join(t)), 5) for t in texts]
    clusters, blocks = np.arange(len(of)) // 30, np.arange(len(of)) % 2
    walked, chained = [], windows._chained
    monkeypatch.setattr(windows, "_chained", lambda *a: walked.append(1) or chained(*a))
    every = {}
    for b in range(len(of)):
        for a in range(b):
            every[b, a] = windows.passages(of[a], of[b], 46, 80)
    assert sum(map(bool, every.values())) > 60
    for most in (1 << 20, 300):
        monkeypatch.setattr(windows, "ENTRIES", most)
        for salt, side in ((np.zeros(len(of), int), None), (clusters, None), (np.zeros(len(of), int), blocks)):
            got = {}
            for b, a, s, e in windows.every_pair(of, salt, side, 46, 80).tolist():
                got.setdefault((b, a), []).append((s, e))
            want = {(b, a): v for (b, a), v in every.items() if v and salt[a] == salt[b] and (side is None or side[a] != side[b])}
            assert {k: sorted(v) for k, v in got.items()} == want
    walked.clear()
    line = [f"x{i}" for i in range(30)]
    same = [minhash.shingles(minhash.word_hashes(" ".join([f"n{k}-{i}" for i in range(9)] + line * (1 + (k % 10 == 0)) + [f"m{k}-{i}" for i in range(60)])), 5) for k in range(200)]
    assert {(b, a) for b, a, _, _ in windows.every_pair(same, np.zeros(200, int), None, 46, 80).tolist()} == {(b, a) for b in range(0, 200, 10) for a in range(0, b, 10)}
    assert len(walked) < 20 * 200  # documents that share a line only are not followed pair by pair
    assert len(windows.every_pair([], np.zeros(0, int), None, 46, 80)) == 0


def test_passages_of_every_source_of_a_hot_root(spark, monkeypatch):
    """A passage stands in 60 documents; of what some of them say behind it, each is repeated from another one than the first, and by less than a run's words."""
    ship(spark)
    rng = np.random.default_rng(33)
    fresh = lambda n: [f"n{rng.integers(1 << 40)}" for _ in range(n)]
    passage = [f"p{i}" for i in range(70)]
    ends = [[f"e{k}-{i}" for i in range(9)] for k in range(20)]
    texts = [fresh(30) + passage + (ends[k % 20] if k % 3 else []) + fresh(30) for k in range(60)] + [fresh(90) for _ in range(5)]
    rows = [(int(i), " ".join(t)) for i, t in zip(rng.permutation(len(texts)), texts)]
    s = {i: minhash.shingles(minhash.word_hashes(t), 5) for i, t in rows}
    want = {(j, i) for j in s for i in range(j) if windows.passages(s[i], s[j], 46, 80)}
    docs = spark.createDataFrame(rows + rows[:9], "doc_id long, text string").repartition(5)
    for block in (1024, 16):  # one bucket, and blocks that meet in pairs
        monkeypatch.setattr(windows, "BLOCK", block)
        found = windows.duplicate_passages(docs)
        got, words = set(), {}
        for r in found.collect():
            got.add((r.doc_id, r.source_id))
            words.setdefault(r.doc_id, set()).update(range(r.from_word, r.to_word))
        assert got == want and len(want) == 60 * 59 // 2
        for j in words:
            assert words[j] == {w for i in range(j) for a, b in windows.passages(s[i], s[j], 46, 80) for w in range(a, b + 4)}
        each, few = (sorted(map(tuple, windows.representatives(f).collect())) for f in (found, windows.duplicate_passages(docs, every_source=False)))
        assert each == few and {r[0]: r[5] for r in few if r[5]} == {j: sum(b == j for b, _ in want) for j in words}


def test_pipeline_cuts_what_any_earlier_document_has(spark):
    """40 documents share a passage; the two words that some have behind it stand in another one than the first, and no root need lie there."""
    import corpus_pipeline
    rng = np.random.default_rng(35)
    fresh = lambda n: [f"n{rng.integers(1 << 40)}" for _ in range(n)]
    passage, ends = [f"p{i}" for i in range(60)], [[f"e{k}-{i}" for i in range(2)] for k in range(7)]
    parts = [(fresh(30), (ends[k % 7] if k % 4 else []), fresh(30)) for k in range(40)]
    texts = [" ".join(a + passage + e + b) for a, e, b in parts]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.passages(spark, docs.repartition(3), "").collect()}
    s, want = [minhash.shingles(minhash.word_hashes(t), 5) for t in texts], {}
    for j, t in enumerate(texts):
        gone = {w for i in range(j) for a, b in windows.passages(s[i], s[j], 46, 80) for w in range(a, b + 4)}
        want[j] = " ".join(w for k, w in enumerate(t.split()) if k not in gone)
        assert not j or len(gone) >= 60
    assert got == {j: (t, len(t)) for j, t in want.items()}
    assert want[37] == " ".join(parts[37][0] + parts[37][2])
