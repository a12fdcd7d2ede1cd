"""Cross-entropy difference with matched models and left-out documents, over several shards and few hot words."""

import math
import os
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from storepulse.llm import lmscore
from storepulse.llm.common import ship


def _plain(rows, good, vocabulary, matched, leave_out):
    """Losses of every row from dictionaries, the row's own counts taken out one by one."""
    sides = [[Counter(), Counter(), Counter(), 0] for _ in range(2)]
    own = []
    for i, text in rows:
        w = (text or "").split()
        c = [Counter(w), Counter(zip([""] + w, w)), Counter(([""] + w[:-1]) if w else []), len(w)]
        own.append((i, w, c, 0 if i in good else 1))
        side = sides[own[-1][3]]
        for k in range(3):
            side[k].update(c[k])
        side[3] += len(w)
    ratio = sides[0][3] / sides[1][3] if matched and sides[0][3] and sides[1][3] else 1.0
    for i, w, c, mine in own:
        losses = []
        for k, (word, pair, context, total) in enumerate(sides):
            less, r = (c if leave_out and k == mine else [Counter(), Counter(), Counter(), 0]), (1.0, ratio)[k]
            loss = 0.0
            for a, b in zip([""] + w, w):
                share = (r * (word[b] - less[0][b]) + 0.5) / (r * (total - less[3]) + 0.5 * vocabulary)
                loss -= math.log((r * (pair[a, b] - less[1][a, b]) + 4 * share) / (r * (context[a] - less[2][a]) + 4))
            losses.append(loss / len(w) if w else None)
        yield i, len(w), *losses


def _same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], -1.0 if r[2] is None else round(r[2], 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2] and [x is None for x in g[2:]] == [x is None for x in w[2:]]
        assert all(x is None or abs(x - y) < 1e-8 for x, y in zip(g[2:], w[2:])), (g, w)


@pytest.mark.parametrize("matched, leave_out", [(True, True), (True, False), (False, True)])
def test_against_dictionaries(spark, monkeypatch, matched, leave_out):
    """Hot and cold words in every order, repeated rows and ids, one very long text, no text and texts without words."""
    ship(spark)
    monkeypatch.setattr(lmscore, "HOT", 24)
    monkeypatch.setattr(lmscore, "SHARD_TOKENS", 3000)
    monkeypatch.setattr(lmscore, "KNOWN", 300)
    rng = np.random.default_rng(3)
    text = lambda n: " ".join(f"w{int(k)}" for k in rng.zipf(1.3, n) % 5000)
    rows = [(i, text(int(rng.integers(0, 200)))) for i in range(120)] + [(120, text(9000)), (121, None), (122, ""), (123, "one"), (None, None)]
    rows += [rows[7], rows[7], (8, "another text of eight"), (None, rows[9][1]), (0, rows[120][1])]
    labels = spark.createDataFrame([(i, 1 if i % 3 == 0 else 0) for i in range(122)] + [(3, 1), (None, 1)], "doc_id long, quality int")
    good = {i for i in range(122) if i % 3 == 0}
    vocabulary = len({w for _, t in rows for w in (t or "").split()})
    got = lmscore.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), labels, matched=matched, leave_out=leave_out).collect()
    _same([(r.doc_id, r.n_tokens, r.loss_target, r.loss_background) for r in got], _plain(rows, good, vocabulary, matched, leave_out))


def test_one_word_in_all_rows_and_one_side_only(spark):
    """A word that makes every token; without target rows nothing is matched and the losses are finite."""
    ship(spark)
    rows = [(i, "same " * 50) for i in range(30)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = lmscore.score(docs, none, matched=True, leave_out=True).collect()
    _same([(r.doc_id, r.n_tokens, r.loss_target, r.loss_background) for r in got], _plain([(i, t) for i, t in rows], set(), 1, True, True))


def test_packed_columns():
    rng = np.random.default_rng(1)
    columns = {c: np.sort(rng.integers(0, 9, k)).astype(np.int64) for k, c in enumerate(lmscore._COLUMNS)}
    columns["words"] = np.array([0, 3, 1 << 63, (1 << 64) - 1], np.uint64)
    columns["n"] = np.array([1 << 40, 3])
    back = lmscore._unpack(lmscore._pack(columns))
    assert all(back[c].tolist() == columns[c].tolist() for c in lmscore._COLUMNS)
    docs, sums = np.array([0, 4, 900]), np.array([[-5, 1 << 50], [0, 3], [1 << 40, -1]])
    back = lmscore._answered(lmscore._answer(docs, sums))
    assert back[0].tolist() == docs.tolist() and back[1].tolist() == sums.tolist()
    assert len(lmscore._answered(lmscore._answer(docs[:0], sums[:0]))[0]) == 0
