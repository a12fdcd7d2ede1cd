"""The prefix trie against a dictionary of prefixes in Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from storepulse.llm import trie
from storepulse.llm.common import ship

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _sequences(rows):
    """Rebuilt conversations; ties of a turn by the id of role and text."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, key, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = int(c / 20) * 20
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def _brute(seqs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out, done = [], {}
    for p in sorted(members, key=len, reverse=True):
        kids = children[p]
        leaves = 1 if not kids else sum(done[k][0] for k in kids)
        saved = (len(members[p]) - 1) * len(WORDS.findall(p[-1][1])) if p else 0
        saved += sum(done[k][1] for k in kids)
        done[p] = leaves, saved
        up = min(members[p[:-1]]) if p else None
        text = ",".join(map(str, sorted(ends[p])))
        out.append((min(members[p]), len(p), up, len(members[p]), len(kids), leaves, saved, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def _got(spark, rows):
    ship(spark)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn int, role string, text string, shard int, node string")
    out = trie.prefix_trie(*trie.rebuilt(trie.turns_of(df)))
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def _random(seed, convs, hot):
    rnd = random.Random(seed)
    rows = []
    for c in range(convs):
        if c % 3 == 0 and hot:
            texts = ["hot one", "hot two words", "hot"]
        else:
            texts = [rnd.choice(["a b", "c", "d e f", "", "g\nh"]) for _ in range(rnd.choice([0, 1, 2, 3, 6]))]
        rows += [(c, t, rnd.choice(["user", "assistant"]) if not hot else "user", x) for t, x in enumerate(texts)]
    rnd.shuffle(rows)
    return rows


ODD = [(0, 1, "user", "hi there"), (0, None, None, None), (0, 1, "user", "hi there"), (0, 2, "user", ""), (21, 1, "user", "a\tb\x0bc"),
       (21, 1, "user", "a"), (21, 1, "user", "a"), (None, 1, "user", "lost"), (23, None, "user", "x"), (24, 5, None, "é　x"), (-3, 1, "u", "neg"), (-3, 2, "u", "neg 2"),
       (40, 1, "user", "same"), (41, 1, "user", "same"), (42, 1, "user", "same")]
LONG = [(c, t, "user", f"turn {t % 7} of a very long conversation") for c in (60, 61, 62) for t in range(700 + c)] + [(63, 0, "a", "word " * 40_000)]


def test_odd_rows(spark):
    assert _got(spark, ODD) == _brute(_sequences(ODD))


def test_long_conversations(spark):
    rows = LONG + ODD
    assert _got(spark, rows) == _brute(_sequences(rows))


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True)])
def test_random_conversations(spark, seed, hot):
    rows = _random(seed, 400, hot)
    assert _got(spark, rows) == _brute(_sequences(rows))


def test_empty_table(spark):
    assert _got(spark, []) == []
    assert _got(spark, [(None, 1, "a", "b")]) == []


@pytest.mark.parametrize("cells", [1, 7, 40])
def test_nodes_over_many_shards(spark, monkeypatch, cells):
    """Shards of a few rows: nearly all nodes are boundary nodes; a third of the conversations are equal."""
    rows = _random(cells, 300, True)
    monkeypatch.setattr(trie, "CELLS", cells)
    assert _got(spark, rows) == _brute(_sequences(rows))


@pytest.mark.parametrize("width,cells", [(1, 1 << 20), (2, 5), (3, 40), (2, 1)])
def test_conversations_of_several_bands(spark, monkeypatch, width, cells):
    """Bands of a few turns, so that conversations have up to seven of them, end at a band's last turn, and share parts of them."""
    rnd = random.Random(width * 100 + cells)
    rows = [(c, t, "u", rnd.choice(["a b", "c", "d e f"]) if rnd.random() < 0.3 else "same words here") for c in range(120) for t in range(rnd.choice([0, 1, 2, 3, 4, 5, 6, 7]))]
    rows += [(c, t, "u", f"hot {t}") for c in range(200, 260) for t in range(6)] + [(300, t, "u", "x " * t) for t in range(9)] + [(301, t, "u", "x " * t) for t in range(9)]
    monkeypatch.setattr(trie, "WIDTH", width)
    monkeypatch.setattr(trie, "CELLS", cells)
    assert _got(spark, rows) == _brute(_sequences(rows))


def test_long_equal_conversations(spark, monkeypatch):
    rows = [(c, t, "u", f"turn {t}") for c in (400, 401) for t in range(500)] + [(402, t, "u", f"turn {t}" if t < 450 else f"other {t}") for t in range(600)]
    monkeypatch.setattr(trie, "WIDTH", 64)
    assert _got(spark, rows) == _brute(_sequences(rows))


def test_one_shard_does_not_need_sorted_rows():
    turns = [[1, 2], [], [1, 2, 3], [2], [1, 2]]
    convs = np.array([5, 9, 7, 1, 3])
    ids = [b"".join(int(x).to_bytes(trie.ID_BYTES, "big") for x in t) for t in turns]
    none = np.zeros(5, np.int64)
    out = trie._shard(0, [b""] * 5, ids, convs, np.array([x for t in turns for x in t]), none > 0, none, none, 0, trie.WIDTH)
    got = sorted(zip(out["depth"], out["conv_id"], out["n_convs"]))
    assert got == [(0, 1, 5), (1, 1, 1), (1, 3, 3), (2, 3, 3), (3, 7, 1)]
