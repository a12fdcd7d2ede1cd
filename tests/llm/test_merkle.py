"""The Merkle manifest against a plain tree in Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from storepulse.llm import merkle
from storepulse.llm.common import ship


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _tree(leaves):
    """(root, siblings of every level for every leaf)."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, p in enumerate(paths):
            lo = at[i] - at[i] % 3
            p.append((level[lo:at[i]], level[at[i] + 1:lo + 3]))
            at[i] //= 3
        level = [_h(*level[i:i + 3]) for i in range(0, len(level), 3)]
    return level[0], paths


def _brute(rows):
    groups = defaultdict(list)
    for doc_id, source, lang, n, text in rows:
        odd = text
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None:
            odd = text.replace("\n", "")
        leaf, bad = (_h(*map(_enc, (doc_id, source, lang, n, t))) for t in (text, odd))
        groups[source].append((doc_id is not None, doc_id or 0, leaf, bad, doc_id))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(groups[s]), *_tree([x[2] for x in sorted(groups[s])])) for s in order}
    root, above = _tree([trees[s][1] for s in order])
    out = []
    for s, up in zip(order, above):
        leaves, sub, paths = trees[s]
        for (_, _, leaf, bad, doc_id), path in zip(leaves, paths):
            acc, flat = bad, []
            for left, right in path + up:
                flat += left + right
                acc = _h(*left, acc, *right)
            out.append((doc_id, leaf, sub, root, _h(*flat), acc, acc == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, d string, idx int, path string"


def _df(spark, rows):
    ship(spark)
    return spark.createDataFrame([(*r, "x", 7, "p") for r in rows], SCHEMA)


def _got(df):
    out = merkle.verified(merkle.manifest(df, merkle.without_newlines(df)))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=str)


ODD = [(1, "b", "en", 3, "a\nb"), (2, None, None, None, None), (None, "b", "en", 1, "x\n"), (3, "", "", 0, ""), (3, "", "", 0, ""),
       (3, "", "", 0, "\n\n"), (4, "é", "fr", 5, "中文\n" * 5), (5, "z", "en", 1, "long line\n" * 30_000), (-7, "b", None, 2, "1:2"), (8, "b", "en", 3, "c\n")]


def test_odd_rows(spark):
    assert _got(_df(spark, ODD)) == _brute(ODD)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [1, 1, 1, 1], [9, 10, 27, 28]])
def test_small_trees(spark, sizes):
    rows = [(i * 100 + j, f"s{i}", "en", j, f"t{j}\n") for i, n in enumerate(sizes) for j in range(n)]
    assert _got(_df(spark, rows)) == _brute(rows)


def test_more_than_one_round(spark, monkeypatch):
    """Blocks of nine, so that sources and subroots take several rounds; a hot source, repeated ids and rows."""
    monkeypatch.setattr(merkle, "DEPTH", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = [(i, "hot", "en", 1, f"line {i}\n") for i in range(260)] + [(7, "hot", "en", 1, "line 7\n")] * 120
    rows += [(1000 + i, f"s{i % 31}", None, i, f"{i}\n") for i in range(120)]
    assert _got(_df(spark, rows)) == _brute(rows)


def test_default_blocks_over_two_rounds(spark):
    rows = [(i, "one" if i % 3 else "two", "en", 1, f"{i}\n") for i in range(3000)]
    assert _got(_df(spark, rows)) == _brute(rows)


def test_empty_table(spark):
    df = _df(spark, ODD).limit(0)
    assert merkle.verified(merkle.manifest(df, merkle.without_newlines(df))).count() == 0


def test_no_tampering_verifies(spark):
    df = _df(spark, ODD)
    rows = merkle.verified(merkle.manifest(df)).collect()
    assert len(rows) == len(ODD) and all(r.verified for r in rows)
