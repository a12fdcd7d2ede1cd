"""Every catalogue query against its DuckDB oracle at sf 0.01 (rows, columns, values)."""

import math
import os

import duckdb
import pytest

from conftest import SF01

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF01}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, res.fetchall())


def test_json_answer_has_rows(spark):
    import json
    r = E.queries()["sale_summary_json"](spark, SF01).collect()
    assert len(r) == 1
    ans = json.loads(r[0][0])
    assert set(ans) == {"total", "stat", "detail"} and len(ans["detail"]) == 10
