"""Helpers shared by the training-data operators: shared scratch tables, components, batches.

Intermediate tables are written below the folder that ``spark.checkpoint.dir`` names, so
they survive the loss of an executor; nothing is kept on a machine's own disk.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from storepulse.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new shared table and read it back: cuts lineage and recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application; Spark hands the file to each of them."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    name = Path(tempfile.mkdtemp(prefix="storepulse-ship-")) / "storepulse.zip"
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(name))
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, columns) -> str:
    """``name``, lengthened until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(values: list, limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Index ranges of ``values`` (texts) of about ``limit`` characters, one value at least."""
    yield from ranges([len(v or "") for v in values], limit)


def ranges(sizes: list[int], limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Index ranges of values of these sizes, of about ``limit`` together, one value at least."""
    start, size = 0, 0
    for i, n in enumerate(sizes):
        size += n
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


_TABLES: dict[str, dict] = {}


def worker_tables(name: str) -> dict:
    """Tables that a worker keeps over its tasks for ``name``; those it kept for other work are let go, as a worker serves one stage after another."""
    if name not in _TABLES:
        _TABLES.clear()
        _TABLES[name] = {}
    return _TABLES[name]


def record_batch(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """(node, root) of the components of the links a-b."""
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        parent.setdefault(v, v)
        while parent[v] != v:
            parent[v] = v = parent[parent[v]]
        return v

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [(v, root(v)) for v in list(parent) if root(v) != v]


def components(edges: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable over undirected ``edges`` (a, b), for every node of an edge.

    Each round maps every node to the smallest of itself and its neighbours and relabels
    the edges; rounds end when no edge joins two labels. Per-node minima are aggregated
    before the shuffle, so a hub with very many neighbours is no hot group. Nulls and
    self-loops are ignored; empty input gives an empty result.
    """
    spark = edges.sparkSession
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        near = stored(near.select("node", F.least("node", "m").alias("label")), "labels")
        maps.append(near)
        left = near.select(F.col("node").alias("a"), F.col("label").alias("la"))
        right = near.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        edges = edges.join(left, "a").join(right, "b").where("la <> lb")
        edges = stored(edges.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(), "edges")
    if not maps:
        return spark.createDataFrame([], "node long, component long")
    out = maps[0].select("node", F.col("label").alias("component"))
    for step in maps[1:]:
        step = step.select(F.col("node").alias("component"), "label")
        out = out.join(step, "component", "left").select("node", F.coalesce("label", "component").alias("component"))
    return out
