"""Near-duplicate embeddings by hierarchical navigable small-world graphs per shard (operator 1).

Distinct vectors of one label are dealt to shards of about SHARD_ROWS by a hash. A task builds
the layered graph of one shard: vectors enter in growing batches, each searched in the graph
so far by all vectors of the batch at once, and are tied to diverse near neighbours in both
directions. Blocks of vectors then query every shard of their label (each pair of shards once,
as links have no direction). A beam that is full of links is widened until it is not, so no
link is lost to its width; before that a sample of the block is compared with the whole shard,
and its beam is doubled until each of them finds RECALL of its true links and
of its nearest vectors, linked or not, so a block without links in its sample is proven as well. The whole block is
searched with that beam. A beam as wide as the shard ends in a direct comparison. A step of a search holds
the vectors of GATHER bytes at once, whatever the beam.

Every link is verified by its cosine in double precision. A task counts links and returns
a spanning forest of those it saw, never all pairs; forests are united by ``components``.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from storepulse.llm.common import components, forest, stored
from storepulse.session import settings

SHARD_ROWS = 8192
BLOCK = 512
#: Neighbours chosen per vector, capacity per vector and layer, share of vectors in the next layer, first beam.
NEIGHBOURS, CAPACITY, UP, BEAM = 12, 32, 16, 32
#: Audit: vectors of a block compared with the whole shard, their nearest vectors looked for, and the share of these
#: and of their links that must be found for each of them.
AUDIT, AUDIT_NEAREST, RECALL = 32, 10, 0.995
#: Bytes of neighbours' vectors that a step of a search holds at once.
GATHER = 4 << 20
#: Vectors of a beam that are expanded at once, at least; an eighth of a wide beam.
_EXPAND = 4
#: Slack of single-precision search before the exact verification.
_SLACK = 1e-4


def _sims(q: np.ndarray, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Similarity of each query and its vectors ``ids``, -2 where there is none (-1); as many queries at once as GATHER holds."""
    out = np.empty(ids.shape, np.float32)
    step = max(1, GATHER // max(1, 4 * ids.shape[1] * x.shape[1]))
    for a in range(0, len(q), step):
        some = ids[a:a + step]
        out[a:a + step] = np.where(some >= 0, np.matmul(x[some], q[a:a + step, :, None])[:, :, 0], -2)
    return out


def _beam(q: np.ndarray, x: np.ndarray, near: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best ``width`` vectors that a search from ``start`` finds for each query: ids (-1: none) and similarities; queries in
    parts, so that their beams and the neighbours of a step stay in about GATHER bytes each."""
    part = max(1, GATHER // (16 * (width + max(_EXPAND, width // 8) * near.shape[1])))
    if len(q) > part:
        both = [_beam(q[a:a + part], x, near, start[a:a + part], width) for a in range(0, len(q), part)]
        return np.concatenate([i for i, _ in both]), np.concatenate([s for _, s in both])
    n, rows = len(q), np.arange(len(q))
    seen = np.zeros((n, len(x) + 1), bool)
    seen[:, -1] = True
    ids = np.full((n, width), -1)
    sims = np.full((n, width), -2.0, np.float32)
    done = np.ones((n, width), bool)
    m = min(width, start.shape[1])
    first = start[:, :m]
    seen[rows[:, None], first] = True
    sims[:, :m] = _sims(q, x, first)
    ids[:, :m], done[:, :m] = first, first < 0
    live = rows
    while len(live):
        e = min(max(_EXPAND, width // 8), width)
        open_ = np.where(done[live], -3, sims[live])
        pick = np.argpartition(-open_, e - 1, axis=1)[:, :e]
        ok = np.take_along_axis(open_, pick, 1) > -3
        going = ok.any(1)
        live, pick, ok = live[going], pick[going], ok[going]
        if not len(live):
            break
        done[live[:, None], pick] = True
        at = np.where(ok, ids[live[:, None], pick], -1)
        found = np.where(at[:, :, None] >= 0, near[at], -1).reshape(len(live), -1)
        found.sort(axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        found[seen[live[:, None], found]] = -1
        seen[live[:, None], found] = True
        found = found[:, (found >= 0).any(0)]
        s = _sims(q[live], x, found)
        all_s, all_i = np.concatenate([sims[live], s], 1), np.concatenate([ids[live], found], 1)
        all_d = np.concatenate([done[live], found < 0], 1)
        top = np.argpartition(-all_s, width - 1, axis=1)[:, :width]
        sims[live], ids[live], done[live] = (np.take_along_axis(v, top, 1) for v in (all_s, all_i, all_d))
    return ids, sims


def _diverse(ids: np.ndarray, sims: np.ndarray, x: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` candidates per row, nearest first, none nearer to a chosen one than to the row; gaps are filled by nearness."""
    order = np.argsort(-sims, axis=1, kind="stable")[:, :3 * most]
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    v = x[ids]
    among = np.matmul(v, v.transpose(0, 2, 1))
    chosen = np.zeros(ids.shape, bool)
    for k in range(ids.shape[1]):
        worst = np.where(chosen, among[:, k], -2).max(1)
        chosen[:, k] = (ids[:, k] >= 0) & (worst < sims[:, k]) & (chosen.sum(1) < most)
    rank = np.argsort(~chosen + 2 * (ids < 0), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, rank, 1)


class Graph:
    """Layers of one shard: members (rows of x) and neighbour table of each, the last layer on top."""

    def __init__(self, x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.x, self.layers = x, layers

    @classmethod
    def build(cls, x: np.ndarray) -> Graph:
        layers, members = [], np.arange(len(x))
        while True:
            layers.append((members, cls._layer(x[members])))
            if len(members) <= 2 * UP:
                return cls(x, layers)
            members = members[::UP]  # rows are in order of a hash, so every UP'th is a random draw

    @staticmethod
    def _layer(x: np.ndarray) -> np.ndarray:
        n = len(x)
        near = np.full((n + 1, CAPACITY), -1, np.int32)  # the last row is the neighbours of "none"
        size = min(n, NEIGHBOURS + 1)
        sims = x[:size] @ x[:size].T
        np.fill_diagonal(sims, -2)
        for i in range(size):
            order = np.argsort(-sims[i])[:size - 1]
            near[i, :len(order)] = order
        at = size
        while at < n:
            to = min(n, at + max(1, min(BLOCK, at // 2)))
            q = x[at:to]
            entry = np.unique(np.linspace(0, at - 1, min(at, 8)).astype(int))
            ids, s = _beam(q, x[:at], near[np.r_[0:at, n]], np.broadcast_to(entry, (len(q), len(entry))).copy(), 2 * BEAM)
            own = q @ q.T  # members of one batch see each other directly
            own[np.triu_indices(len(q))] = -2
            k = min(NEIGHBOURS, len(q))
            best = np.argpartition(-own, k - 1, axis=1)[:, :k]
            bs = np.take_along_axis(own, best, 1)
            ids, s = np.concatenate([ids, np.where(bs > -2, best + at, -1)], 1), np.concatenate([s, bs], 1)
            picked = _diverse(ids, s, x, NEIGHBOURS)
            near[at:to, :picked.shape[1]] = picked
            src, dst = np.repeat(np.arange(at, to), picked.shape[1]), picked.reshape(-1)
            src, dst = src[dst >= 0], dst[dst >= 0]
            for d in np.unique(dst):
                have = near[d][near[d] >= 0]
                new = np.setdiff1d(src[dst == d], have)
                if len(have) + len(new) <= CAPACITY:
                    near[d, len(have):len(have) + len(new)] = new
                else:
                    pool = np.concatenate([have, new])[None]
                    kept = _diverse(pool, (x[pool[0]] @ x[d])[None], x, CAPACITY - 4)[0]
                    near[d] = -1
                    near[d, :len(kept)] = kept
            at = to
        return near

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        start = np.zeros((len(q), 1), int)
        for k in range(len(self.layers) - 1, -1, -1):
            members, near = self.layers[k]
            wide = width if k == 0 else min(8, len(members))
            ids, sims = _beam(q, self.x[members], near, start, min(wide, len(members)))
            if k:
                below = self.layers[k - 1][0]
                start = np.where(ids >= 0, np.searchsorted(below, members[ids]), -1)
        return ids, sims

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, n=len(self.layers), **{f"m{i}": m.astype(np.int32) for i, (m, _) in enumerate(self.layers)},
                 **{f"g{i}": g.astype(np.int32) for i, (_, g) in enumerate(self.layers)})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes, x: np.ndarray) -> Graph:
        z = np.load(io.BytesIO(data))
        return cls(x, [(z[f"m{i}"].astype(np.int64), z[f"g{i}"]) for i in range(int(z["n"]))])


def _exact(q: np.ndarray, x: np.ndarray, qi: np.ndarray, xi: np.ndarray, threshold: float) -> np.ndarray:
    return np.einsum("nd,nd->n", q[qi], x[xi]) >= threshold


def linked(graph: Graph, q: np.ndarray, exact_x: np.ndarray, exact_q: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) index pairs with a cosine of ``threshold`` or more; widens the beam until the audit passes."""
    n, floor = len(graph.x), threshold - _SLACK
    some = np.unique(np.linspace(0, len(q) - 1, min(AUDIT, len(q))).astype(int))
    sims = q[some] @ graph.x.T
    true, k = (sims >= floor).sum(1), min(AUDIT_NEAREST, n)
    least = np.partition(sims, n - k, axis=1)[:, n - k] - _SLACK / 10  # of the k nearest, linked or not

    def beam(todo: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        out, w, first = [], min(width, n), None
        while len(todo):
            if w >= n:
                i, j = np.nonzero(q[todo] @ graph.x.T >= floor)
                out.append((todo[i], j))
                break
            ids, sims = graph.search(q[todo], w)
            first = sims if first is None else first
            full = (sims >= floor).all(1)
            i, c = np.nonzero((sims >= floor) & ~full[:, None])
            out.append((todo[i], ids[i, c]))
            todo, w = todo[full], min(4 * w, n)
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out]), first

    width = 2 * BEAM
    while width < n:  # a row's search is the same alone and in its block: the sample is widened, then the block is searched once
        i, _, first = beam(some, width)
        found = np.bincount(i, minlength=len(q))[some]
        nearest = np.minimum((first >= least[:, None]).sum(1), k)
        if ((found >= RECALL * true) & (nearest >= RECALL * k)).all():  # the worst row decides
            break
        width *= 2
    i, j, _ = beam(np.arange(len(q)), width)
    ok = _exact(exact_q, exact_x, i, j, threshold)
    return i[ok], j[ok]


def _matrix(blob: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(blob, np.float64).reshape(-1, dim)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label",
                    threshold: float = 0.93) -> DataFrame:
    """(``id_col``, n_links, component_id, kept): links of vectors with equal, non-null labels and a cosine of ``threshold`` or more.

    One row per input row. Vectors that are null, empty, zero or hold null or non-finite components,
    rows without a label and rows without an id link with nothing (component: their own id; kept).
    Vectors of different length never link. Equal vectors are one node of the graph and count each
    other as links; rows that repeat an id count as vectors of their own and share its component.
    """
    label = F.col("label")
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vec_col].cast("array<double>").alias("v"),
                          (vectors[label_col].cast("string") if label_col else F.lit("")).alias("label"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    valid = F.col("id").isNotNull() & label.isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda c: c != 0)
    rows = rows.withColumn("valid", F.coalesce(valid, F.lit(False)))
    # -0.0 and 0.0 are one value; length is part of the group a vector is compared in
    rows = stored(rows.withColumn("key", F.when(F.col("valid"), F.xxhash64(F.transform("v", lambda c: c + F.lit(0.0))))), "vectors")
    good = rows.where("valid")
    # the hash only names a vector: two with one hash would have to agree in 64 bits and label
    reps = good.groupBy("label", "key").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    first = good.join(reps.withColumnRenamed("rep", "id"), ["label", "key", "id"]).select(
        "label", "key", "id", "v", "copies", F.size("v").alias("dim")).dropDuplicates(["label", "key"])
    sizes = first.groupBy("label", "dim").agg(F.count("*").alias("n"))
    sizes = sizes.select("label", "dim", F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("shards"))
    dealt = first.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod("key", F.col("shards")).cast("int"))

    def index(key, batch):
        t = batch.sort_by("key")
        dim = t.column("dim")[0].as_py()
        v = t.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        v = v / np.abs(v).max(1, keepdims=True)  # squares neither vanish nor overflow
        v = v / np.sqrt((v * v).sum(1, keepdims=True))
        graph = Graph.build(v.astype(np.float32))
        return pa.table({"label": [key[0].as_py()], "dim": pa.array([dim], pa.int32()), "shard": pa.array([key[2].as_py()], pa.int32()),
                         "shards": pa.array([t.column("shards")[0].as_py()], pa.int32()), "ids": [t.column("id").to_numpy().tobytes()],
                         "copies": [t.column("copies").to_numpy().tobytes()], "v": [v.tobytes()], "graph": [graph.dump()]})

    kind = "label string, dim int, shard int, shards int, ids binary, copies binary, v binary, graph binary"
    graphs = stored(dealt.groupBy("label", "dim", "shard").applyInArrow(index, kind), "graphs")
    # every block of a shard queries the shards from its own on: each pair of shards meets once
    blocks = graphs.select("label", "dim", "shards", F.col("shard").alias("of"), F.col("ids").alias("q_ids"), F.col("copies").alias("q_copies"), F.col("v").alias("q"))
    blocks = blocks.withColumn("shard", F.explode(F.sequence("of", F.col("shards") - 1))).drop("shards")
    jobs = blocks.join(graphs.drop("shards"), ["label", "dim", "shard"])

    def query(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                x, q = _matrix(r["v"], r["dim"]), _matrix(r["q"], r["dim"])
                ids, q_ids = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["q_ids"], np.int64)
                copies, q_copies = np.frombuffer(r["copies"], np.int64), np.frombuffer(r["q_copies"], np.int64)
                graph, same = Graph.load(r["graph"], x.astype(np.float32)), r["of"] == r["shard"]
                n_q, n_x, edges_a, edges_b = np.zeros(len(q), np.int64), np.zeros(len(x), np.int64), [], []
                for s in range(0, len(q), BLOCK):
                    part = q[s:s + BLOCK]
                    a, b = linked(graph, part.astype(np.float32), x, part, threshold)
                    a = a + s
                    if same:
                        a, b = a[a != b], b[a != b]
                    np.add.at(n_q, a, copies[b])
                    if not same:
                        np.add.at(n_x, b, q_copies[a])
                    pairs = forest(q_ids[a], ids[b])
                    edges_a.extend(p[0] for p in pairs)
                    edges_b.extend(p[1] for p in pairs)
                there, other = np.flatnonzero(n_q), np.flatnonzero(n_x)
                src = np.concatenate([q_ids[there], ids[other], np.array(edges_a, np.int64)])
                dst = np.concatenate([q_ids[there], ids[other], np.array(edges_b, np.int64)])
                n = np.concatenate([n_q[there], n_x[other], np.zeros(len(edges_a), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array([r["label"]] * len(src), pa.string()), pa.array(src), pa.array(dst), pa.array(n)], names=["label", "a", "b", "n"])

    # a row is two shards and a graph: a worker holds one at a time
    with settings(vectors.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}):
        found = stored(jobs.repartition("label", "dim", "shard", "of").mapInArrow(query, "label string, a long, b long, n long"), "links")
    counts = found.where("a = b").groupBy("label", F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    own = good.join(reps, ["label", "key"]).select("id", F.col("rep"))
    edges = found.where("a <> b").select("a", "b").unionByName(own.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    comps = stored(components(edges), "components")
    nodes = reps.join(counts, ["label", "rep"], "left").select("label", "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.join(nodes, ["label", "key"], "left").join(comps, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
