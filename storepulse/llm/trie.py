"""Prefix trie of conversations from padded turn-id matrices (operator 13).

A turn's id is 128 bits of the SHA-256 of its role and text. Conversations are cut into bands of WIDTH
turns, so a row is bounded however long a conversation is; a later band carries the digest of all turns before
it. Rows are range-partitioned and sorted by band, digest and ids; one that ends sorts behind those that go
on. Each task takes its range in shards of a bounded number of cells: a padded matrix of turn ids,
ordered by numpy's lexsort, whose column changes, OR-accumulated along each row, mark where nodes
start; ``reduceat`` over these starts aggregates every depth.

All figures of a node are sums over its rows and over the node starts among them: a childless node
is one whose first row ends there, and ``saved`` is the words of all rows below a node less those
of the starts. Nodes inside a shard are whole. Only the nodes on the path of a shard's first or
last row may go on in a neighbour, and only the last depth of a band in the next one: those boundary nodes go out
with a digest of their path and recombine in Spark, which also decides which of the first row's
nodes start there and not in an earlier shard. Where conversations have several bands, a first pass finds what the
later bands of each add to the nodes of its earlier ones. A group of equal conversations of
any size is split by conv_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from storepulse.llm.common import stored
from storepulse.llm.merkle import numbered

ID_BYTES = 16
#: Turns of a band, and cells of a shard's matrix, padding included (one row may have more).
WIDTH = 1024
CELLS = 1 << 20
#: Conversation ids in one piece of text of a boundary node's ends.
PIECE = 256
_EMPTY = hashlib.sha256(b"").hexdigest()
_LONGS = ("shard", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words", "band")
_PARTS = pa.schema([*((n, pa.int64()) for n in _LONGS), ("node", pa.string()), ("parent", pa.string()), ("ends_sha256", pa.string()),
                    ("first", pa.bool_()), ("last_turn", pa.bool_()), ("ends", pa.list_(pa.string()))])
_PARTS_DDL = ", ".join(f"{n} long" for n in _LONGS) + ", node string, parent string, ends_sha256 string, first boolean, last_turn boolean, ends array<string>"
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, id, words) of every turn: null roles and texts are empty, rows without a conv_id belong to no
    conversation, rows that repeat are turns of their own; other columns are not read. Texts go no further than this:
    an id has 32 hex digits. Written, for it is read several times."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return stored(conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].alias("turn"),
        F.substr(digest, F.lit(1), F.lit(2 * ID_BYTES)).alias("id"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words")), "turns")


def rebuilt(turns: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Each conversation c with its first h turns replaced by those of conversation c - c % group, h = crc32(decimal c) % heads.

    All if that one has fewer, none if it is absent; then c's own turns after its first h, if any. Turns are in order of
    ``turn``, null first, ties by id. Returns (conv_id, depth, id, words), depths from 0, and (conv_id, length).
    """
    sizes = stored(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size")), "sizes")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    base = F.col("conv_id") - F.col("conv_id") % group
    other = sizes.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    convs = sizes.withColumns({"h": h, "base": base}).join(other, "base", "left")
    convs = convs.withColumn("k", F.least("h", F.coalesce("base_size", F.lit(0))))
    convs = stored(convs.select("conv_id", "base", "h", "k", (F.col("k") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("length")), "conversations")
    placed = numbered(turns, "conv_id", ["turn", "id"], convs.select("conv_id", "h", "k"))
    own = placed.where("idx >= h").select("conv_id", (F.col("idx") - F.col("h") + F.col("k")).alias("depth"), "id", "words")
    first = placed.where((F.col("conv_id") % group == 0) & (F.col("idx") < heads)).select(F.col("conv_id").alias("base"), F.col("idx").alias("depth"), "id", "words")
    head = convs.select("conv_id", "base", "k").join(first, "base").where("depth < k").select("conv_id", "depth", "id", "words")
    return own.unionByName(head), convs.select("conv_id", "length")


def _bands(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, band, ids, words, goes_on): a row per WIDTH turns of a conversation, one for a conversation without turns."""
    cut = turns.withColumn("band", F.expr(f"depth div {WIDTH}")).groupBy("conv_id", "band").agg(F.sort_array(F.collect_list(F.struct("depth", "id", "words"))).alias("t"))
    bands = convs.select("conv_id", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.expr(f"(length - 1) div {WIDTH}")))).alias("band"))
    rows = bands.join(cut, ["conv_id", "band"], "left").withColumn("t", F.coalesce("t", F.array().cast("array<struct<depth:bigint,id:string,words:int>>")))
    return rows.select("conv_id", "band", F.unhex(F.array_join(F.transform("t", lambda x: x["id"]), "")).alias("ids"),
                       F.transform("t", lambda x: x["words"].cast("long")).alias("words"), ((F.col("band") + 1) * WIDTH < F.col("length")).alias("goes_on"))


def _prefixes(long: DataFrame) -> DataFrame:
    """(conv_id, band, prefix): the digest of all turns before each later band, from the rows that go on, in one pass in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, prefix = None, b""
        for batch in batches:
            made: list[bytes] = []
            for c, ids in zip(batch.column("conv_id").to_pylist(), batch.column("ids").to_pylist()):
                if c != conv:
                    conv, prefix = c, b""
                prefix = bytes.fromhex(_path(prefix, ids)[-1])
                made.append(prefix)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(np.asarray(batch.column("band")) + 1, pa.int64()), pa.array(made, pa.binary())],
                                             ["conv_id", "band", "prefix"])

    rows = long.select("conv_id", "band", "ids").repartition("conv_id").sortWithinPartitions("conv_id", "band")
    return rows.mapInArrow(run, "conv_id long, band long, prefix binary")


def _shard(band: int, prefix: list[bytes], ids: list[bytes], convs: np.ndarray, words: np.ndarray, goes_on: np.ndarray,
           tail_saved: np.ndarray, tail_leaves: np.ndarray, shard: int, width: int) -> dict[str, list]:
    """The nodes of one shard, and in a later band a row of depth -1 for what each of its rows adds to the bands before;
    ``ids`` are its rows' turn ids, joined, ``words`` all their words."""
    lens = np.array([len(x) // ID_BYTES for x in ids])
    n, wide = len(lens), int(lens.max(initial=0))
    inside = np.arange(wide) < lens[:, None]
    # a column for the turns before the band, one per turn, and one that lets rows that go on come first
    grid = np.full((n, wide + 2), np.iinfo(np.int64).max)  # padding sorts last
    befores = np.frombuffer(b"".join(p.ljust(32, b"\0") for p in prefix), np.dtype((np.void, 32)))
    grid[:, 0] = np.unique(befores, return_inverse=True)[1].reshape(-1)
    codes = np.unique(np.frombuffer(b"".join(ids), np.dtype((np.void, ID_BYTES))), return_inverse=True)[1]
    grid[:, 1:-1][inside] = codes.reshape(-1)
    grid[:, -1] = ~goes_on
    cost = np.zeros((n, wide), np.int64)
    cost[inside] = words
    order = np.lexsort((convs, *grid.T[::-1]))
    grid, cost, lens, convs, inside, goes_on = (x[order] for x in (grid, cost, lens, convs, inside, goes_on))
    tail_saved, tail_leaves = tail_saved[order], tail_leaves[order]
    change = np.ones((n, wide + 1), bool)
    change[1:] = np.logical_or.accumulate(grid[1:, :-1] != grid[:-1, :-1], axis=1)
    starts = change & np.concatenate([np.ones((n, 1), bool), inside], axis=1)  # by depth in the band, the prefix at 0
    counted = starts.copy()
    counted[0] = False  # whether the first row's nodes start here is decided when shards recombine
    if band:
        counted[:, 0] = False  # the node before a later band starts in the band before
    saved = np.where(counted[:, 1:], 0, cost)[:, ::-1].cumsum(axis=1)[:, ::-1]
    leaf = np.where(goes_on, 0, counted[np.arange(n), lens].astype(np.int64))
    firsts, lasts = _path(prefix[order[0]], ids[order[0]]), _path(prefix[order[-1]], ids[order[-1]])
    out: dict[str, list] = {f.name: [] for f in _PARTS}
    if band:
        adds = {"shard": [shard] * n, "conv_id": convs.tolist(), "depth": [-1] * n, "band": [band] * n, "saved_tokens": saved[:, 0].tolist(), "n_leaves": leaf.tolist()}
        for name, values in out.items():
            values += adds.get(name, [None] * n)
    leaf = leaf + tail_leaves
    before = None  # starts, smallest members and path digests of the depth above
    for depth in range(wide + 1):
        rows = np.flatnonzero(lens >= depth)
        at = np.flatnonzero(starts[rows, depth])
        first = rows[at]
        size = np.diff(np.append(at, len(rows)))
        smallest = np.minimum.reduceat(convs[rows], at)
        ending = (lens[rows] == depth) & ~goes_on[rows]
        children = np.add.reduceat(counted[rows, depth + 1].astype(np.int64), at) if depth < wide else np.zeros(len(at), np.int64)
        leaves = np.add.reduceat(leaf[rows], at)
        total = np.add.reduceat((saved[rows, max(depth - 1, 0)] if wide else 0) + tail_saved[rows], at)
        n_ends = np.add.reduceat(ending.astype(np.int64), at)
        node: list = [None] * len(at)
        if rows[0] == 0:
            node[0] = firsts[depth]
        if rows[-1] == n - 1:
            node[-1] = lasts[depth]
        if depth == width or band and not depth:  # nodes of two bands
            for i, r in enumerate(first.tolist()):
                node[i] = _path(prefix[order[r]], ids[order[r]][:depth * ID_BYTES])[-1]
        if before is None:
            parent_conv = parent = [None] * len(at)
        else:
            up = np.searchsorted(before[0], first, "right") - 1
            parent = [before[2][u] for u in up.tolist()]
            parent_conv = [None if p is not None else c for p, c in zip(parent, before[1][up].tolist())]
        text = np.char.mod("%d", convs[rows[ending]]).tolist() if ending.any() else []
        whole, ends = [], []
        for i, (b, k) in enumerate(zip(np.cumsum(n_ends).tolist(), n_ends.tolist())):
            members = text[b - k:b]
            whole.append(None if node[i] is not None else _EMPTY if not k else hashlib.sha256(",".join(members).encode()).hexdigest())
            ends.append(None if node[i] is None else [",".join(members[j:j + PIECE]) for j in range(0, k, PIECE)])
        again = bool(band) and not depth  # members and totals of this node are counted in the band before
        out["shard"] += [shard] * len(at)
        out["conv_id"] += smallest.tolist()
        out["depth"] += [band * width + depth] * len(at)
        out["parent_conv_id"] += parent_conv
        out["n_convs"] += [0] * len(at) if again else size.tolist()
        out["n_children"] += children.tolist()
        out["n_leaves"] += [0] * len(at) if again else leaves.tolist()
        out["saved_tokens"] += [0] * len(at) if again else total.tolist()
        out["words"] += cost[first, depth - 1].tolist() if depth else [0] * len(at)
        out["band"] += [band] * len(at)
        out["node"] += node
        out["parent"] += parent
        out["ends_sha256"] += whole
        out["first"] += (first == 0).tolist()
        out["last_turn"] += ((lens[first] == depth) & ~goes_on[first]).tolist()
        out["ends"] += ends
        before = (first, smallest, node)
    return out


def _path(prefix: bytes, ids: bytes) -> list[str]:
    """Digests of a band's node paths: of the turns before it (``prefix`` is theirs, empty for the first band), then one turn more each."""
    out = [(prefix or hashlib.sha256().digest()).hex()]
    h = hashlib.sha256(prefix)
    for i in range(0, len(ids), ID_BYTES):
        h.update(ids[i:i + ID_BYTES])
        out.append(h.copy().hexdigest())
    return out


def _shards():
    """The task of a range of sorted band rows."""
    width, cells = WIDTH, CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 33

        def cut(bands: list[int], lens: list[int]) -> Iterator[tuple[int, int]]:
            a, wide = 0, 1
            for i, (band, k) in enumerate(zip(bands, lens)):
                if i > a and (band != bands[a] or (i + 1 - a) * max(wide, k) > cells):
                    yield a, i
                    a, wide = i, 1
                wide = max(wide, k)
            if a < len(lens):
                yield a, len(lens)

        for batch in batches:
            convs, tail_saved, tail_leaves = (batch.column(c).to_numpy() for c in ("conv_id", "tail_saved", "tail_leaves"))
            goes_on, bands = batch.column("goes_on").to_numpy(zero_copy_only=False), batch.column("band").to_pylist()
            prefix, ids = batch.column("prefix").to_pylist(), batch.column("ids").to_pylist()
            flat, at = batch.column("words").flatten().to_numpy(), batch.column("words").offsets.to_numpy()
            at = at - at[0]
            for a, b in cut(bands, np.diff(at).tolist()):
                nodes = _shard(bands[a], prefix[a:b], ids[a:b], convs[a:b], flat[at[a]:at[b]], goes_on[a:b], tail_saved[a:b], tail_leaves[a:b], shard, width)
                yield pa.RecordBatch.from_pydict(nodes, schema=_PARTS)
                shard += 1

    return run


def _parts(rows: DataFrame) -> DataFrame:
    """The nodes of all shards of ``rows`` (conv_id, band, prefix, ids, words, goes_on, tail_saved, tail_leaves)."""
    end = F.when(F.col("goes_on"), "0").otherwise("f")  # one that ends sorts behind those that go on
    keyed = rows.withColumn("key", F.concat("ids", F.unhex(F.repeat(end, F.lit(2 * ID_BYTES)))))
    by = ["band", "prefix", "key", "conv_id"]
    return stored(keyed.repartitionByRange(*by).sortWithinPartitions(*by).drop("key").mapInArrow(_shards(), _PARTS_DDL), "parts")


def _edges(parts: DataFrame) -> DataFrame:
    """Boundary nodes with ``again`` (a later band's copy of the node before it) and ``start``: 1 where a first row's node
    starts in its shard, for no earlier one has it."""
    edge = parts.where("node is not null").withColumn("again", (F.col("band") > 0) & (F.col("depth") == F.col("band") * WIDTH))
    born = edge.groupBy("node").agg(F.min("shard").alias("born"))
    return edge.join(born, "node").withColumn("start", (F.col("first") & ~F.col("again") & (F.col("shard") == F.col("born"))).cast("long"))


def _with_tails(rows: DataFrame) -> DataFrame:
    """``rows`` with what a conversation's later bands add to the nodes of each band: saved words and leaves."""
    parts = _parts(rows)
    starts = _edges(parts).where("start = 1 and band > 0").select("conv_id", "band", (-F.col("words")).alias("saved"), F.col("last_turn").cast("long").alias("leaves"))
    adds = parts.where("depth = -1").select("conv_id", "band", F.col("saved_tokens").alias("saved"), F.col("n_leaves").alias("leaves")).unionByName(starts)
    sums = adds.groupBy("conv_id", "band").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    later = Window.partitionBy("conv_id").orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tails = sums.select("conv_id", (F.col("band") - 1).alias("band"), F.sum("saved").over(later).alias("more_saved"), F.sum("leaves").over(later).alias("more_leaves"))
    out = rows.join(tails, ["conv_id", "band"], "left")
    return stored(out.select("conv_id", "band", "prefix", "ids", "words", "goes_on", F.coalesce("more_saved", "tail_saved").alias("tail_saved"),
                             F.coalesce("more_leaves", "tail_leaves").alias("tail_leaves")), "rows")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): one row per node.

    ``turns``: (conv_id, depth, id, words), depths from 0 without gaps, ids of 32 hex digits; ``convs``: (conv_id, length),
    one row per conversation, those without turns too. A node is a distinct sequence of first ``depth`` turns; its
    members are the conversations that start with it, ``conv_id`` their smallest. ``n_leaves`` counts the childless nodes
    and ``saved_tokens`` sums (n_convs - 1) times the words of a node's last turn, both over its subtree, itself included;
    the root (depth 0, no parent) has no words. ``ends_sha256`` hashes the ids of the members with exactly ``depth``
    turns, ascending, comma-joined. Without any conversation there is no node. Any number of conversations may share a
    node and a conversation may have any number of turns; where conversations end at one node, their ids are hashed one after
    another by one task, as a hash must be, without being held.
    """
    zero = F.lit(0).cast("long")
    rows = stored(_bands(turns, convs), "bands")
    long = rows.where("goes_on")
    several = not long.isEmpty()
    rows = (rows.join(stored(_prefixes(long), "prefixes"), ["conv_id", "band"], "left") if several else rows.withColumn("prefix", F.lit(None).cast("binary")))
    rows = rows.withColumns({"prefix": F.coalesce("prefix", F.unhex(F.lit(""))), "tail_saved": zero, "tail_leaves": zero})
    if several:
        rows = _with_tails(stored(rows, "rows"))
    parts = _parts(rows).where("depth >= 0")

    inner = parts.where("node is null")
    below = Window.partitionBy("shard", "first").orderBy(F.col("depth").desc())
    deeper = below.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = _edges(parts).withColumns({
        "n_children": F.col("n_children") + F.coalesce(F.lag("start").over(below), F.lit(0)),
        "n_leaves": F.when(F.col("again"), 0).otherwise(F.col("n_leaves") + F.sum(F.col("start") * F.col("last_turn").cast("long")).over(deeper)),
        "saved_tokens": F.when(F.col("again"), 0).otherwise(F.col("saved_tokens") - F.sum(F.col("start") * F.col("words")).over(deeper))})
    edge = stored(edge, "edges")
    whole = edge.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("parent_conv_id").alias("inner_parent"),
                                     *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    whole = stored(whole, "recombined")
    up = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("up"))
    merged = whole.join(_ends(edge), "node", "left").join(up, "parent", "left")
    merged = merged.withColumn("parent_conv_id", F.coalesce("up", "inner_parent")).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY))).select(_NODE)
    # inner nodes below a boundary node: its smallest member, looked up shard by shard
    known = edge.select("shard", F.col("node").alias("parent")).join(up, "parent")
    inner = inner.join(known, ["shard", "parent"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up"))
    return inner.select(_NODE).unionByName(merged)


def _ends(edge: DataFrame) -> DataFrame:
    """(node, ends_sha256) of boundary nodes where conversations end: one pass over their pieces in order, hashed as they come.

    The pieces are small, so a node where very many conversations end is streamed through its task, never held.
    """
    pieces = edge.where("size(ends) > 0").select("node", "shard", F.posexplode("ends").alias("piece", "ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, h = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for x, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if x != node:
                    if h is not None:
                        done.append((node, h.hexdigest()))
                    node, h = x, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in done], pa.string()), pa.array([b for _, b in done], pa.string())], ["node", "ends_sha256"])
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([h.hexdigest()])], ["node", "ends_sha256"])

    return pieces.repartition("node").sortWithinPartitions("node", "shard", "piece").mapInArrow(run, "node string, ends_sha256 string")
