"""Merkle manifest of a dataset by lag and lead windows (operator 12).

Every row is a leaf; the leaves of a group (source) in their order are hashed in runs of three,
level by level, to the group's subroot, and the subroots in order of their groups to the root.

A leaf's place in its group comes from a range partitioning and the sizes of the pieces that
the ranges cut from the groups, so a group of any size is numbered by all tasks together.
Windows then run over blocks of ``3 ** DEPTH`` neighbours. No run of the first ``DEPTH`` levels
crosses a block, so at level j lag and lead by ``3 ** j`` and twice that, masked by the slot in
the run and the run's length, are a node's siblings, and the run's first row hashes the parent.
Blocks become the nodes of the next round until every group is one node: two rounds reach
half a million rows a group, four reach 280 billion. On the way down a block's path to the
root is joined to its rows; no join or window ever meets more than a block per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from storepulse.llm.common import stored

FANOUT = 3
DEPTH = 6
BLOCK = FANOUT ** DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(c: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, ``:`` and the value; integers in decimal."""
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts' concatenation."""
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to over ``path`` (left and right siblings of every level, as hex text)."""
    return F.aggregate(path, leaf, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings on ``path``, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def numbered(rows: DataFrame, group: str, order: list[str], more: DataFrame | None = None) -> DataFrame:
    """``rows`` plus ``idx``, the place in ``group`` (not null) by ``order`` from 0, and ``n``, the group's size, and
    the columns of ``more`` (one row per group), which reach the rows without a join by the group alone.

    Ties are ordered arbitrarily but once for all: the numbered rows are written. ``rows`` should be a stored
    table, for its rows are read twice, once to choose the ranges. A group, or a key of ``order``, that holds
    most rows is spread over ranges by a tie-breaker of its own.
    """
    by = [group, *order, "__tie"]
    ranged = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*[F.col(c).asc_nulls_first() for c in by])
    ranged = ranged.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in by]).drop("__tie")
    ranged = stored(ranged.withColumn("__place", F.monotonically_increasing_id()), "ranged").withColumn("__part", F.shiftright("__place", 33))
    pieces = ranged.groupBy(group, "__part").agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(group, "__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"), "__first",
                           F.sum("__rows").over(Window.partitionBy(group)).alias("n"))
    if more is not None:
        pieces = pieces.join(more, group)
    out = ranged.join(pieces, [group, "__part"]).withColumn("idx", F.col("__place") - F.col("__first") + F.col("__before"))
    return out.drop("__place", "__part", "__first", "__before")


def _block_levels(nodes: DataFrame) -> DataFrame:
    """``nodes`` (g, idx, n, d, more) plus block, path (its levels within the block) and top (the block's digest)."""
    over = "over (partition by g, block order by idx)"
    t = nodes.selectExpr("*", f"idx div {BLOCK} as block", "d as __d")
    for j in range(DEPTH):
        step = FANOUT ** j  # a node of level j stands on the row of its first leaf
        t = t.selectExpr("*", f"lag(__d, {step}) {over} as __lag1", f"lag(__d, {2 * step}) {over} as __lag2",
                         f"lead(__d, {step}) {over} as __lead1", f"lead(__d, {2 * step}) {over} as __lead2",
                         f"n > {step} as __active", f"idx % {step} = 0 as __node", f"idx div {step} % {FANOUT} as __slot",
                         f"least({FANOUT}, (n + {step - 1}) div {step} - idx div {step} + idx div {step} % {FANOUT}) as __run")
        t = t.selectExpr("* except (__lag1, __lag2, __lead1, __lead2, __active, __node, __slot, __run, __d)", "__d", "__active", "__node", "__slot",
                         "concat(if(__slot = 2, __lag2, ''), if(__slot >= 1, __lag1, '')) as __left",
                         "concat(if(__slot + 1 < __run, __lead1, ''), if(__slot + 2 < __run, __lead2, '')) as __right")
        t = t.selectExpr("* except (__d, __active, __node, __slot, __left, __right)",
                         f"if(__node and __active, struct(__left as left, __right as right), null) as __s{j}",
                         "case when not __active then __d when __node and __slot = 0 then sha2(concat(__d, __right), 256) end as __d")
    # the rows between two nodes are the first one's descendants
    so_far = "over (partition by g, block order by idx rows between unbounded preceding and current row)"
    levels = [f"last(__s{j}, true) {so_far}" for j in range(DEPTH)]
    return t.selectExpr(*nodes.columns, "block", f"filter(array({', '.join(levels)}), s -> s is not null) as path", f"first(__d) {so_far} as top")


def _climb(nodes: DataFrame, largest: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of every round (those given, then their blocks, until the largest group is one block), and (g, d): every group's digest."""
    rounds, done = [nodes], None
    while True:
        blocks = _block_levels(rounds[-1]).where(f"idx % {BLOCK} = 0")
        blocks = stored(blocks.select("g", F.col("block").alias("idx"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("top").alias("d")), "blocks")
        ended = blocks.where("n = 1").select("g", "d")
        done = ended if done is None else done.unionByName(ended)
        largest = -(-largest // BLOCK)
        if largest <= 1:
            return rounds, done
        rounds.append(blocks.where("n > 1"))


def _descend(rounds: list[DataFrame], ends: DataFrame) -> DataFrame:
    """The first round's nodes plus path (to the end) and the columns of ``ends`` (g, path, subroot, root)."""
    above = None
    for nodes in reversed(rounds):
        here = _block_levels(nodes).withColumnRenamed("path", "__path").drop("top")
        upper = ends.select("g", F.lit(0).cast("long").alias("block"), "path", "subroot", "root", F.lit(True).alias("__end"))
        if above is not None:
            upper = upper.unionByName(above.select("g", F.col("idx").alias("block"), "path", "subroot", "root", F.lit(False).alias("__end")))
        # a group ends in the round in which it is one block; before, its blocks are nodes of the next round
        joined = here.withColumn("__end", F.col("n") <= BLOCK).join(upper, ["g", "block", "__end"])
        above = joined.withColumn("path", F.concat("__path", "path")).drop("__path", "__end", "block")
        if nodes is not rounds[0]:
            above = stored(above, "paths")
    return above


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, tampered, path, subroot, root): one row per row of ``docs``, with its proof as the siblings of every level.

    A leaf hashes doc_id, source, lang, n_chars and text, each :func:`encoded`. Leaves ascend by doc_id (null first)
    within a source, equal ids by leaf; equal rows have equal leaves and take neighbouring places in any order. A null
    source is a group of its own, ordered first. ``tampered`` is a text to hash in place of the row's own, into the
    leaf of that name, null where it hashes the same. Other columns are not read. An empty table gives no rows.
    """
    hashed = {c: encoded(docs[c]) for c in FIELDS}
    leaf = digest(*hashed.values())
    other = F.lit(None).cast("string") if tampered is None else F.when(~tampered.eqNullSafe(docs["text"]), digest(*[encoded(tampered) if c == "text" else h for c, h in hashed.items()]))
    leaves = stored(docs.select(docs["doc_id"].alias("doc_id"), hashed["source"].alias("key"), leaf.alias("d"), other.alias("tampered")), "leaves")
    placed = numbered(leaves, "key", ["doc_id", "d"])
    source = F.when(F.col("key") != "-", F.expr("substr(key, instr(key, ':') + 1)"))
    groups = stored(leaves.groupBy("key").agg(F.count(F.lit(1)).alias("size")).select("key", "size", source.alias("source"), F.lit(0).alias("all")), "groups")
    largest, many = groups.agg(F.coalesce(F.max("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not many:
        return leaves.select("doc_id", F.col("d").alias("leaf"), "tampered", F.array().cast("array<struct<left:string,right:string>>").alias("path"),
                             F.col("d").alias("subroot"), F.col("d").alias("root"))
    order = stored(numbered(groups, "all", ["source"]).select("key", F.col("idx").alias("g")), "order")
    rounds, subroots = _climb(stored(placed.join(order, "key").select("g", "idx", "n", "d", "doc_id", "tampered"), "places"), largest)
    # the subroots are the leaves of one more tree
    subs = stored(subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), F.lit(many).cast("long").alias("n"), "d"), "subroots")
    tops, top = _climb(subs, many)
    root = top.select("g", F.array().cast("array<struct<left:string,right:string>>").alias("path"),
                                  F.lit(None).cast("string").alias("subroot"), F.col("d").alias("root"))
    ends = stored(_descend(tops, root).select(F.col("idx").alias("g"), "path", F.col("d").alias("subroot"), "root"), "ends")
    return _descend(rounds, ends).select("doc_id", F.col("d").alias("leaf"), "tampered", "path", "subroot", "root")


def verified(rows: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of :func:`manifest` rows: the tampered leaf, where
    there is one, folded over the untampered siblings."""
    folded = rows.select("*", fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def without_newlines(docs: DataFrame) -> Column:
    """The text without its newlines where 2 divides the CRC-32 of the decimal doc_id, else the text itself; null ids are left alone."""
    even = F.coalesce(F.pmod(F.crc32(docs["doc_id"].cast("string").cast("binary")), F.lit(2)) == 0, F.lit(False))
    return F.when(even, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])
