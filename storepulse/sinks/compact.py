"""Compaction of closed partitions written by micro-batches.

A stream that triggers every few seconds leaves one ``writer=/batch_id=`` folder per batch in
each day (or month) partition. Once a partition is closed, its folders are merged into
few, large files.

Steps, each of which a rerun goes on from, and at each of which a reader of the table
(``snapshot.read_snapshot``) meets every row once:

1. the folders to merge are chosen: all but the newest batch of each writer, the only one
   that a restarted stream may write again;
2. a new ``writer=compacted`` folder is left out of the table, then written and counted;
3. in one step it is let in and the merged folders are left out instead;
4. the merged folders are removed: at once, or by a later run once ``grace_s`` seconds have gone by,
   so that readers which listed them before the switch can finish.

A crash before step 3 leaves the old folders and a copy that the next run removes; after
it, the next run removes the old ones. Batches that arrive meanwhile are not touched.
"""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import hadoop_path
from .snapshot import MERGED, PENDING, batch_folders, hide, read_snapshot, state, tidy

COMPACTED = "compacted"  # writer of merged rows; no query has this id
ROWS_PER_FILE = 5_000_000


def _remove(spark: SparkSession, folder: str) -> None:
    fs, p = hadoop_path(spark, folder)
    fs.delete(p, True)


def _settle(spark: SparkSession, root: str, part: str, grace_s: float) -> frozenset[str]:
    """End what an earlier run left; returns the folders that still have to be left out."""
    kind, hidden, said = state(spark, root, part)
    if kind == MERGED and time.time() < said + grace_s:
        return hidden
    if kind == PENDING:  # its copy was never let in; other folders may be left out from before
        for f in hidden:
            if f.startswith(f"writer={COMPACTED}/"):
                _remove(spark, f"{root}/{part}/{f}")
    elif kind == MERGED:
        for f in sorted(hidden):
            _remove(spark, f"{root}/{part}/{f}")
    if kind is not None:
        tidy(spark, root, part)
    return frozenset()


def compact_partition(spark: SparkSession, path: str, schema: T.StructType, part_col: str, value: str,
                      rows_per_file: int = ROWS_PER_FILE, sort_by=(), grace_s: float = 0.0) -> int:
    """Merge the batch folders of partition ``part_col=value`` of the table at ``path``.

    Files hold about ``rows_per_file`` rows, as ranges of ``sort_by`` (and sorted by it) when
    given. Returns the number of rows of the partition. One compaction of a partition at a time; while folders
    of the last one wait for ``grace_s``, a partition is not merged again.
    """
    root, part = path.rstrip("/"), f"{part_col}={value}"
    if not _settle(spark, root, part, grace_s):
        # one name per batch folder: bounded by the batches of one day or month
        batches = [(f, f.split("/")[0][len("writer="):], int(f.rsplit("=", 1)[1])) for f in batch_folders(spark, root, part)]
        newest: dict[str, int] = {}
        for _, w, b in batches:
            newest[w] = max(b, newest.get(w, b))
        merge = [f for f, w, b in batches if w == COMPACTED or b < newest[w]]
        if len(merge) > 1:
            target = f"writer={COMPACTED}/batch_id={newest.get(COMPACTED, -1) + 1}"
            hide(spark, root, part, PENDING, [target])
            old = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{part}/{m}" for m in merge])
            old = old.drop(part_col, "writer", "batch_id")
            total = old.count()  # from the files' footers
            files = max(1, -(-total // rows_per_file))
            out = old.repartitionByRange(files, *sort_by).sortWithinPartitions(*sort_by) if sort_by else old.repartition(files)
            out.write.mode("overwrite").parquet(f"{root}/{part}/{target}")
            copied = spark.read.schema(old.schema).parquet(f"{root}/{part}/{target}").count()
            if copied != total:
                raise RuntimeError(f"copied {copied} of {total} rows of {root}/{part}; nothing was removed")
            hide(spark, root, part, MERGED, merge)
            if grace_s <= 0:
                _settle(spark, root, part, 0)
    return read_snapshot(spark, root, schema, part_col, [value]).select(F.count(F.lit(1))).first()[0]
