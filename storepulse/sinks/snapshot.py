"""What a reader sees of a partitioned table while its folders are being replaced.

A table's partitions hold one ``writer=/batch_id=`` folder per batch, and a reader takes them all. While
folders are merged, a small versioned file per partition, ``_visible/<partition>/<version>``, names those
to leave out; the highest version counts and appears in one step (a rename). So the switch from old folders to
their merged copy is one moment, and a reader that lists the table before, during or after it meets every
row once. Partitions without such a file, all but the one being merged, are read as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import hadoop_path

FOLDER = "_visible"
PENDING, MERGED = "pending", "merged"


def _names(fs, folder, prefix: str = "") -> list[str]:
    return [n for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.startswith(prefix)] if fs.exists(folder) else []


def _versions(spark: SparkSession, root: str, part: str) -> list[int]:
    fs, folder = hadoop_path(spark, f"{root}/{FOLDER}/{part}")
    return sorted(int(n) for n in _names(fs, folder) if n.isdigit())


def state(spark: SparkSession, root: str, part: str) -> tuple[str | None, frozenset[str], float]:
    """(``pending``, ``merged`` or None, the folders left out, when it was said in epoch seconds) of a partition."""
    for _ in range(5):  # a version may be tidied away between listing and reading; a newer state is then there
        versions = _versions(spark, root, part)
        if not versions:
            break
        fs, file = hadoop_path(spark, f"{root}/{FOLDER}/{part}/{versions[-1]}")
        if fs.exists(file):
            stream = fs.open(file)
            try:
                kind, *hidden = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
            finally:
                stream.close()
            return kind, frozenset(hidden), fs.getFileStatus(file).getModificationTime() / 1000
    return None, frozenset(), 0.0


def hide(spark: SparkSession, root: str, part: str, kind: str, folders) -> None:
    """From now on, leave ``folders`` (``writer=../batch_id=..``) out of the partition, and no others."""
    version = max(_versions(spark, root, part), default=-1) + 1
    fs, aside = hadoop_path(spark, f"{root}/{FOLDER}/{part}/.{version}")
    out = fs.create(aside, True)
    try:
        out.write(bytearray("\n".join([kind, *sorted(folders)]), "utf-8"))
    finally:
        out.close()
    if not fs.rename(aside, hadoop_path(spark, f"{root}/{FOLDER}/{part}/{version}")[1]):
        raise OSError(f"another merge of {part} is running")


def tidy(spark: SparkSession, root: str, part: str) -> None:
    """Forget the partition's states, the one that counts last. Nothing left out may still be there."""
    for v in _versions(spark, root, part):
        fs, file = hadoop_path(spark, f"{root}/{FOLDER}/{part}/{v}")
        fs.delete(file, False)


def batch_folders(spark: SparkSession, root: str, part: str) -> list[str]:
    """The ``writer=../batch_id=..`` folders of a partition that count, in order."""
    hidden = state(spark, root, part)[1]
    fs, folder = hadoop_path(spark, f"{root}/{part}")
    found = [f"{w}/{b}" for w in _names(fs, folder, "writer=") for b in _names(fs, hadoop_path(spark, f"{root}/{part}/{w}")[1], "batch_id=")]
    return sorted(f for f in found if f not in hidden)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, part_col: str, values=None) -> DataFrame:
    """The table at ``path``, or its partitions ``part_col`` in ``values``, every row once; empty where there is no folder.

    Only partitions that are being merged are listed folder by folder.
    """
    root = path.rstrip("/")
    fs, folder = hadoop_path(spark, root)
    if values is None:
        parts = _names(fs, folder, f"{part_col}=")
    else:
        parts = [p for p in (f"{part_col}={v}" for v in sorted(set(values))) if fs.exists(hadoop_path(spark, f"{root}/{p}")[1])]
    merging = set(_names(fs, hadoop_path(spark, f"{root}/{FOLDER}")[1]))
    paths = []
    for p in parts:
        paths += [f"{root}/{p}/{f}" for f in batch_folders(spark, root, p)] if p in merging else [f"{root}/{p}"]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)
