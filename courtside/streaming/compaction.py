"""Compaction of changelogs: the folders of many batches become one table.

A changelog at ``path`` has a folder ``batch_id=N`` per batch with the rows that the batch
changed. Compaction writes the newest row of every key, as of some batch, to a folder of its
own under ``_compacted``, and then publishes it by creating an empty file in ``_manifest``
whose name says up to which batch it goes and which folder it is. Creating the file is the
only step that readers can see, and it either happened or not:

* a run that ends before it leaves a folder that nothing names, which the next run deletes;
* a reader takes the newest published table and the batches after it;
* what readers of the ``keep`` versions before the newest may still read stays, so a reader
  that planned its files just before a switch can finish.

The newest batch is never folded in: only when the next one has begun is a batch committed
and not written again. One process compacts a changelog at a time, usually the job itself.
Rows may be tombstones: a true value in the column ``removed`` says that the key is gone.
Readers and compaction leave out keys whose newest row is one; a key may come back later.

Each compaction is one aggregate by key in Spark; the driver holds names only, at most those
of the batches since the last one that was compacted and of the ``keep`` versions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch_id"
TABLES, MANIFEST = "_compacted", "_manifest"


class _Files:
    """The few operations on the folder of a changelog, in whatever file system it lies."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str = "") -> list[str]:
        at = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.root}/{name}"))

    def create(self, name: str) -> None:
        at = self._path(f"{self.root}/{name}")
        self._fs.mkdirs(at.getParent())
        if not self._fs.createNewFile(at):
            raise FileExistsError(name)

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{name}"), True)


def _versions(files: _Files) -> list[tuple[int, str]]:
    """The published tables, oldest first: the last batch in it and its folder."""
    entries = (name.partition("-") for name in files.names(MANIFEST) if not name.startswith("."))
    return sorted((int(upto), folder) for upto, _, folder in entries)


def _batches(files: _Files) -> list[int]:
    """The batches whose folders exist."""
    return sorted(int(name.partition("=")[2]) for name in files.names() if name.startswith(f"{BATCH}="))


def _rows(spark: SparkSession, path: str, version: tuple[int, str] | None, batches: list[int]) -> DataFrame:
    parts = []
    if version:
        parts.append(spark.read.parquet(f"{path}/{TABLES}/{version[1]}"))
    if batches:
        folders = [f"{path}/{BATCH}={n}" for n in batches]
        changes = spark.read.option("basePath", path).parquet(*folders)
        parts.append(changes.withColumn(BATCH, F.col(BATCH).cast("bigint")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def newest(changes: DataFrame, keys: list[str], removed: str | None = None) -> DataFrame:
    """The newest row of each key, with the batch that it comes from; none if that says it is gone."""
    values = [c for c in changes.columns if c not in (*keys, BATCH)]
    best = F.max_by(F.struct(*values), BATCH).alias("v")
    rows = changes.groupBy(*keys).agg(best, F.max(BATCH).alias(BATCH)).select(*keys, "v.*", BATCH)
    return rows.where(~F.col(removed)) if removed else rows


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The newest published table of a changelog and all finished batches after it.

    A folder without the mark that Spark leaves at the end of a write is still being written.
    """
    files = _Files(spark, path)
    version = next(iter(_versions(files)[-1:]), None)
    done = [n for n in _batches(files) if (not version or n > version[0]) and files.exists(f"{BATCH}={n}/_SUCCESS")]
    if not version and not done:
        raise FileNotFoundError(f"no finished batch in {path}")
    return _rows(spark, path, version, done)


def publish(files: _Files, upto: int, folder: str) -> None:
    """Make a finished table the one that readers take."""
    files.create(f"{MANIFEST}/{upto:020d}-{folder}")


def compact(spark: SparkSession, path: str, keys: list[str], removed: str | None = None, keep: int = 1) -> int | None:
    """Fold all batches but the newest into a new table; the last batch folded, if any was.

    ``keep``: how many versions before the newest stay whole for readers that began with them.
    """
    files = _Files(spark, path)
    versions, batches = _versions(files), _batches(files)
    version = versions[-1] if versions else None
    fresh = [n for n in batches[:-1] if not version or n > version[0]]
    if not fresh:
        return None
    named = {folder for _, folder in versions}
    for orphan in set(files.names(TABLES)) - named:
        files.delete(f"{TABLES}/{orphan}")
    folder = uuid.uuid4().hex
    newest(_rows(spark, path, version, fresh), keys, removed).write.parquet(f"{path}/{TABLES}/{folder}")
    publish(files, fresh[-1], folder)
    _drop_before(files, _versions(files), batches, keep)
    return fresh[-1]


def _drop_before(files: _Files, versions: list[tuple[int, str]], batches: list[int], keep: int) -> None:
    """Delete what only readers of versions older than the ``keep`` before the newest need."""
    stay = versions[-1 - keep :]
    for upto, folder in versions[: -1 - keep]:
        files.delete(f"{MANIFEST}/{upto:020d}-{folder}")
        files.delete(f"{TABLES}/{folder}")
    if len(stay) > keep:
        for n in batches:
            if n <= stay[0][0]:
                files.delete(f"{BATCH}={n}")
