"""Tables a job writes for itself or for the next one, in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_stored: dict[tuple, tuple[str, list[tuple[str, str]]]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Without it only a local master can go on, in its warehouse folder.
    """
    folder = spark.conf.get(_SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/courtside/{name}-{uuid.uuid4().hex}"


def stage(
    df: DataFrame, name: str, partition_by: list[str] | None = None, path: str | None = None
) -> DataFrame:
    """Write ``df`` once and read it back.

    For frames several results are built from: the lineage ends at durable files, which
    survive lost executors, and later readers prune columns and push filters down.
    """
    path = path or new_path(df.sparkSession, name)
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def file_version(spark: SparkSession, path: str) -> tuple:
    """Number, total length and newest time of the files of a table, at any depth.

    Changes when the table does; the driver keeps three numbers, whatever the table's size.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    count = length = newest = 0
    while files.hasNext():
        file = files.next()
        count, length = count + 1, length + file.getLen()
        newest = max(newest, file.getModificationTime())
    return path, count, length, newest


def drop_stored(spark: SparkSession) -> None:
    """Delete the tables that :func:`stored_once` has written in this session."""
    own = [key for key in _stored if key[0] == spark.sparkContext.applicationId]
    for key in own:
        path = spark._jvm.org.apache.hadoop.fs.Path(_stored.pop(key)[0])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored_once(
    spark: SparkSession,
    name: str,
    source: str,
    build: Callable[[], DataFrame],
    partition_by: list[str] | None = None,
) -> DataFrame:
    """The table built from the files at ``source``, written once per session.

    Further calls read what the first one wrote, until the source files change.
    """
    key = (spark.sparkContext.applicationId, name, file_version(spark, source))
    if key in _stored:
        path, columns = _stored[key]
        try:
            spark.read.parquet(path)
        except AnalysisException:  # cleared away since: build it again
            del _stored[key]
        else:
            schema = ", ".join(f"`{n}` {t}" for n, t in columns)
            return spark.read.schema(schema).parquet(path).select(*[n for n, _ in columns])
    path = new_path(spark, name)
    table = stage(build(), name, partition_by, path)
    _stored[key] = (path, table.dtypes)
    return table


def write_parsed(parsed: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store parsed messages by kind and day.

    Text is decoded once, and a reader of one kind (season markers, starts, finals) or
    of some days opens no other files.
    """
    by_day = parsed.withColumn("day", F.to_date("ts"))
    by_day.write.mode(mode).partitionBy("tipo", "day").parquet(path)


def read_parsed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("day")
