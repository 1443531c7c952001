"""Intermediate tables in the folder that driver and executors share, and bounded samples.

A staged table cuts lineage: what was written survives the loss of executors. The folder is
``spark.checkpoint.dir`` of the session. Where it is unset, only a local master can go on, in
its warehouse folder; a cluster without the setting is an error, since executors could not
read each other's files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


class Shared:
    """Writes tables into the shared folder and drops them again."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def table(self, df: DataFrame) -> DataFrame:
        """``df`` written as Parquet and read back."""
        path = f"{shared_folder(self.spark)}/llm/{uuid.uuid4().hex}"
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(kept)] = path
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for table in tables:
            path = self.paths.pop(id(table), None)
            if path:
                jvm = self.spark.sparkContext._jvm
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def fold(key: Column, n: int) -> Column:
    """The fold of a row: crc32 of the key's text, modulo ``n``. A null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def sample_rows(df: DataFrame, key: str, bound: int) -> DataFrame:
    """At most ``bound`` rows of ``df``, the ones whose keys hash lowest.

    Only keys are sorted; the chosen keys, at most ``bound``, are then broadcast. Of rows that
    repeat a key the smallest, by the other columns in order, is chosen.
    """
    keys = df.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    keys = keys.orderBy(F.xxhash64("_key"), "_key").limit(bound)
    chosen = df.join(F.broadcast(keys), F.col(key) == F.col("_key"), "left_semi")
    others = [c for c in df.columns if c != key]
    if not others:
        return chosen.distinct()
    return chosen.groupBy(key).agg(F.min(F.struct(*others)).alias("_least")).select(key, "_least.*")
