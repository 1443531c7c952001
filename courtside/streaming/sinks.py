"""Where streams end: topics, append-only tables, and tables of latest values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courtside.functions.text import encode_int, encode_json
from courtside.schema import (
    ODDS_TOPIC,
    POINTS_TOPIC,
    SIMULTANEOUS_TOPIC,
    STREAK_TOPIC,
    TEAM_TOPIC,
)
from courtside.streaming.compaction import BATCH, compact, newest, read_changes

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class KafkaTarget:
    """A topic; the frame must have ``key`` and ``value``."""

    servers: str
    topic: str


def configure_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB, off the heap, with incremental checkpoints."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _record(key: Column, value: Column) -> list[Column]:
    return [key.alias("key"), value.alias("value")]


def topic_records(df: DataFrame, topic: str) -> DataFrame:
    """``key, value`` records of a derived dataset in its topic's encoding."""
    if topic == ODDS_TOPIC:
        key, value = F.col("game_key"), encode_json("teamA", "teamB", "oddsA", "oddsB")
    elif topic == POINTS_TOPIC:
        key, value = F.col("player"), encode_int("total", 4)
    elif topic == TEAM_TOPIC:
        key, value = F.col("team"), encode_json("win", "lose", "point_made", "point_take")
    elif topic == STREAK_TOPIC:
        key, value = F.col("player"), F.col("message")
    elif topic == SIMULTANEOUS_TOPIC:
        key, value = F.lit("HOTSTREAK"), encode_int("streaks", 8)
    else:
        raise ValueError(f"not a derived topic: {topic}")
    return df.select(*_record(key, value))


def write_stream(
    df: DataFrame,
    target: str | KafkaTarget,
    checkpoint: str,
    mode: str = "append",
    available_now: bool = False,
    trigger: str | None = None,
) -> StreamingQuery:
    """Start a query into a topic or an append-only parquet table."""
    configure_state(df.sparkSession)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    if isinstance(target, KafkaTarget):
        return (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", target.servers)
            .option("topic", target.topic)
            .start()
        )
    return writer.format("parquet").option("path", target).start()


def write_changelog(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "update",
    available_now: bool = False,
    trigger: str | None = None,
    keys: list[str] | None = None,
    compact_every: int | None = None,
    removed: str | None = None,
) -> StreamingQuery:
    """Start a query that stores the changed rows of every micro-batch.

    Each batch owns the folder of its id and overwrites it, so a batch that runs again
    after a failure leaves the same table. With ``compact_every`` the batches before it are
    folded into one row per ``keys`` after every so many batches;
    rows whose column ``removed`` is true are tombstones.
    """

    configure_state(df.sparkSession)
    if compact_every and not keys:
        raise ValueError("compaction needs the keys of the table")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(batch.sparkSession, path, keys, removed)

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.foreachBatch(store).start()


def read_latest(spark: SparkSession, path: str, keys: list[str], removed: str | None = None) -> DataFrame:
    """The newest row of each key in a changelog, compacted or not, without removed keys."""
    rows = newest(read_changes(spark, path), keys, removed).drop(BATCH)
    return rows.drop(removed) if removed else rows


def read_table_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """An append-only table as the source of the next query."""
    return spark.readStream.schema(schema).parquet(path)
