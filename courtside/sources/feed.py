"""The feed as a batch or streaming DataFrame, from Kafka or from files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.schema import FEED_SCHEMA, GAME_TOPIC


@dataclass(frozen=True)
class KafkaSource:
    """Topics of a Kafka cluster; needs the Kafka connector on the Spark class path."""

    servers: str
    topics: list[str] = field(default_factory=lambda: [GAME_TOPIC])
    starting: str = "earliest"
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": ",".join(self.topics),
            "startingOffsets": self.starting,
            **self.options,
        }


def read_feed(
    spark: SparkSession,
    source: str | KafkaSource,
    streaming: bool = False,
    file_format: str = "parquet",
    topics: list[str] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Feed records ``key, value, topic, partition, offset, ts``.

    Values stay binary from Kafka's derived number topics; see :func:`text_values`.
    """
    reader = spark.readStream if streaming else spark.read
    if isinstance(source, KafkaSource):
        raw = reader.format("kafka").options(**source.reader_options()).load()
        feed = raw.select(
            F.col("key").cast("string").alias("key"),
            "value",
            "topic",
            "partition",
            "offset",
            F.col("timestamp").alias("ts"),
        )
    else:
        if streaming and max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        feed = reader.format(file_format).schema(FEED_SCHEMA).load(source)
    return feed if topics is None else feed.where(F.col("topic").isin(topics))


def text_values(feed: DataFrame) -> DataFrame:
    return feed.withColumn("value", F.col("value").cast("string"))


def route(feed: DataFrame, topic: str) -> DataFrame:
    """The records of one topic of a multi-topic feed."""
    return feed.where(F.col("topic") == topic)
