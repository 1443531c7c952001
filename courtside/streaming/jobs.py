"""The continuous jobs: season statistics, odds, streaks and the dashboard."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courtside.operators import latest, parse, stats, streaks
from courtside.operators.segments import segment
from courtside.plans import dashboard as dash
from courtside.streaming.sinks import write_changelog, write_stream


def player_points(
    feed: DataFrame, path: str, checkpoint: str, available_now: bool = False, compact_every: int | None = None
) -> StreamingQuery:
    """All-time player totals: each batch stores the totals it changed."""
    totals = stats.player_points(parse.scoring_plays(parse.plays(parse.parse_feed(feed))))
    return write_changelog(
        totals, path, checkpoint, available_now=available_now, keys=["player"], compact_every=compact_every
    )


def team_stats(
    feed: DataFrame, path: str, checkpoint: str, available_now: bool = False, compact_every: int | None = None
) -> StreamingQuery:
    """All-time team standings: each batch stores the standings it changed."""
    standings = stats.team_stats(stats.match_outcomes(parse.match_ends(parse.parse_feed(feed))))
    return write_changelog(
        standings, path, checkpoint, available_now=available_now, keys=["team"], compact_every=compact_every
    )


def live_matches(
    feed: DataFrame, path: str, checkpoint: str, available_now: bool = False, compact_every: int | None = None
) -> StreamingQuery:
    """Scores of matches that are not over, by game key; a final removes its match."""
    return write_changelog(
        latest.live_changes(parse.parse_feed(feed)), path, checkpoint, available_now=available_now,
        keys=["game_key"], compact_every=compact_every, removed="removed",
    )


def open_odds(
    feed: DataFrame, path: str, checkpoint: str, available_now: bool = False, compact_every: int | None = None
) -> StreamingQuery:
    """Newest odds of matches that are not over, by game key; a final removes its match."""
    priced = stats.odds(latest.open_plays(parse.parse_feed(feed)))
    blank, none = F.lit(""), F.lit(0.0)
    shown = priced.select(
        "game_key",
        F.coalesce("teamA", blank).alias("teamA"),
        F.coalesce("teamB", blank).alias("teamB"),
        F.coalesce("oddsA", none).alias("oddsA"),
        F.coalesce("oddsB", none).alias("oddsB"),
        "removed",
    )
    return write_changelog(
        shown, path, checkpoint, available_now=available_now,
        keys=["game_key"], compact_every=compact_every, removed="removed",
    )


def odds(feed: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Odds of every play; no state and no shuffle."""
    priced = stats.odds(parse.plays(parse.parse_feed(feed)))
    return write_stream(priced, path, checkpoint, available_now=available_now)


def hot_streak_windows(scoring: DataFrame, size: str, threshold: int = 2) -> DataFrame:
    """Streaming hot streaks, one row when a window closes; plays of closed windows drop."""
    return streaks.hot_streaks(scoring.withWatermark("ts", "0 seconds"), size, threshold)


def simultaneous_windows(alerts: DataFrame, size: str, min_count: int = 2) -> DataFrame:
    """Streaming counts over a stored table of alerts, by their own time."""
    return streaks.simultaneous_streaks(alerts.withWatermark("alert_ts", "0 seconds"), size, min_count)


def chained_simultaneous(
    scoring: DataFrame, size: str, together: str, threshold: int = 2, min_count: int = 2
) -> DataFrame:
    """Both window steps in one query, without a table between them.

    Faster, but an alert then counts at the end of its window, not at its last play,
    which moves it by up to one window length.
    """
    first = (
        scoring.withWatermark("ts", "0 seconds")
        .groupBy(F.window("ts", size).alias("w"), "player")
        .agg(F.sum("points").alias("points"))
        .where(F.col("points") > threshold)
    )
    return (
        first.groupBy(F.window(F.window_time("w"), together).alias("t"))
        .agg(F.count("*").alias("streaks"))
        .where(F.col("streaks") >= min_count)
        .select(F.col("t.start").alias("window_start"), F.col("t.end").alias("window_end"), "streaks")
    )


def publish_snapshot(tables: dash.Tables, path: str, batch_id: int) -> None:
    """Write every dashboard table and the document of one trigger."""
    for field in fields(tables):
        table: DataFrame = getattr(tables, field.name)
        table.write.mode("overwrite").parquet(f"{path}/{field.name}/batch_id={batch_id}")
    dash.dashboard(tables).write.mode("overwrite").parquet(f"{path}/document/batch_id={batch_id}")


def live_dashboard(
    feed: DataFrame,
    messages_path: str,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    trigger: str | None = None,
    **settings,
) -> StreamingQuery:
    """Refresh the dashboard once per trigger.

    A batch adds its parsed messages to a table (its own folder, so a repeated batch
    changes nothing) and the dashboard is derived from that table.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"{messages_path}/batch_id={batch_id}"
        parse.parse_feed(batch).write.mode("overwrite").partitionBy("tipo").parquet(own)
        messages = spark.read.option("basePath", messages_path).parquet(messages_path)
        earlier = messages.where(F.col("batch_id") <= batch_id).drop("batch_id")
        stored = f"{path}/segmented/batch_id={batch_id}"
        segment(earlier).write.mode("overwrite").partitionBy("tipo").parquet(stored)
        publish_snapshot(dash.tables(spark, spark.read.parquet(stored), **settings), path, batch_id)

    writer = feed.writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.foreachBatch(refresh).start()
