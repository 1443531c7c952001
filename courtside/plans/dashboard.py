"""The dashboard: every table it shows, and one nested document per season."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.operators import boxscore, latest, stats, streaks
from courtside.operators.lineups import lineups
from courtside.operators.parse import (
    control,
    match_ends,
    plays,
    rosters,
    scoring_plays,
    start_teams,
)
from courtside.operators.segments import seed_order
from courtside.plans import ranking as rank
from courtside.plans.catalog import team_catalog
from courtside.schema import MATCH

DOCUMENT_ENTRIES = 10_000


@dataclass(frozen=True)
class Tables:
    """What the dashboard is made of; each a DataFrame with a ``season_id``."""

    info: DataFrame
    ranking: DataFrame
    leaders: DataFrame
    hot: DataFrame
    live: DataFrame
    points: DataFrame
    standings: DataFrame
    odds: DataFrame
    log: DataFrame


def tables(
    spark: SparkSession,
    segmented: DataFrame,
    label: str = "2025/2026",
    streak_window: str = streaks.HOT_STREAK_WINDOW,
    simultaneous_window: str = streaks.SIMULTANEOUS_WINDOW,
    extra_names: dict[str, str] | None = None,
) -> Tables:
    """All dashboard tables from a feed with seasons and matches assigned.

    ``segmented`` is read by every table, so pass a stored table
    (:func:`courtside.sources.store.stage`).
    """
    played, started = plays(segmented), rosters(segmented)
    scored, ended = scoring_plays(played), match_ends(segmented)
    priced = stats.odds(latest.last_plays(played, MATCH))
    seeds = seed_order(control(segmented))
    points = stats.season_player_points(scored)
    context = latest.player_context(started, played)
    live = latest.live_matches(segmented)
    standing = rank.standings(stats.match_outcomes(ended), seeds)
    alerts = streaks.alerts(streaks.hot_streaks(scored, streak_window, emit="updates"))
    together = streaks.simultaneous_streaks(alerts, simultaneous_window, emit="updates")
    return Tables(
        info=latest.season_info(segmented, label),
        ranking=rank.ranking(
            standing, team_catalog(spark, extra_names), latest.team_matchups(segmented, priced)
        ),
        leaders=rank.player_leaders(
            rank.player_totals(points, stats.games_played(started, ended), context)
        ),
        hot=streaks.hot_streak_board(streaks.enrich_alerts(alerts, started, played, segmented)),
        live=live.drop("start_order"),
        points=points,
        standings=standing,
        odds=latest.latest_odds(priced, ["season_id"]),
        log=streaks.alert_log(alerts, together),
    )


def _sharded(df: DataFrame, id_col: str, entries: int) -> DataFrame:
    """Add ``part``: rows of a season spread over parts of about ``entries`` rows.

    ``df`` has a row per season and player; Spark splits a season that is large.
    """
    parts = df.groupBy("season_id").agg(
        F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(entries))).cast("bigint").alias("_parts")
    )
    return df.join(parts, "season_id").withColumn(
        "part", F.pmod(F.xxhash64(id_col), F.col("_parts")).cast("int")
    )


def _map(key: str, value: Column) -> Column:
    return F.map_from_entries(F.collect_list(F.struct(F.col(key), value)))


def snapshot_maps(points: DataFrame, entries: int = DOCUMENT_ENTRIES) -> DataFrame:
    """Player totals of a season as maps of bounded size, one row per part."""
    return (
        _sharded(points, "player", entries)
        .groupBy("season_id", "part")
        .agg(_map("player", F.col("total")).alias("player_points"))
    )


def standings_map(standings: DataFrame) -> DataFrame:
    """Standings of a season as one map; a season's teams fit in one message."""
    row = F.struct("team", "win", "lose", "point_made", "point_take")
    return standings.groupBy("season_id").agg(_map("team", row).alias("team_standings"))


def _list(df: DataFrame, name: str, first: str, *more: str) -> DataFrame:
    """A short table as one ordered list per season."""
    rows = F.sort_array(F.collect_list(F.struct(first, *more)))
    return df.groupBy("season_id").agg(rows.alias(name))


def dashboard(t: Tables) -> DataFrame:
    """One document per season: info, ranking, leaders, streaks, newest odds and alerts.

    All of these are short by definition, so a document is bounded. What grows with the
    season (player totals, live matches) stays in its own tables, ``points`` and ``live``.
    """
    confronto = [
        c
        for c in ("team_score", "team_odds", "opponent", "opponent_score", "opponent_odds", "live")
        if c in t.ranking.columns
    ]
    leaders = ["rank", "player", "team", "total", "games", "average"]
    document = t.info.select(
        "season_id", F.struct("label", "current_round", "season_ended").alias("season")
    )
    for part in (
        _list(t.ranking, "ranking", "rank", "team", "team_name", "points", "wins", "losses", *confronto),
        _list(t.leaders, "leaders_points", *leaders),
        _list(t.hot, "hot_streaks", "rank", "player", "team", "quarter", "points"),
        standings_map(t.standings),
        t.odds.select(
            "season_id", F.struct("teamA", "teamB", "oddsA", "oddsB").alias("latest_odds")
        ),
        _list(t.log, "_alerts", "position", "message"),
    ):
        document = document.join(part, "season_id", "left")
    empty_leaders = F.filter("leaders_points", lambda _: F.lit(False))
    return document.select(
        "season_id",
        "season",
        F.coalesce("ranking", F.array()).alias("ranking"),
        F.coalesce("leaders_points", F.array()).alias("leaders_points"),
        F.coalesce(empty_leaders, F.array()).alias("leaders_assists"),
        F.coalesce("hot_streaks", F.array()).alias("hot_streaks"),
        F.coalesce("team_standings", F.create_map()).alias("team_standings"),
        "latest_odds",
        F.coalesce(F.transform("_alerts", lambda a: a["message"]), F.array()).alias("alerts"),
    )


def match_tables(segmented: DataFrame) -> dict[str, DataFrame]:
    """The terminal board's tables: board, top scorers and final report."""
    played = plays(segmented)
    box = stats.box_score(played)
    lineup = lineups(start_teams(segmented), played)
    return {
        "board": boxscore.match_board(
            latest.match_scores(segmented),
            latest.match_teams(segmented),
            stats.turnovers(played),
            latest.latest_odds(stats.odds(latest.last_plays(played, MATCH)), MATCH),
        ),
        "top_scorers": boxscore.top_scorers(box),
        "report": boxscore.match_report(box, lineup),
    }
