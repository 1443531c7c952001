"""Team ranking and player leaders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.functions.text import NO_VALUE, rounded_average
from courtside.operators.segments import current_season
from courtside.operators.stats import team_stats

POINTS_PER_WIN = 3
LEADERS = 3


def of_season_teams(stats: DataFrame, season_teams: DataFrame) -> DataFrame:
    """Statistics of the teams that play in a season; ``stats`` has one row per team."""
    return stats.join(season_teams.select("team").distinct(), "team", "left_semi")


def of_each_season(stats: DataFrame, season_teams: DataFrame) -> DataFrame:
    """Statistics of the teams of every season, one row per season and team that has any."""
    return season_teams.select("season_id", "team").distinct().join(stats, "team")


def season_standings(stats: DataFrame, season_teams: DataFrame) -> DataFrame:
    """One row per team of each season; teams without a result have zeros."""
    zero = F.lit(0).cast("bigint")
    filled = [F.coalesce(c, zero).alias(c) for c in ("win", "lose", "point_made", "point_take")]
    return season_teams.join(stats, ["season_id", "team"], "left").select(
        "season_id", "team", "seed", *filled
    )


def standings(outcomes: DataFrame, season_teams: DataFrame, scope: str = "season") -> DataFrame:
    """Standings of every season, or of the current one with all-time totals.

    ``all_time`` shows a team's totals over all seasons once it has a result in the
    current one, as a job that never resets its counters would publish them.
    """
    if scope == "season":
        return season_standings(team_stats(outcomes, ["season_id"]), season_teams)
    if scope != "all_time":
        raise ValueError(f"unknown scope: {scope}")
    now = current_season(season_teams, season_teams)
    seen = current_season(outcomes, season_teams).select("season_id", "team").distinct()
    totals = seen.join(of_season_teams(team_stats(outcomes), now), "team")
    return season_standings(totals, now)


def ranking(
    standings: DataFrame, catalog: DataFrame, matchups: DataFrame | None = None
) -> DataFrame:
    """Teams of each season by points, wins and seed, with full name and last match.

    A season's teams come from one message, so one season's ranking is one small group.
    """
    points = F.col("win") * POINTS_PER_WIN
    order = Window.partitionBy("season_id").orderBy(F.desc("points"), F.desc("win"), "seed")
    ranked = standings.withColumn("points", points).withColumn("rank", F.row_number().over(order))
    named = ranked.join(
        F.broadcast(catalog), F.upper("team") == F.col("abbr"), "left"
    ).select(
        "season_id",
        "rank",
        "team",
        F.coalesce("full_name", "team").alias("team_name"),
        "points",
        F.col("win").alias("wins"),
        F.col("lose").alias("losses"),
    )
    return named if matchups is None else named.join(matchups, ["season_id", "team"], "left")


def player_totals(points: DataFrame, games: DataFrame, context: DataFrame) -> DataFrame:
    """Season total, games and rounded average of each player, with the latest team."""
    key = ["season_id", "player"]
    n_games = F.coalesce("games", F.lit(0).cast("bigint"))
    return (
        points.join(games, key, "left")
        .join(context.select(*key, "team"), key, "left")
        .select(
            *key,
            F.coalesce("team", F.lit(NO_VALUE)).alias("team"),
            "total",
            n_games.alias("games"),
            rounded_average("total", n_games).alias("average"),
        )
    )


def player_leaders(
    totals: DataFrame, k: int = LEADERS, category: str = "points", as_coded: bool = False
) -> DataFrame:
    """The ``k`` leading scorers of each season.

    Most points first, then average, then name. ``as_coded`` gives the fewest points
    first, which is what a doubly reversed comparator yields. Assists are not recorded,
    so that category is empty.
    """
    by_points = F.asc("total") if as_coded else F.desc("total")
    order = Window.partitionBy("season_id").orderBy(by_points, F.desc("average"), "player")
    counted = totals.where(F.lit(category.lower() != "assists") & (F.col("total") > 0))
    return (
        counted.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("season_id", "rank", "player", "team", "total", "games", "average")
    )
