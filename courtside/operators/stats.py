"""Totals and counters of players, teams and matches.

All are plain grouped aggregates: Spark combines before the shuffle, so a hot player or
team arrives as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.functions.odds import bounded_probability, decimal_odds, win_probability
from courtside.functions.scoreboard import scoreboard
from courtside.functions.text import is_blank, rounded_average
from courtside.operators.parse import match_key


def odds(plays: DataFrame) -> DataFrame:
    """Odds after each play, from the score line it carries (the score before the play).

    An unreadable line still gives a row, with NULL odds.
    """
    keep = [c for c in plays.columns if c in ("game_key", "ts", "partition", "offset", "season_id", "match_seq", "removed")]
    rows = plays.select(*keep, "quarter", scoreboard("scoreboard", "odds").alias("s"))
    p = bounded_probability(
        win_probability(F.col("s.home_score") - F.col("s.away_score"), F.col("quarter"))
    )
    known = F.col("s.home_score").isNotNull()
    return rows.select(
        *keep,
        F.col("s.home").alias("teamA"),
        F.col("s.away").alias("teamB"),
        F.when(known, decimal_odds(p)).alias("oddsA"),
        F.when(known, decimal_odds(F.lit(1.0) - p)).alias("oddsB"),
    )


def match_outcomes(match_ends: DataFrame) -> DataFrame:
    """Two rows per readable final, one per side. A draw is a loss for both."""
    keep = [c for c in match_ends.columns if c != "final_scoreboard"]
    read = match_ends.select(*keep, scoreboard("final_scoreboard").alias("s"))

    def side(team: str, score: str, other: str) -> F.Column:
        return F.struct(
            F.col(f"s.{team}").alias("team"),
            F.col(f"s.{score}").alias("score"),
            F.col(f"s.{other}").alias("op_score"),
            (F.col(f"s.{score}") > F.col(f"s.{other}")).alias("is_win"),
        )

    # An unreadable line explodes to nothing, so no filter repeats the reading.
    sides = F.when(
        F.col("s").isNotNull(),
        F.array(
            side("home", "home_score", "away_score"), side("away", "away_score", "home_score")
        ),
    )
    return read.select(*keep, F.explode(sides).alias("o")).select(*keep, "o.*")


def team_stats(outcomes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Wins, losses, points made and taken per team, over everything seen."""
    return outcomes.groupBy(*(by or []), "team").agg(
        F.sum(F.col("is_win").cast("bigint")).alias("win"),
        F.sum((~F.col("is_win")).cast("bigint")).alias("lose"),
        F.sum("score").cast("bigint").alias("point_made"),
        F.sum("op_score").cast("bigint").alias("point_take"),
    )


def team_averages(stats: DataFrame) -> DataFrame:
    """Average points made and taken per finished match."""
    games = F.col("win") + F.col("lose")
    return stats.select(
        "*",
        games.alias("games"),
        rounded_average("point_made", games).alias("avg_made"),
        rounded_average("point_take", games).alias("avg_take"),
    )


def match_results(outcomes: DataFrame) -> DataFrame:
    """Each team's result in each match, as win or lose."""
    return outcomes.withColumn("result", F.when(F.col("is_win"), "win").otherwise("lose"))


def player_points(scoring: DataFrame) -> DataFrame:
    """All-time total per player name."""
    return scoring.groupBy("player").agg(F.sum("points").cast("bigint").alias("total"))


def season_player_points(scoring: DataFrame) -> DataFrame:
    """Total per player within each season; blank names do not count."""
    return (
        scoring.where(~is_blank("player"))
        .groupBy("season_id", "player")
        .agg(F.sum("points").cast("bigint").alias("total"))
    )


def player_fouls(plays: DataFrame) -> DataFrame:
    return (
        plays.where((F.col("action") == "FOUL") & ~is_blank("player"))
        .groupBy("season_id", "player")
        .agg(F.count("*").alias("fouls"))
    )


def match_players(rosters: DataFrame) -> DataFrame:
    """Distinct named players of each match."""
    return (
        rosters.where(~is_blank("player"))
        .select(*match_key(rosters), "player")
        .dropDuplicates([*match_key(rosters), "player"])
    )


def games_played(rosters: DataFrame, match_ends: DataFrame) -> DataFrame:
    """Finished matches per player, bench included; a match counts once."""
    key = match_key(rosters)
    finished = match_ends.select(*key).dropDuplicates(key)
    return (
        match_players(rosters)
        .join(finished, key, "left_semi")
        .groupBy("season_id", "player")
        .agg(F.count("*").alias("games"))
    )


def player_season_averages(points: DataFrame, fouls: DataFrame, games: DataFrame) -> DataFrame:
    """Points and fouls of a player with their per-game averages."""
    key = ["season_id", "player"]
    total, n_fouls, n_games = (
        F.coalesce(c, F.lit(0).cast("bigint")) for c in ("total", "fouls", "games")
    )
    return (
        points.join(fouls, key, "full")
        .join(games, key, "left")
        .select(
            *key,
            total.alias("total"),
            n_fouls.alias("fouls"),
            n_games.alias("games"),
            rounded_average(total, n_games).alias("avg_points"),
            rounded_average(n_fouls, n_games).alias("avg_fouls"),
        )
    )


def box_score(plays: DataFrame) -> DataFrame:
    """Points, scoring plays and fouls committed per match, team and player, in one pass."""
    key = match_key(plays)
    point, foul = F.col("action") == "POINT", F.col("action") == "FOUL"
    return (
        plays.where((point | foul) & (F.col("player") != ""))
        .groupBy(*key, "team", "player")
        .agg(
            F.coalesce(F.sum(F.when(point, F.col("points"))), F.lit(0))
            .cast("bigint")
            .alias("points"),
            F.count_if(point).alias("scoring_plays"),
            F.count_if(foul).alias("fouls"),
        )
    )


def turnovers(plays: DataFrame) -> DataFrame:
    """Turnovers of both teams per match."""
    return plays.groupBy(*match_key(plays)).agg(
        F.count_if(F.col("action") == "TURNOVER").alias("turnovers")
    )
