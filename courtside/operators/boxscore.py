"""Match board and final report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.operators.parse import match_key


def top_scorers(box: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` best scorers of each match side; ties by name.

    The rank filter lets Spark drop rows before the shuffle. Whoever made a scoring play is
    a scorer, whatever it counted; players with fouls only are none.
    """
    key = [*match_key(box), "team"]
    best = Window.partitionBy(*key).orderBy(F.desc("points"), "player")
    return (
        box.where(F.col("scoring_plays") > 0)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n)
        .select(*key, "rank", "player", "points")
    )


def match_report(box: DataFrame, lineup: DataFrame) -> DataFrame:
    """Every player of each match side with points and fouls, best scorers first.

    Ties keep the order of the side's player list, starters before reserves.
    """
    key = [*match_key(lineup), "team"]
    zero = F.lit(0).cast("bigint")
    rows = lineup.join(box, [*key, "player"], "left").select(
        *key,
        "slot",
        "pos",
        "player",
        F.coalesce("points", zero).alias("points"),
        F.coalesce("fouls", zero).alias("fouls"),
    )
    # One side is the player list of one message.
    order = Window.partitionBy(*key).orderBy(F.desc("points"), F.desc("slot"), "pos")
    return rows.withColumn("line", F.row_number().over(order))


def match_board(
    scores: DataFrame, teams: DataFrame, turnovers: DataFrame, odds: DataFrame
) -> DataFrame:
    """One row per match: teams, score, quarter, turnovers and newest odds."""
    key = match_key(teams)
    return (
        teams.join(scores.withColumnsRenamed({"home": "s_home", "away": "s_away"}), key, "left")
        .join(turnovers, key, "left")
        .join(odds, key, "left")
        .select(
            *key,
            F.coalesce("s_home", "home").alias("home"),
            F.coalesce("home_score", F.lit(0)).alias("home_score"),
            F.coalesce("away_score", F.lit(0)).alias("away_score"),
            F.coalesce("s_away", "away").alias("away"),
            F.coalesce("quarter", F.lit(-1)).alias("quarter"),
            F.coalesce("ended", F.lit(False)).alias("ended"),
            F.coalesce("turnovers", F.lit(0).cast("bigint")).alias("turnovers"),
            "oddsA",
            "oddsB",
        )
    )
