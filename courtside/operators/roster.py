"""Teams and players of a player list: starters, samples, schedules, weighted picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_HASH_DIGITS = 13


def _seeded(value: Column, seed: int) -> Column:
    """A reproducible hash of a row value; the same on every run and cluster size."""
    return F.md5(F.concat_ws("|", value, F.lit(str(seed))))


def uniform(value: Column, seed: int) -> Column:
    """A reproducible number in (0, 1) drawn from a row value."""
    digits = F.substring(_seeded(value, seed), 1, _HASH_DIGITS)
    number = F.conv(digits, 16, 10).cast("bigint").cast("double")
    return (number + F.lit(0.5)) / F.lit(float(16**_HASH_DIGITS))


def teams(players: DataFrame) -> DataFrame:
    return players.select("Team").distinct()


def sample_teams(players: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` distinct teams in a reproducible random order, numbered from 0."""
    picked = (
        teams(players)
        .withColumn("h", _seeded(F.col("Team"), seed))
        .orderBy("h", "Team")
        .limit(n)
    )
    # At most n rows, the size of a season.
    number = F.row_number().over(Window.orderBy("h", "Team")) - 1
    return picked.select(number.cast("int").alias("idx"), F.col("Team").alias("team"))


def round_robin(teams: DataFrame, n: int | None = None) -> DataFrame:
    """Every pair of teams once, in rounds (circle method); an odd team sits out.

    ``teams`` has ``idx`` 0..n-1. Each team computes its own place in every round, so
    the schedule is one narrow projection and a join for the names.
    """
    n = teams.count() if n is None else n
    m = n + n % 2
    if n < 2:
        return teams.limit(0).select(
            F.lit(0).alias("round"), F.lit(0).alias("slot"), F.col("team").alias("home"), F.col("team").alias("away")
        )
    turn = F.col("round")
    fixed = F.lit(m - 1)
    # Team 0 stays; team t >= 1 stands at this position in the given round.
    position = F.when(F.col("idx") == 0, F.lit(0)).otherwise(
        F.pmod(F.col("idx") - 1 + turn, fixed) + 1
    )
    opposite = F.lit(m - 1) - F.col("position")
    opponent = F.when(opposite == 0, F.lit(0)).otherwise(
        F.pmod(opposite - 1 - turn, fixed) + 1
    )
    games = (
        teams.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(m - 2))))
        .withColumn("position", position)
        .withColumn("opponent", opponent)
        .where((F.col("position") < m // 2) & (F.col("opponent") < n))
    )
    names = teams.select(F.col("idx").alias("opponent"), F.col("team").alias("away"))
    return games.join(names, "opponent").select(
        (turn + 1).alias("round"),
        F.col("position").cast("int").alias("slot"),
        F.col("team").alias("home"),
        "away",
    )


def starters(players: DataFrame, n: int = 5, order: str = "idx") -> DataFrame:
    """Label the first ``n`` players of each team (list order) starters, the rest reserves.

    Only the first ``n`` rows per team are ranked (cut before the shuffle); everyone
    else is compared with the last of them.
    """
    listed = Window.partitionBy("Team").orderBy(order)
    cut = (
        players.select("Team", order)
        .withColumn("r", F.row_number().over(listed))
        .where(F.col("r") <= n)
        .groupBy("Team")
        .agg(F.max(order).alias("_cut"))
    )
    slot = F.when(F.col(order) <= F.col("_cut"), "starter").otherwise("reserve")
    return players.join(cut, "Team").select(*players.columns, slot.alias("slot"))


def weighted_pick(
    players: DataFrame, group: list[str], mode: str = "equal", seed: int = 0, id_col: str = "Player"
) -> DataFrame:
    """One row per group; chance proportional to Rank (``max``), 11 - Rank (``min``) or equal.

    Every row draws a key from its own identity and weight and the smallest key wins,
    so the pick is an aggregate with map-side combine.
    """
    weights = {"equal": F.lit(1.0), "min": F.lit(11.0) - F.col("Rank"), "max": F.col("Rank") + F.lit(0.0)}
    weight = weights[mode]
    draw = -F.log(uniform(F.col(id_col), seed)) / weight
    eligible = players.where(weight > 0).withColumn("_draw", F.struct(draw.alias("d"), F.col(id_col)))
    row = F.struct(*[c for c in players.columns if c not in group])
    return eligible.groupBy(*group).agg(F.min_by(row, "_draw").alias("r")).select(*group, "r.*")
