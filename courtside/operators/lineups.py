"""Starters and reserves after substitutions.

A substitution swaps two players only when one is a starter and the other a reserve, so
its effect depends on all swaps before it. Replaying a match side in one go would collect
an unbounded list; two facts allow it in time buckets instead:

* which *side* each player is on follows from swapping the two players' sides always
  (two players of one side swap nothing), and such swaps compose like permutations;
* once the sides at the start of a bucket are known, the bucket can be replayed alone,
  and its effect on positions is a permutation too.

Players are numbered by their place in the start message (starters first), and a
permutation is an array of those numbers. One task holds one bucket of one match side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.operators.ordered import BUCKET_SECONDS, time_bucket
from courtside.operators.parse import match_key
from courtside.schema import ORDER


def _swap(numbers: Column, a: Column, b: Column) -> Column:
    return F.transform(
        numbers,
        lambda x, i: F.when(i == a, F.get(numbers, b)).when(i == b, F.get(numbers, a)).otherwise(x),
    )


def _compose(first: Column, then: Column) -> Column:
    return F.transform(then, lambda x: F.get(first, x))


def _unchanged(n: Column) -> Column:
    return F.sequence(F.lit(0), n - 1)


def _changes_in_order() -> Column:
    """The changes of a match side, one per bucket that has substitutions."""
    return F.sort_array(F.collect_list(F.struct("bucket", "change")))


def lineups(
    start_teams: DataFrame, plays: DataFrame, bucket_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """Final slot and position of every roster player of each match side."""
    key = [*match_key(start_teams), "team"]
    sides = start_teams.select(
        *key,
        F.concat("starters", "reserves").alias("names"),
        F.size("starters").alias("n_starters"),
    ).where(F.size("names") > 0)

    number = {c: (F.array_position("names", F.col(c)) - 1).cast("int") for c in ("player", "player2")}
    swaps = (
        plays.where(F.col("action") == "SUBSTITUTION")
        .select(*key, *ORDER, "player", "player2")
        .join(sides, key)
        .select(
            *key,
            *ORDER,
            "n_starters",
            F.size("names").alias("n"),
            number["player"].alias("a"),
            number["player2"].alias("b"),
        )
        .where((F.col("a") >= 0) & (F.col("b") >= 0) & (F.col("a") != F.col("b")))
    )
    buckets = (
        swaps.groupBy(*key, "n", "n_starters", time_bucket("ts", bucket_seconds).alias("bucket"))
        .agg(F.sort_array(F.collect_list(F.struct(*ORDER, "a", "b"))).alias("ops"))
        .withColumn(
            "change",
            F.aggregate(
                "ops", _unchanged(F.col("n")), lambda acc, op: _swap(acc, op["a"], op["b"])
            ),
        )
    )

    # Sides at the start of each bucket: the changes of all buckets before it.
    def extend(acc: Column, item: Column) -> Column:
        return F.struct(
            _compose(acc["sides"], item["change"]).alias("sides"),
            F.concat(
                acc["starts"],
                F.array(F.struct(item["bucket"].alias("bucket"), acc["sides"].alias("sides"))),
            ).alias("starts"),
        )

    nothing_yet = F.array().cast("array<struct<bucket: bigint, sides: array<int>>>")
    at_start = (
        buckets.groupBy(*key, "n")
        .agg(_changes_in_order().alias("changes"))
        .select(
            *key,
            F.explode(
                F.aggregate(
                    "changes",
                    F.struct(_unchanged(F.col("n")).alias("sides"), nothing_yet.alias("starts")),
                    extend,
                )["starts"]
            ).alias("s"),
        )
        .select(*key, F.col("s.bucket").alias("bucket"), F.col("s.sides").alias("sides"))
    )

    def replay(acc: Column, op: Column) -> Column:
        def starts(player: Column) -> Column:
            return F.get(F.col("sides"), F.get(acc, player)) < F.col("n_starters")

        return F.when(
            starts(op["a"]) != starts(op["b"]), _swap(acc, op["a"], op["b"])
        ).otherwise(acc)

    final = (
        buckets.join(at_start, [*key, "bucket"])
        .select(*key, "n", "bucket", F.aggregate("ops", _unchanged(F.col("n")), replay).alias("change"))
        .groupBy(*key, "n")
        .agg(_changes_in_order().alias("changes"))
        .select(
            *key,
            F.aggregate(
                "changes", _unchanged(F.col("n")), lambda acc, c: _compose(acc, c["change"])
            ).alias("places"),
        )
    )
    place = F.coalesce(F.get("places", F.col("i")), F.col("i"))
    starter = F.col("place") < F.col("n_starters")
    return (
        sides.join(final, key, "left")
        .select(*key, "n_starters", "places", F.posexplode("names").alias("i", "player"))
        .withColumn("place", place)
        .select(
            *key,
            F.when(starter, "starter").otherwise("reserve").alias("slot"),
            F.when(starter, F.col("place"))
            .otherwise(F.col("place") - F.col("n_starters"))
            .alias("pos"),
            "player",
        )
    )
