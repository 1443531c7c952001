"""Win probability and decimal odds as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight of the score difference by quarter, bounds of both scales.
QUARTER_WEIGHT = {1: 0.025, 2: 0.05, 3: 0.075, 4: 0.10}
OTHER_QUARTER_WEIGHT = 0.05
PROBABILITY_BOUNDS = (0.06, 0.94)
ODDS_BOUNDS = (1.01, 24.99)


def _within(c: Column, bounds: tuple[float, float]) -> Column:
    return F.least(F.lit(bounds[1]), F.greatest(F.lit(bounds[0]), c))


def win_probability(diff: Column, quarter: Column) -> Column:
    weight = F.lit(OTHER_QUARTER_WEIGHT)
    for q, w in QUARTER_WEIGHT.items():
        weight = F.when(quarter == q, F.lit(w)).otherwise(weight)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(diff * weight)))


def bounded_probability(p: Column) -> Column:
    return _within(p, PROBABILITY_BOUNDS)


def decimal_odds(p: Column) -> Column:
    return _within(F.lit(1.0) / p, ODDS_BOUNDS)
