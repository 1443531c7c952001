"""Which season and which match each message belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.operators.ordered import time_bucket
from courtside.operators.parse import control
from courtside.schema import ORDER, SEASON_START, START, order_key

# Intervals between markers are cut at days: long enough that few pieces arise, short
# enough that a piece meets few others.
PIECE_SECONDS = 86_400


def _opens_season(parsed: DataFrame) -> DataFrame:
    """Season starts that name at least one team; others change nothing."""
    return control(parsed).where((F.col("tipo") == SEASON_START) & (F.size("teams") > 0))


def season_markers(parsed: DataFrame) -> DataFrame:
    """One row per season start, numbered from 1 in feed order."""
    # A season start is one message of a whole season: the markers are few.
    number = F.row_number().over(Window.orderBy(*ORDER)).cast("bigint")
    return _opens_season(parsed).select(*ORDER, "teams", number.alias("season_id"))


def _numbered(markers: DataFrame, by: list[str], name: str) -> DataFrame:
    """Markers (``by`` and feed order) with their number and the interval up to the next."""
    in_order = Window.partitionBy(*by).orderBy("_from")
    return markers.select(*by, order_key().alias("_from")).select(
        *by,
        F.row_number().over(in_order).cast("bigint").alias(name),
        "_from",
        F.lead("_from").over(in_order).alias("_to"),
    )


def _closed_pieces(numbered: DataFrame, by: list[str], name: str, length: int) -> DataFrame:
    """The intervals that have an end, one row per piece of time they touch."""
    first, last = (time_bucket(F.col(f"{end}.ts"), length) for end in ("_from", "_to"))
    return numbered.where(F.col("_to").isNotNull()).select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col(name).alias("_number"),
        F.col("_from").alias("_begins"),
        F.col("_to").alias("_ends"),
        F.explode(F.sequence(first, last)).alias("_piece"),
    )


def _marked(
    parsed: DataFrame,
    numbered: DataFrame,
    by: list[str],
    name: str,
    newest: DataFrame | None,
    length: int,
) -> DataFrame:
    """Add ``name``: the number of markers of ``by`` up to the row, 0 before the first.

    Rows meet the closed intervals by key and piece of time, an equi-join whose rows need no order;
    what lies behind the newest marker is compared with that marker alone. ``newest`` has
    one row per key, or is None for no key, where a scalar subquery holds the one row.
    """
    here = order_key()
    rows = parsed.withColumn("_at", time_bucket("ts", length))
    pieces = _closed_pieces(numbered, by, name, length)
    met = (F.col("_at") == F.col("_piece")) & (here >= F.col("_begins")) & (here < F.col("_ends"))
    for c in by:
        met = met & (F.col(c) == F.col(f"_{c}"))
    rows = rows.join(pieces, met, "left")
    if newest is None:
        one = numbered.where(F.col("_to").isNull()).agg(F.max(F.struct("_from", name)).alias("_newest"))
        last = one.scalar()
    else:
        rows, last = rows.join(newest, by, "left"), F.col("_newest")
    number = F.when(here >= last["_from"], last[name]).otherwise(F.col("_number"))
    return rows.select(*parsed.columns, F.coalesce(number, F.lit(0).cast("bigint")).alias(name))


def with_season(parsed: DataFrame, piece_seconds: int = PIECE_SECONDS) -> DataFrame:
    """Add ``season_id``: the number of season starts up to the row (0 before the first)."""
    numbered = _numbered(_opens_season(parsed), [], "season_id")
    return _marked(parsed, numbered, [], "season_id", None, piece_seconds)


def with_match(parsed: DataFrame, piece_seconds: int = PIECE_SECONDS) -> DataFrame:
    """Add ``match_seq``: start messages seen so far under the same game key.

    Together with the season and the game key it identifies a match.
    """
    by = ["game_key"]
    numbered = _numbered(parsed.where(F.col("tipo") == START), by, "match_seq")
    newest = numbered.where(F.col("_to").isNull()).select(
        *by, F.struct("_from", "match_seq").alias("_newest")
    )
    return _marked(parsed, numbered, by, "match_seq", newest, piece_seconds)


def segment(parsed: DataFrame) -> DataFrame:
    return with_match(with_season(parsed))


def seed_order(control: DataFrame, seed: int | None = None) -> DataFrame:
    """Teams of each season with their seed position.

    In message order, or in a reproducible shuffled order when a seed is given.
    """
    listed = (
        control.where((F.col("tipo") == SEASON_START) & (F.size("teams") > 0))
        .select("season_id", F.posexplode("teams").alias("pos", "team"))
        .groupBy("season_id", "team")
        .agg(F.min("pos").alias("pos"))
    )
    if seed is None:
        by = [F.col("pos")]
    else:
        by = [F.md5(F.concat_ws("|", "team", F.lit(str(seed)))), F.col("pos")]
    # One season is one message, so a season's teams are few.
    position = F.row_number().over(Window.partitionBy("season_id").orderBy(*by)) - 1
    return listed.select("season_id", "team", position.cast("int").alias("seed"))


def current_season(df: DataFrame, latest: DataFrame) -> DataFrame:
    """Rows of the newest season; ``latest`` is any frame that knows all seasons."""
    newest = latest.agg(F.max("season_id").alias("season_id"))
    return df.join(F.broadcast(newest), "season_id", "left_semi")
