"""Running values over long histories of few keys.

A window over ``partitionBy(key).orderBy(ts)`` puts all rows of a key into one task, and
a third of a feed may belong to one key. Here the history of each key is cut into time
buckets: every bucket is reduced on its own (with map-side combine), a window over those
few bucket rows carries values from bucket to bucket, and the row-level window only
spans one bucket. The result is exact and any one task holds one bucket of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKET_SECONDS = 600

_UNITS = {
    "millisecond": 0.001,
    "second": 1,
    "minute": 60,
    "hour": 3600,
    "day": 86400,
    "week": 604800,
}


def seconds(duration: str) -> float:
    """Length of a duration such as ``"5 seconds"`` or ``"6 hours"``."""
    number, unit = duration.split()
    return float(number) * _UNITS[unit.lower().rstrip("s")]


def time_bucket(ts: Column | str = "ts", length: int = BUCKET_SECONDS) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(ts) / F.lit(length * 1_000_000)).cast("bigint")


def running(
    df: DataFrame,
    by: list[str],
    order: list[str],
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Add running sums and last non-null values, up to and including each row.

    ``order[0]`` must be the timestamp the buckets are cut on. Rows with a NULL in
    ``by`` or in the timestamp belong to no history and are left out.
    """
    sums, lasts = sums or {}, lasts or {}
    inputs = {f"_in_{n}": c for n, c in {**sums, **lasts}.items()}
    rows = df.withColumns({**inputs, "_bucket": time_bucket(order[0], bucket_seconds)})

    ordering = F.struct(*order)
    reduced = rows.groupBy(*by, "_bucket").agg(
        *[F.sum(f"_in_{n}").alias(f"_b_{n}") for n in sums],
        *[
            F.max_by(f"_in_{n}", F.when(F.col(f"_in_{n}").isNotNull(), ordering)).alias(f"_b_{n}")
            for n in lasts
        ],
    )
    before = (
        Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = reduced.select(
        *by,
        "_bucket",
        *[F.sum(f"_b_{n}").over(before).alias(f"_c_{n}") for n in sums],
        *[F.last(f"_b_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in lasts],
    )

    within = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.withColumns(
        {
            **{f"_w_{n}": F.sum(f"_in_{n}").over(within) for n in sums},
            **{f"_w_{n}": F.last(f"_in_{n}", ignorenulls=True).over(within) for n in lasts},
        }
    )
    # Same keys as the window above, so only the bucket rows move for this join.
    joined = local.join(carried, [*by, "_bucket"])
    zero = F.lit(0)
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[
            (F.coalesce(F.col(f"_w_{n}"), zero) + F.coalesce(F.col(f"_c_{n}"), zero)).alias(n)
            for n in sums
        ],
        *[F.coalesce(f"_w_{n}", f"_c_{n}").alias(n) for n in lasts],
    )


def stream_clock(df: DataFrame, by: list[str], order: list[str], block: int = 100_000) -> DataFrame:
    """Add ``clock``: the newest ``ts`` among the rows of ``by`` that have arrived up to each row.

    ``order`` is the order of arrival; ``order[0]`` is a whole number, such as the offset, on
    which arrivals are cut into blocks. Blocks are reduced to their newest time, carried over
    by a window over block rows, and the row window spans one block, so a partition of any
    length is never one task.
    """
    rows = df.withColumn("_block", F.call_function("div", F.col(order[0]), F.lit(block)))
    tops = rows.groupBy(*by, "_block").agg(F.max("ts").alias("_top"))
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select(*by, "_block", F.max("_top").over(earlier).alias("_before"))
    so_far = (
        Window.partitionBy(*by, "_block")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.withColumn("_so_far", F.max("ts").over(so_far))
    # Same keys as the window above, so only the block rows move for this join.
    joined = local.join(carried, [*by, "_block"])
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.greatest("_so_far", "_before").alias("clock"))
