"""Per-input results that need custom keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from courtside.functions.text import alert_message
from courtside.operators.ordered import seconds
from courtside.operators.streaks import HOT_STREAK_WINDOW
from courtside.schema import ORDER


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(ORDER, kind="stable")


def _window_totals(size_ms: int):
    """Running points of the players of one window and part; forgotten once the window is over."""

    def run(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        start_us, _ = key
        end_ms = int(start_us) // 1000 + size_ms
        # The watermark trails the newest time by one window, see hot_streak_updates.
        if end_ms <= state.getCurrentWatermarkMs() + size_ms:
            return
        batch = _in_order(rows)
        before = dict(zip(*state.get)) if state.exists else {}
        earlier = np.array([before.get(p, 0) for p in batch["player"]], np.int64)
        totals = batch.groupby("player", sort=False)["points"].cumsum().astype("int64") + earlier
        # of a player's plays the last one stays
        before.update(zip(batch["player"], totals.tolist()))
        state.update((list(before), list(before.values())))
        state.setTimeoutTimestamp(end_ms)
        yield pd.DataFrame(
            {
                "player": batch["player"],
                "start_us": int(start_us),
                "points": totals,
                "ts": batch["ts"],
                "partition": batch["partition"],
                "offset": batch["offset"],
            }
        )

    return run


def hot_streak_updates(
    scoring: DataFrame, size: str = HOT_STREAK_WINDOW, threshold: int = 2, parts: int = 32
) -> DataFrame:
    """A streaming row, with its alert text, for every play above the threshold.

    State is keyed by window *and* part of the players, so even one player's plays spread
    over tasks, and a window costs at most ``parts`` calls of Python, however many players it has.
    A play of a window that was over before its batch began is dropped. The watermark
    trails by one window, as older plays of a window still open do count.
    """
    rows = (
        scoring.where(F.col("player").isNotNull())
        .withWatermark("ts", size)
        .withColumn("start_us", F.unix_micros(F.window("ts", size)["start"]))
        .withColumn("part", F.pmod(F.xxhash64("player"), F.lit(parts)))
        .select("start_us", "part", "player", "points", *ORDER)
    )
    totals = rows.groupBy("start_us", "part").applyInPandasWithState(
        _window_totals(int(seconds(size) * 1000)),
        outputStructType=(
            "player STRING, start_us BIGINT, points BIGINT, ts TIMESTAMP, `partition` INT, `offset` BIGINT"
        ),
        stateStructType="players ARRAY<STRING>, totals ARRAY<BIGINT>",
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )
    return totals.where(F.col("points") > threshold).select(
        "player",
        F.timestamp_micros("start_us").alias("window_start"),
        "points",
        F.col("ts").alias("alert_ts"),
        "partition",
        "offset",
        alert_message("player", "points").alias("message"),
    )
