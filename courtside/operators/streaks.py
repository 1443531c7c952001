"""Hot streaks: points in tumbling windows, alerts, and streaks at the same time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.functions.text import NO_VALUE, alert_message, is_blank, parse_alert, simultaneous_message
from courtside.functions.scoreboard import scoreboard
from courtside.operators.latest import context_rows, match_lines
from courtside.operators.ordered import BUCKET_SECONDS, running, seconds, stream_clock
from courtside.schema import FINAL, MATCH, ORDER, START

HOT_STREAK_WINDOW = "5 seconds"
SIMULTANEOUS_WINDOW = "2 seconds"


def _running_in_windows(
    rows: DataFrame, by: list[str], order: list[str], sums: dict, size: str
) -> DataFrame:
    """Running sums inside tumbling windows; long windows are cut into buckets."""
    if seconds(size) > BUCKET_SECONDS:
        return running(rows, [*by, "window_start"], order, sums)
    so_far = (
        Window.partitionBy(*by, "window_start")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.withColumns({n: F.sum(c).over(so_far) for n, c in sums.items()})


def _windowed(rows: DataFrame, ts: str, size: str) -> DataFrame:
    window = F.window(ts, size)
    return rows.withColumns(
        {"window_start": window["start"], "window_end": window["end"]}
    )


def in_stream_time(
    scoring: DataFrame, size: str = HOT_STREAK_WINDOW, arrival: list[str] | None = None, block: int = 100_000
) -> DataFrame:
    """The plays that a job with a clock per record would count, without grace.

    The clock of a feed partition is the newest time that has arrived in it, the record itself
    included; a play whose window has ended by that clock is late. Plays without a player
    neither count nor move the clock. ``arrival`` is the order of arrival, by default the offset.
    """
    plays = scoring.where(F.col("player").isNotNull())
    clocked = stream_clock(plays, ["partition"], arrival or ["offset"], block)
    return _windowed(clocked, "ts", size).where(F.col("window_end") > F.col("clock")).select(*scoring.columns)


def hot_streaks(
    scoring: DataFrame,
    size: str = HOT_STREAK_WINDOW,
    threshold: int = 2,
    emit: str = "final",
) -> DataFrame:
    """Players with more than ``threshold`` points in a tumbling window.

    ``final`` gives one row per player and window; ``updates`` one row for every play
    that leaves the running total above the threshold. The alert time is the newest
    play time in the window so far.
    """
    if emit == "final":
        return (
            scoring.where(F.col("player").isNotNull())
            .groupBy(F.window("ts", size).alias("w"), "player")
            .agg(
                F.sum("points").cast("bigint").alias("points"),
                F.min("ts").alias("first_ts"),
                F.max("ts").alias("alert_ts"),
            )
            .where(F.col("points") > threshold)
            .select(
                "player",
                F.col("w.start").alias("window_start"),
                F.col("w.end").alias("window_end"),
                "points",
                "first_ts",
                "alert_ts",
            )
        )
    if emit != "updates":
        raise ValueError(f"unknown emission: {emit}")
    rows = _windowed(scoring.where(F.col("player").isNotNull()), "ts", size).withColumnRenamed(
        "points", "play_points"
    )
    totals = _running_in_windows(
        rows, ["player"], ORDER, {"points": F.col("play_points")}, size
    )
    keep = [c for c in ("season_id",) if c in scoring.columns]
    return totals.where(F.col("points") > threshold).select(
        *keep,
        *ORDER,
        "player",
        "window_start",
        "window_end",
        "points",
        F.col("ts").alias("alert_ts"),
    )


def alerts(updates: DataFrame) -> DataFrame:
    """Alert records (player, message) from hot-streak updates."""
    return updates.withColumn("message", alert_message("player", "points"))


def simultaneous_streaks(
    alerts: DataFrame,
    size: str = SIMULTANEOUS_WINDOW,
    min_count: int = 2,
    distinct_players: bool = False,
    emit: str = "final",
) -> DataFrame:
    """Alerts per tumbling window of their own time, where there are enough.

    Alert records are counted, so one player may count twice; ``distinct_players``
    counts players instead. Grouping is by window alone, and counts combine map-side.
    """
    if emit == "updates":
        rows = _windowed(alerts, "alert_ts", size)
        order = [c for c in ["alert_ts", *ORDER, "player"] if c in rows.columns]
        counted = _running_in_windows(rows, [], order, {"streaks": F.lit(1)}, size)
        keep = [c for c in ("season_id", *ORDER) if c in rows.columns]
        return counted.where(F.col("streaks") >= min_count).select(
            *keep, "alert_ts", "window_start", "window_end", "streaks"
        )
    window = F.window("alert_ts", size)
    if distinct_players:
        alerts = alerts.select(window.alias("w"), "player").distinct()
    else:
        alerts = alerts.select(window.alias("w"))
    return (
        alerts.groupBy("w")
        .agg(F.count("*").alias("streaks"))
        .where(F.col("streaks") >= min_count)
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "streaks")
    )


def enrich_alerts(
    alerts: DataFrame, rosters: DataFrame, plays: DataFrame, messages: DataFrame
) -> DataFrame:
    """Alerts with the player's team and quarter as they stood at the alert.

    Without a positive quarter, that of the first match of the team which is live at the
    alert is used; ``messages`` is the feed with seasons and matches.
    """
    named = parse_alert("player", "message")
    facts = context_rows(rosters, plays).select(
        "season_id",
        *ORDER,
        F.lit(0).alias("prio"),
        "player",
        "team",
        "quarter",
        F.lit(None).cast("struct<key: string, points: int, message: string>").alias("alert"),
    )
    asked = alerts.withColumn("n", named).select(
        "season_id",
        *ORDER,
        F.lit(1).alias("prio"),
        F.col("n.player").alias("player"),
        F.lit(None).cast("string").alias("team"),
        F.lit(None).cast("int").alias("quarter"),
        F.struct(
            F.col("player").alias("key"), F.col("n.points").alias("points"), "message"
        ).alias("alert"),
    )
    as_of = running(
        facts.unionByName(asked),
        ["season_id", "player"],
        [*ORDER, "prio"],
        lasts={"team_then": F.col("team"), "quarter_then": F.col("quarter")},
    ).where(F.col("alert").isNotNull())
    known = F.when(F.col("quarter_then") > 0, F.col("quarter_then"))
    then = as_of.select(
        "season_id",
        *ORDER,
        "alert",
        "player",
        F.coalesce("team_then", F.lit(NO_VALUE)).alias("team"),
        known.alias("known_quarter"),
    )
    unknown = then.where(F.col("known_quarter").isNull() & ~is_blank("team"))
    live = live_quarters(unknown.select("season_id", *ORDER, "team").distinct(), messages)
    return then.join(live, ["season_id", *ORDER, "team"], "left").select(
        "season_id",
        *ORDER,
        F.col("alert.key").alias("key"),
        "player",
        "team",
        F.coalesce("known_quarter", "live_quarter", F.lit(0)).alias("quarter"),
        F.col("alert.points").alias("points"),
        F.col("alert.message").alias("message"),
    )


def live_quarters(moments: DataFrame, messages: DataFrame) -> DataFrame:
    """``live_quarter`` of the first match of a team that is live at a moment.

    A match is live from its first message until its final or the next start under its
    game key; its teams are those of the line it showed last, none if that is unreadable.
    A moment meets only the matches that were open around it, through the teams named
    when a match began or ended, and only those matches' messages are carried forward.
    """
    lines = match_lines(messages).withColumn("is_final", F.col("tipo") == FINAL)
    spans = lines.groupBy(*MATCH).agg(
        F.min("ts").alias("from_ts"),
        F.min(F.when(F.col("is_final"), F.col("ts"))).alias("to_ts"),
    )
    edge = (F.col("ts") == F.col("from_ts")) | (F.col("tipo") == START) | F.col("is_final")
    titles = lines.join(spans, MATCH).where(edge)
    shown = titles.withColumn("s", scoreboard("line", "dashboard", F.lit(True)))
    teams = F.explode(F.array("s.home", "s.away")).alias("team")
    sides = shown.select(*MATCH, "from_ts", "to_ts", teams).where(~is_blank("team")).distinct()
    during = (F.col("from_ts") <= F.col("ts")) & (F.col("to_ts").isNull() | (F.col("ts") <= F.col("to_ts")))
    asked = (
        moments.join(sides, ["season_id", "team"]).where(during).select(*MATCH, *ORDER, "team")
    )
    nothing = {c: F.lit(None).cast(t) for c, t in lines.select("line", "titled", "quarter", "is_final").dtypes}
    told = lines.join(asked.select(*MATCH).distinct(), MATCH, "left_semi").select(
        *MATCH, *ORDER, F.lit(0).alias("prio"), F.lit(None).cast("string").alias("team"), *nothing
    )
    rows = told.unionByName(asked.withColumns({"prio": F.lit(1), **nothing}))
    is_message = F.col("prio") == 0
    carried = running(
        rows,
        MATCH,
        [*ORDER, "prio"],
        sums={"finals": F.when(F.col("is_final"), 1).otherwise(0)},
        lasts={
            "line_then": F.when(is_message & ~F.col("is_final"), F.struct("line", "titled")),
            "quarter_then": F.when(is_message & ~F.col("is_final"), F.col("quarter")),
            "begun": F.when(is_message, F.struct(*ORDER)),
        },
    ).where(~is_message & (F.col("finals") == 0) & F.col("line_then").isNotNull())
    # Of the matches of one game key the newest that has begun is the one on.
    on = Window.partitionBy("season_id", "game_key", *ORDER, "team").orderBy(F.desc("match_seq"))
    newest = carried.withColumn("n", F.row_number().over(on)).where("n = 1")
    read = newest.withColumn("s", scoreboard(F.col("line_then.line"), "dashboard", F.col("line_then.titled")))
    playing = read.where((F.col("team") == F.col("s.home")) | (F.col("team") == F.col("s.away")))
    starts = spans.select(*MATCH, "from_ts")
    return (
        playing.join(starts, MATCH)
        .groupBy("season_id", *ORDER, "team")
        .agg(
            F.min_by(F.coalesce("quarter_then", F.lit(0)), F.struct("from_ts", "game_key")).alias("live_quarter")
        )
    )


def hot_streak_board(enriched: DataFrame, k: int = 5) -> DataFrame:
    """Per season, the newest alert of each player; the ``k`` with most points."""
    latest = enriched.groupBy("season_id", "key").agg(
        F.max_by(F.struct("player", "team", "quarter", "points"), F.struct(*ORDER, "points")).alias(
            "a"
        )
    )
    best = Window.partitionBy("season_id").orderBy(F.desc("a.points"), "a.player", "key")
    return (
        latest.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("season_id", "rank", "a.*")
    )


def alert_log(alerts: DataFrame, simultaneous: DataFrame, keep: int = 50) -> DataFrame:
    """The newest ``keep`` alerts of each season, both kinds mixed, newest first."""
    streaks = alerts.select("season_id", *ORDER, F.lit(0).alias("kind"), "message")
    together = simultaneous.select(
        "season_id", *ORDER, F.lit(1).alias("kind"), simultaneous_message("streaks").alias("message")
    )
    newest = Window.partitionBy("season_id").orderBy(
        *[F.desc(c) for c in ORDER], F.desc("kind"), F.desc("message")
    )
    return (
        streaks.unionByName(together)
        .withColumn("position", F.row_number().over(newest))
        .where(F.col("position") <= keep)
        .select("season_id", "position", "ts", "message")
    )


def streak_overlaps(streaks: DataFrame, more_than: int = 2) -> DataFrame:
    """Periods in which more than ``more_than`` players are in a streak, with start and end.

    A streak lasts from its first to its last play. Interval ends are swept in time
    order with running counts, so no two streaks are ever paired.
    """
    ends = F.explode(
        F.array(
            F.struct(F.col("first_ts").alias("ts"), F.lit(1).alias("opened"), F.lit(0).alias("closed")),
            F.struct(F.col("alert_ts").alias("ts"), F.lit(0).alias("opened"), F.lit(1).alias("closed")),
        )
    )
    moments = (
        streaks.where(~is_blank("player"))
        .select(ends.alias("e"))
        .groupBy(F.col("e.ts").alias("ts"))
        .agg(F.sum("e.opened").alias("opened"), F.sum("e.closed").alias("closed"))
    )
    swept = running(
        moments, [], ["ts"], {"all_opened": F.col("opened"), "all_closed": F.col("closed")}
    )
    at = F.col("all_opened") - F.col("all_closed") + F.col("closed")
    after = F.col("all_opened") - F.col("all_closed")
    before = at - F.col("opened")
    crowded = swept.select(
        "ts",
        at.alias("players"),
        (before <= more_than).cast("int").alias("starts"),
        (after <= more_than).alias("stops"),
    ).where(F.col("players") > more_than)
    numbered = running(crowded, [], ["ts"], {"period": F.col("starts")})
    return numbered.groupBy("period").agg(
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("end_ts"),
        F.max("players").alias("max_players"),
    ).select("start_ts", "end_ts", "max_players")
