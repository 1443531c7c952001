"""Last-write-wins tables: the newest value of a key in feed order.

The newest *time* of each key is a fixed-width value, so a hash aggregate finds it without
sorting any history. Only the rows of those times, few per key, go on to ``max_by`` over
the full feed order, which settles equal times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions.scoreboard import scoreboard, title_teams
from courtside.functions.text import is_blank
from courtside.operators.parse import control, match_key, plays, start_teams
from courtside.schema import FINAL, ORDER, PLAY, ROUND_START, SEASON_END, SEASON_START, START, order_key


def _last(value: Column | str, when: Column | None = None) -> Column:
    """Newest value; rows failing ``when`` are passed over."""
    return F.max_by(value, order_key() if when is None else F.when(when, order_key()))


def _newest_rows(df: DataFrame, by: list[str], *conditions: Column) -> DataFrame:
    """The rows that hold the newest time of some condition within their key."""
    tops = [F.max(F.when(c, F.col("ts"))).alias(f"_top{i}") for i, c in enumerate(conditions)]
    kept = F.lit(False)
    if by:
        rows = df.join(df.groupBy(*by).agg(*tops), by)
        for i, c in enumerate(conditions):
            kept = kept | (c & (F.col("ts") == F.col(f"_top{i}")))
    else:
        rows = df
        for c, top in zip(conditions, tops):
            kept = kept | (c & (F.col("ts") == df.agg(top).scalar()))
    return rows.where(kept).select(*df.columns)


def match_lines(parsed: DataFrame) -> DataFrame:
    """Start, play and final messages with the score line each one shows.

    ``titled`` marks lines that may name the teams without scores.
    """
    is_start, is_final = F.col("tipo") == START, F.col("tipo") == FINAL
    in_title = is_final | (is_start & is_blank("scoreboard"))
    return parsed.where(F.col("tipo").isin(START, PLAY, FINAL)).withColumns(
        {
            "line": F.when(in_title, F.col("match_line")).otherwise(F.col("scoreboard")),
            "titled": is_start,
        }
    )


def live_matches(parsed: DataFrame) -> DataFrame:
    """Latest score and quarter of every match that is not over.

    Only the newest match of a game key is live. An unreadable score line blanks the
    score; a missing quarter keeps the one before. Lines are read after the last one of
    each match is known, so one line per match is read.
    """
    key = match_key(parsed)
    final = F.col("tipo") == FINAL
    shown, timed = match_lines(parsed), ~final & F.col("quarter").isNotNull()
    times = shown.groupBy(*key).agg(
        F.max(F.when(~final, F.col("ts"))).alias("_line"),
        F.max(F.when(timed, F.col("ts"))).alias("_quarter"),
        F.min(F.when(~final, F.col("ts"))).alias("_start"),
        F.bool_or(final).alias("ended"),
    )
    at = F.col("ts")
    edge = (at == F.col("_line")) | (at == F.col("_start")) | (timed & (at == F.col("_quarter")))
    per_match = (
        shown.where(~final)
        .join(times, key)
        .where(edge)
        .groupBy(*key)
        .agg(
            _last(F.struct("line", "titled")).alias("l"),
            _last("quarter", timed).alias("quarter"),
            F.min(order_key()).alias("start_order"),
            F.bool_or("ended").alias("ended"),
        )
    )
    state = F.struct("l", "quarter", "start_order", "ended")
    newest = per_match.groupBy("season_id", "game_key").agg(
        F.max("match_seq").alias("match_seq"), F.max_by(state, "match_seq").alias("m")
    )
    open_matches = newest.where(~F.col("m.ended")).withColumn(
        "s", scoreboard(F.col("m.l.line"), "dashboard", F.col("m.l.titled"))
    )
    return open_matches.select(
        *key,
        "s.home",
        "s.away",
        "s.home_score",
        "s.away_score",
        F.coalesce("m.quarter", F.lit(0)).alias("quarter"),
        F.col("m.start_order").alias("start_order"),
    )


def live_state(parsed: DataFrame) -> DataFrame:
    """State of each game key as a running aggregate, for streams: the newest of every kind of
    message and whether the key shows no match (``removed``), as after a final.

    Messages count by feed order, whenever they arrive; a start message opens a new match,
    which knows nothing of the one before. State has one row per game key.
    """
    at, final = order_key(), F.col("tipo") == FINAL
    shown = match_lines(parsed).where(F.col("game_key").isNotNull())
    return shown.groupBy("game_key").agg(
        F.max(F.when(F.col("tipo") == START, at)).alias("start"),
        F.max(F.when(final, at)).alias("final"),
        _last(F.struct("line", "titled"), ~final).alias("l"),
        _last(F.struct("quarter", at.alias("at")), ~final & F.col("quarter").isNotNull()).alias("q"),
        _last(F.struct("quarter", "scoreboard", at.alias("at")), F.col("tipo") == PLAY).alias("p"),
    ).withColumn(
        "removed", F.col("l").isNull() | F.coalesce(F.col("final") > F.col("start"), F.col("final").isNotNull())
    )


def _of_this_match(message: str) -> Column:
    """Whether a message of ``live_state`` came after the start of the newest match."""
    return F.col(message).isNotNull() & F.coalesce(F.col(f"{message}.at") >= F.col("start"), F.lit(True))


def live_changes(parsed: DataFrame) -> DataFrame:
    """Latest score and quarter of each game key's newest match; ``removed`` if it is over."""
    state = live_state(parsed).withColumn("s", scoreboard(F.col("l.line"), "dashboard", F.col("l.titled")))
    quarter = F.coalesce(F.when(_of_this_match("q"), F.col("q.quarter")), F.lit(0))
    return state.select(
        "game_key", "s.home", "s.away", "s.home_score", "s.away_score", quarter.alias("quarter"), "removed"
    )


def open_plays(parsed: DataFrame) -> DataFrame:
    """The newest play of each game key's newest match; ``removed`` if it is over or has none."""
    return live_state(parsed).select(
        "game_key", "p.quarter", "p.scoreboard", (F.col("removed") | ~_of_this_match("p")).alias("removed")
    )


def last_plays(plays: DataFrame, by: list[str]) -> DataFrame:
    """The newest play of each key: enough for the newest odds, which each play restates."""
    rest = [c for c in plays.columns if c not in by]
    newest = _newest_rows(plays, by, F.lit(True))
    return newest.groupBy(*by).agg(_last(F.struct(*rest)).alias("p")).select(*by, "p.*")


def latest_odds(odds: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Newest odds, over all rows or per key; missing values read as blank and 0."""
    state = F.struct(
        F.coalesce("teamA", F.lit("")).alias("teamA"),
        F.coalesce("teamB", F.lit("")).alias("teamB"),
        F.coalesce("oddsA", F.lit(0.0)).alias("oddsA"),
        F.coalesce("oddsB", F.lit(0.0)).alias("oddsB"),
    )
    newest = _newest_rows(odds, by or [], F.lit(True))
    return newest.groupBy(*(by or [])).agg(_last(state).alias("o")).select(*(by or []), "o.*")


def game_odds(odds: DataFrame, match_ends: DataFrame) -> DataFrame:
    """Newest odds of each match that has no final yet."""
    key = match_key(odds)
    return latest_odds(odds, key).join(match_ends.select(*key), key, "left_anti")


def _odds_of(team: Column) -> Column:
    """Odds of a team by name; a nameless or unlisted team has none."""
    return F.when(
        ~is_blank(team),
        F.when(team == F.col("teamA"), F.col("oddsA")).when(
            team == F.col("teamB"), F.col("oddsB")
        ),
    )


def team_matchups(parsed: DataFrame, odds: DataFrame) -> DataFrame:
    """Last match of each team and season: both scores, both odds, and whether it is live.

    Each match is reduced to its last readable live line and its final before rows are
    spread to teams.
    """
    key = match_key(parsed)
    named = ~is_blank("s.home") & ~is_blank("s.away")
    final = F.col("tipo") == FINAL
    # Unreadable lines are passed over inside the aggregate: a filter on the score would
    # be pushed below its projection and read every line twice.
    lines = (
        match_lines(parsed)
        .withColumn("s", scoreboard("line", "dashboard", F.col("titled")))
        .select(*key, *ORDER, final.alias("is_final"), "s")
    )
    per_match = (
        _newest_rows(lines, [*key, "is_final"], named)
        .groupBy(*key, "is_final")
        .agg(_last("s", named).alias("s"), F.max(F.when(named, order_key())).alias("at"))
        .where(F.col("at").isNotNull())
    )
    priced = per_match.join(latest_odds(odds, key), key, "left")
    home, away = F.col("s.home"), F.col("s.away")
    home_odds, away_odds = _odds_of(home), _odds_of(away)
    live = ~F.col("is_final")

    def row(team, score, price, other, other_score, other_price) -> Column:
        return F.struct(
            team.alias("team"),
            score.alias("team_score"),
            price.alias("team_odds"),
            other.alias("opponent"),
            other_score.alias("opponent_score"),
            other_price.alias("opponent_odds"),
            live.alias("live"),
        )

    home_score, away_score = F.col("s.home_score"), F.col("s.away_score")
    sides = F.explode(
        F.array(
            row(home, home_score, home_odds, away, away_score, away_odds),
            row(away, away_score, away_odds, home, home_score, home_odds),
        )
    )
    rows = priced.select("season_id", "at", sides.alias("m"))
    newest = rows.groupBy("season_id", F.col("m.team").alias("team")).agg(
        F.max_by("m", "at").alias("m")
    )
    return newest.select("season_id", "m.*")


def season_info(parsed: DataFrame, label: str = "2025/2026") -> DataFrame:
    """Label, current round and end flag of each season."""
    marks = control(parsed).where(
        (F.col("tipo") != SEASON_START) | (F.size("teams") > 0)
    )
    is_round = (F.col("tipo") == ROUND_START) & F.col("round").isNotNull()
    return marks.groupBy("season_id").agg(
        F.lit(label).alias("label"),
        F.coalesce(_last("round", is_round), F.lit(0)).alias("current_round"),
        F.bool_or(F.col("tipo") == SEASON_END).alias("season_ended"),
    )


def match_teams(parsed: DataFrame) -> DataFrame:
    """Home and away of each started match: from its title, else the first two teams."""
    key = match_key(parsed)
    named = start_teams(parsed).groupBy(*key).agg(
        F.max_by("team", F.when(F.col("team_pos") == 0, order_key())).alias("first"),
        F.max_by("team", F.when(F.col("team_pos") == 1, order_key())).alias("second"),
        F.max(F.col("team_pos") == 1).alias("has_two"),
    )
    titles = (
        parsed.where(F.col("tipo") == START)
        .groupBy(*key)
        .agg(_last("match_line").alias("title"))
        .withColumn("t", title_teams("title"))
    )
    complete = (F.col("t.home") != "") & (F.col("t.away") != "")
    use_title = F.coalesce(complete, F.lit(False)) | ~F.coalesce("has_two", F.lit(False))
    return titles.join(named, key, "left").select(
        *key,
        "title",
        F.when(use_title, F.coalesce("t.home", F.lit(""))).otherwise(F.col("first")).alias("home"),
        F.when(use_title, F.coalesce("t.away", F.lit(""))).otherwise(F.col("second")).alias("away"),
    )


def match_scores(parsed: DataFrame) -> DataFrame:
    """Last readable (wide) score line and last positive quarter of each match."""
    key = match_key(parsed)
    line = F.when(F.col("tipo") == FINAL, F.col("match_line")).otherwise(F.col("scoreboard"))
    shown = parsed.where(F.col("tipo").isin(PLAY, FINAL)).withColumn("line", line)
    lines = shown.withColumn("s", scoreboard("line", "wide")).select(*key, *ORDER, "tipo", "quarter", "s")
    readable = F.col("s").isNotNull()
    timed = (F.col("tipo") == PLAY) & F.coalesce(F.col("quarter") > 0, F.lit(False))
    newest = _newest_rows(lines, key, readable, timed)
    values = newest.groupBy(*key).agg(
        _last("s", readable).alias("s"), _last("quarter", timed).alias("quarter")
    )
    return (
        shown.groupBy(*key)
        .agg(F.bool_or(F.col("tipo") == FINAL).alias("ended"))
        .join(values, key, "left")
        .select(
            *key,
            "s.home",
            F.coalesce("s.home_score", F.lit(0)).alias("home_score"),
            F.coalesce("s.away_score", F.lit(0)).alias("away_score"),
            "s.away",
            F.coalesce("quarter", F.lit(-1)).alias("quarter"),
            "ended",
        )
    )


def context_rows(rosters: DataFrame, plays: DataFrame) -> DataFrame:
    """What each message tells about a player: team and quarter, NULL where nothing.

    Rosters and plays give the team. A scoring play gives its quarter whatever it is,
    another play naming a player only a positive one.
    """
    keep = ["season_id", "ts", "partition", "offset"]
    from_rosters = rosters.where(~is_blank("player")).select(
        *keep, "player", "team", F.lit(None).cast("int").alias("quarter")
    )
    team = F.when(~is_blank("team"), F.col("team"))
    quarter = F.when(
        (F.col("action") == "POINT") | (F.col("quarter") > 0), F.col("quarter")
    )
    from_plays = plays.where(~is_blank("subject")).select(
        *keep, F.col("subject").alias("player"), team.alias("team"), quarter.alias("quarter")
    )
    return from_rosters.unionByName(from_plays)


def player_context(rosters: DataFrame, plays: DataFrame) -> DataFrame:
    """Latest team and quarter of each player and season."""
    key = ["season_id", "player"]
    told = context_rows(rosters, plays)
    has_team, has_quarter = F.col("team").isNotNull(), F.col("quarter").isNotNull()
    newest = _newest_rows(told, key, has_team, has_quarter)
    values = newest.groupBy(*key).agg(
        _last("team", has_team).alias("team"), _last("quarter", has_quarter).alias("quarter")
    )
    return told.select(*key).distinct().join(values, key, "left")
