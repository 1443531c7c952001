"""Every operator as a named query over the benchmark tables.

Each entry takes a session and a table folder, reads whole tables and returns a
DataFrame. Window lengths are hours instead of seconds where the tables' events are
minutes apart.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions import text
from courtside.functions.intervals import allen_relation
from courtside.functions.odds import bounded_probability, decimal_odds, win_probability
from courtside.functions.scoreboard import scoreboard, title_teams
from courtside.operators import boxscore, latest, lineups, parse, roster, segments, stats, streaks
from courtside.plans import dashboard as dash
from courtside.plans import ranking as rank
from courtside.plans.catalog import team_catalog
from courtside.schema import MATCH, ORDER, SIMULTANEOUS_TOPIC, STREAK_TOPIC
from courtside.session import configure
from courtside.sources import tables
from courtside.sources.store import new_path, stored_once
from courtside.streaming import jobs, sinks, stateful

Query = Callable[[SparkSession, str], DataFrame]

STREAK_WINDOW = "6 hours"
TOGETHER_WINDOW = "1 hour"
LONG_WINDOW = "1 day"
# Stand-in full names, as the tables' team codes are in no catalogue.
EXTRA_NAMES = {f"T{i}": f"Team {i}" for i in range(0, 2 * tables.GAMES, 2)}

QUERIES: dict[str, Query] = {}


def register(name: str, fn: Query) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fn(configure(spark), sf)

    QUERIES[name] = run


def query(fn: Query) -> Query:
    register(fn.__name__, fn)
    return fn


def _plain_time(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the tables have them."""
    zoned = [n for n, t in df.dtypes if t == "timestamp"]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in zoned})


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_feed(tables.events_feed(spark, sf))


def _plays(spark: SparkSession, sf: str) -> DataFrame:
    """All plays without season and match: only the play records are derived."""
    return parse.plays(parse.parse_feed(tables.plays_feed(tables.table(spark, sf, "events"))))


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    """The parsed feed as a table by message kind."""
    source = f"{sf}/events.parquet"
    return stored_once(spark, "parsed", source, lambda: _parsed(spark, sf), ["tipo"])


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    """The parsed feed with seasons and matches assigned, as a table by message kind."""
    source = f"{sf}/events.parquet"
    return stored_once(
        spark, "segmented", source, lambda: segments.segment(_messages(spark, sf)), ["tipo"]
    )


def _ends(spark: SparkSession, sf: str) -> DataFrame:
    return parse.match_ends(parse.parse_feed(tables.finals_feed(spark, sf)))


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return stats.match_outcomes(_ends(spark, sf))


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


# Messages


@query
def plays(spark, sf):
    return _plain_time(_plays(spark, sf))


@query
def scoring_plays(spark, sf):
    return _plain_time(parse.scoring_plays(_plays(spark, sf)))


@query
def rosters(spark, sf):
    return _plain_time(parse.rosters(_parsed(spark, sf)))


@query
def match_ends(spark, sf):
    return _plain_time(parse.match_ends(_parsed(spark, sf)))


@query
def control(spark, sf):
    marks = parse.control(_parsed(spark, sf))
    return _plain_time(
        marks.select("game_key", *ORDER, "tipo", "round", F.array_join("teams", ",").alias("teams"))
    )


@query
def quarantine(spark, sf):
    bad = parse.quarantine(tables.events_feed(spark, sf))
    return bad.select("partition", "offset", "value", "reason")


# Score lines


def _score_line_query(form: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        lines = tables.score_lines(spark, sf)
        return lines.withColumn("s", scoreboard("line", form, names_only=True)).select(
            "o_orderkey", "s.home", "s.home_score", "s.away_score", "s.away"
        )

    return run


for _form in ("wide", "strict", "dashboard", "odds"):
    register(f"scoreboard_{_form}", _score_line_query(_form))


@query
def title_parse(spark, sf):
    lines = tables.score_lines(spark, sf)
    return lines.withColumn("t", title_teams("line")).select("o_orderkey", "t.home", "t.away")


@query
def match_teams(spark, sf):
    return latest.match_teams(_stored(spark, sf))


# Results of finals


@query
def match_outcomes(spark, sf):
    return _outcomes(spark, sf).select("offset", "team", "score", "op_score", "is_win")


@query
def match_results(spark, sf):
    results = stats.match_results(_outcomes(spark, sf))
    return results.groupBy("team", "result").agg(F.count("*").alias("matches"))


@query
def team_stats(spark, sf):
    return stats.team_stats(_outcomes(spark, sf))


@query
def team_averages(spark, sf):
    return stats.team_averages(stats.team_stats(_outcomes(spark, sf)))


@query
def team_stats_topic(spark, sf):
    value = text.encode_json("win", "lose", "point_made", "point_take")
    return stats.team_stats(_outcomes(spark, sf)).select(
        F.col("team").alias("key"), value.alias("value")
    )


# Seasons and matches


@query
def season_markers(spark, sf):
    marks = segments.season_markers(_messages(spark, sf))
    return _plain_time(marks.select("season_id", "ts", F.size("teams").alias("n_teams")))


@query
def match_segments(spark, sf):
    return parse.plays(segments.segment(_messages(spark, sf))).select("partition", "offset", *MATCH)


@query
def season_segments_by_buckets(spark, sf):
    """Messages of each kind and season, by the bucketed interval join."""
    parsed = segments.with_season(_messages(spark, sf))
    return parsed.groupBy("season_id", "tipo").agg(F.count("*").alias("messages"))


@query
def seed_order(spark, sf):
    return segments.seed_order(parse.control(_stored(spark, sf)))


@query
def seed_order_shuffled(spark, sf):
    return segments.seed_order(parse.control(_stored(spark, sf)), seed=7)


@query
def season_info(spark, sf):
    return latest.season_info(_stored(spark, sf))


# Totals


@query
def player_points(spark, sf):
    return stats.player_points(parse.scoring_plays(_plays(spark, sf)))


@query
def player_points_topic(spark, sf):
    """Totals as the bytes a number topic carries, and read back from them."""
    totals = stats.player_points(parse.scoring_plays(_plays(spark, sf)))
    coded = totals.withColumns({"v4": text.encode_int("total", 4), "v8": text.encode_int("total", 8)})
    return coded.select(
        F.col("player").alias("key"),
        F.hex("v4").alias("int32_hex"),
        F.hex("v8").alias("int64_hex"),
        text.decode_int("v4", 4).alias("int32"),
        text.decode_int("v8", 8).alias("int64"),
    )


@query
def season_player_points(spark, sf):
    return stats.season_player_points(parse.scoring_plays(parse.plays(_stored(spark, sf))))


@query
def player_fouls(spark, sf):
    return stats.player_fouls(parse.plays(_stored(spark, sf)))


@query
def match_players(spark, sf):
    return stats.match_players(parse.rosters(_stored(spark, sf)))


@query
def games_played(spark, sf):
    feed = _stored(spark, sf)
    return stats.games_played(parse.rosters(feed), parse.match_ends(feed))


@query
def player_season_averages(spark, sf):
    feed = _stored(spark, sf)
    played = parse.plays(feed)
    return stats.player_season_averages(
        stats.season_player_points(parse.scoring_plays(played)),
        stats.player_fouls(played),
        stats.games_played(parse.rosters(feed), parse.match_ends(feed)),
    )


@query
def box_score(spark, sf):
    return stats.box_score(parse.plays(_stored(spark, sf)))


@query
def turnovers(spark, sf):
    return stats.turnovers(parse.plays(_stored(spark, sf)))


# Odds


@query
def odds(spark, sf):
    return _plain_time(_rounded(stats.odds(_plays(spark, sf)), "oddsA", "oddsB"))


@query
def odds_topic(spark, sf):
    rows = _rounded(stats.odds(_plays(spark, sf)), "oddsA", "oddsB")
    value = text.encode_json("teamA", "teamB", "oddsA", "oddsB")
    back = text.decode_json("value", "teamA STRING, teamB STRING, oddsA DOUBLE, oddsB DOUBLE")
    return (
        rows.select(F.col("game_key").alias("key"), "offset", value.alias("value"))
        .withColumn("o", back)
        .select("key", "offset", F.col("value").contains("null").alias("has_null"), "o.*")
    )


@query
def win_probabilities(spark, sf):
    rows = stats.match_outcomes(_ends(spark, sf)).select(
        "offset",
        "team",
        (F.col("score") - F.col("op_score")).alias("diff"),
        (F.col("offset") % 6).cast("int").alias("quarter"),
    )
    p = win_probability(F.col("diff"), F.col("quarter"))
    return _rounded(
        rows.withColumns(
            {"p": p, "bounded": bounded_probability(p), "odds": decimal_odds(bounded_probability(p))}
        ),
        "p",
        "bounded",
        "odds",
    )


@query
def latest_odds(spark, sf):
    newest = latest.last_plays(_plays(spark, sf), [])
    return _rounded(latest.latest_odds(stats.odds(newest)), "oddsA", "oddsB")


@query
def latest_odds_by_game(spark, sf):
    newest = latest.last_plays(_plays(spark, sf), ["game_key"])
    found = latest.latest_odds(stats.odds(newest), ["game_key"])
    return _rounded(found, "oddsA", "oddsB")


@query
def open_game_odds(spark, sf):
    feed = _stored(spark, sf)
    newest = latest.last_plays(parse.plays(feed), MATCH)
    found = latest.game_odds(stats.odds(newest), parse.match_ends(feed))
    return _rounded(found, "oddsA", "oddsB")


# Latest values


@query
def live_matches(spark, sf):
    return latest.live_matches(_stored(spark, sf)).drop("start_order")


@query
def team_matchups(spark, sf):
    feed = _stored(spark, sf)
    newest = latest.last_plays(parse.plays(feed), MATCH)
    found = latest.team_matchups(feed, stats.odds(newest))
    return _rounded(found, "team_odds", "opponent_odds")


@query
def player_context(spark, sf):
    feed = _stored(spark, sf)
    return latest.player_context(parse.rosters(feed), parse.plays(feed))


@query
def match_scores(spark, sf):
    return latest.match_scores(_stored(spark, sf))


@query
def match_lineups(spark, sf):
    feed = _stored(spark, sf)
    return lineups.lineups(parse.start_teams(feed), parse.plays(feed))


# Board and report


@query
def top_scorers(spark, sf):
    return boxscore.top_scorers(stats.box_score(parse.plays(_stored(spark, sf))))


@query
def match_report(spark, sf):
    feed = _stored(spark, sf)
    return dash.match_tables(feed)["report"].withColumn("label", text.truncate("player", 4))


@query
def match_board(spark, sf):
    return _rounded(dash.match_tables(_stored(spark, sf))["board"], "oddsA", "oddsB")


# Streaks


def _updates(scoring: DataFrame, size: str = STREAK_WINDOW) -> DataFrame:
    return streaks.hot_streaks(scoring, size, emit="updates")


def _scoring(spark: SparkSession, sf: str) -> DataFrame:
    return parse.scoring_plays(_plays(spark, sf))


@query
def hot_streaks(spark, sf):
    return _plain_time(streaks.hot_streaks(_scoring(spark, sf)))


@query
def hot_streaks_long_window(spark, sf):
    return _plain_time(streaks.hot_streaks(_scoring(spark, sf), STREAK_WINDOW, threshold=5))


@query
def hot_streaks_by_stream_time(spark, sf):
    """Streaks of a feed that arrives out of order, without the plays that came too late."""
    arrival = F.col("offset") + F.pmod(F.col("offset") * 7919, F.lit(4001))
    shuffled = _scoring(spark, sf).withColumn("arrival", arrival)
    counted = streaks.in_stream_time(shuffled, STREAK_WINDOW, ["arrival", "offset"])
    return _plain_time(streaks.hot_streaks(counted, STREAK_WINDOW))


@query
def hot_streak_updates(spark, sf):
    return _plain_time(_updates(_scoring(spark, sf), "5 seconds"))


@query
def hot_streak_updates_long_window(spark, sf):
    return _plain_time(_updates(_scoring(spark, sf)))


@query
def alert_messages(spark, sf):
    sent = streaks.alerts(_updates(_scoring(spark, sf)))
    read = text.parse_alert("player", "message")
    return sent.withColumn("n", read).select(
        "partition", "offset", "player", "message", F.col("n.player").alias("read_player"), F.col("n.points").alias("read_points")
    )


@query
def simultaneous_streaks(spark, sf):
    sent = _updates(_scoring(spark, sf))
    return _plain_time(streaks.simultaneous_streaks(sent, TOGETHER_WINDOW))


@query
def simultaneous_streaks_by_player(spark, sf):
    sent = _updates(_scoring(spark, sf))
    return _plain_time(
        streaks.simultaneous_streaks(sent, TOGETHER_WINDOW, distinct_players=True)
    )


@query
def simultaneous_streak_updates(spark, sf):
    sent = _updates(_scoring(spark, sf))
    return _plain_time(streaks.simultaneous_streaks(sent, TOGETHER_WINDOW, emit="updates"))


@query
def simultaneous_topic(spark, sf):
    """Counts of simultaneous streaks as topic records."""
    found = streaks.simultaneous_streaks(_updates(_scoring(spark, sf)), TOGETHER_WINDOW)
    records = sinks.topic_records(found, SIMULTANEOUS_TOPIC)
    return records.groupBy("key", F.hex("value").alias("int64_hex")).agg(F.count("*").alias("records"))


@query
def alert_topic(spark, sf):
    """Alerts as topic records."""
    sent = streaks.alerts(_updates(_scoring(spark, sf)))
    return sinks.topic_records(sent, STREAK_TOPIC).select("key", F.col("value").alias("message"))


def _enriched(feed: DataFrame) -> DataFrame:
    played = parse.plays(feed)
    sent = streaks.alerts(_updates(parse.scoring_plays(played)))
    return streaks.enrich_alerts(sent, parse.rosters(feed), played, feed)


@query
def enriched_alerts(spark, sf):
    found = _enriched(_stored(spark, sf)).withColumn("quarter_label", text.quarter_label("quarter"))
    return found.select(
        "season_id", "partition", "offset", "player", "team", "quarter", "quarter_label", "points"
    )


@query
def hot_streak_board(spark, sf):
    return streaks.hot_streak_board(_enriched(_stored(spark, sf)))


@query
def alert_log(spark, sf):
    scored = parse.scoring_plays(parse.plays(_stored(spark, sf)))
    sent = streaks.alerts(_updates(scored))
    together = streaks.simultaneous_streaks(sent, TOGETHER_WINDOW, emit="updates")
    return _plain_time(streaks.alert_log(sent, together))


@query
def streak_overlaps(spark, sf):
    found = streaks.hot_streaks(_scoring(spark, sf), STREAK_WINDOW)
    return _plain_time(streaks.streak_overlaps(found))


@query
def streak_relations(spark, sf):
    """How each streak of a player lies to the player's streak of the whole day."""
    key = ["player", F.to_date("window_start").alias("day")]
    short = streaks.hot_streaks(_scoring(spark, sf), STREAK_WINDOW)
    whole = streaks.hot_streaks(_scoring(spark, sf), LONG_WINDOW)
    pairs = short.select(*key, "first_ts", "alert_ts").join(
        whole.select(*key, F.col("first_ts").alias("day_first"), F.col("alert_ts").alias("day_last")),
        ["player", "day"],
    )
    relation: Column = allen_relation(
        F.col("first_ts"), F.col("alert_ts"), F.col("day_first"), F.col("day_last")
    )
    return pairs.groupBy(relation.alias("relation")).agg(F.count("*").alias("streaks"))


# Standings, ranking, leaders


def _seeds(feed: DataFrame) -> DataFrame:
    return segments.seed_order(parse.control(feed))


def _season_outcomes(feed: DataFrame) -> DataFrame:
    return stats.match_outcomes(parse.match_ends(feed))


@query
def season_standings(spark, sf):
    feed = _stored(spark, sf)
    return rank.standings(_season_outcomes(feed), _seeds(feed))


@query
def all_time_standings(spark, sf):
    feed = _stored(spark, sf)
    return rank.standings(_season_outcomes(feed), _seeds(feed), scope="all_time")


@query
def season_team_stats(spark, sf):
    """All-time results of orders, for the teams of every season's list."""
    return rank.of_each_season(stats.team_stats(_outcomes(spark, sf)), _seeds(_stored(spark, sf)))


@query
def ranking(spark, sf):
    feed = _stored(spark, sf)
    standing = rank.standings(_season_outcomes(feed), _seeds(feed))
    newest = latest.last_plays(parse.plays(feed), MATCH)
    matchups = latest.team_matchups(feed, stats.odds(newest))
    found = rank.ranking(standing, team_catalog(spark, EXTRA_NAMES), matchups)
    labelled = found.withColumn("odds_label", text.odds_label("team_odds"))
    return _rounded(labelled, "team_odds", "opponent_odds")


def _totals(feed: DataFrame) -> DataFrame:
    played, started = parse.plays(feed), parse.rosters(feed)
    return rank.player_totals(
        stats.season_player_points(parse.scoring_plays(played)),
        stats.games_played(started, parse.match_ends(feed)),
        latest.player_context(started, played),
    )


@query
def player_totals(spark, sf):
    return _totals(_stored(spark, sf))


@query
def player_leaders(spark, sf):
    found = rank.player_leaders(_totals(_stored(spark, sf)))
    return found.withColumn("label", text.average_label("games", "average"))


@query
def player_leaders_as_coded(spark, sf):
    return rank.player_leaders(_totals(_stored(spark, sf)), as_coded=True)


def _now_query(name: str) -> Query:
    """What a live board shows: the newest season only."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return segments.current_season(QUERIES[name](spark, sf), latest.season_info(_stored(spark, sf)))

    return run


for _name in ("season_info", "ranking", "player_leaders", "hot_streak_board"):
    register(f"{_name}_now", _now_query(_name))


def _dashboard_tables(spark: SparkSession, sf: str) -> dash.Tables:
    return dash.tables(
        spark,
        _stored(spark, sf),
        streak_window=STREAK_WINDOW,
        simultaneous_window=TOGETHER_WINDOW,
        extra_names=EXTRA_NAMES,
    )


@query
def snapshot_maps(spark, sf):
    """Player totals through maps of at most about 50 entries, and back to rows."""
    totals = stats.season_player_points(parse.scoring_plays(parse.plays(_stored(spark, sf))))
    maps = dash.snapshot_maps(totals, entries=50)
    return maps.select("season_id", F.explode("player_points").alias("player", "total"))


@query
def standings_maps(spark, sf):
    feed = _stored(spark, sf)
    maps = dash.standings_map(rank.standings(_season_outcomes(feed), _seeds(feed)))
    rows = maps.select("season_id", F.explode("team_standings").alias("key", "s"))
    return rows.select("season_id", "key", "s.*")


@query
def dashboard(spark, sf):
    return dash.dashboard(_dashboard_tables(spark, sf))


@query
def dashboard_summary(spark, sf):
    """One flat row per season: the document, and the tables that grow with the season."""
    t = _dashboard_tables(spark, sf)
    totals = t.points.groupBy("season_id").agg(
        F.count("*").alias("n_players"), F.sum("total").alias("n_points")
    )
    live = t.live.groupBy("season_id").agg(F.count("*").alias("n_live"))
    zero = F.lit(0).cast("bigint")
    document = dash.dashboard(t).join(totals, "season_id", "left").join(live, "season_id", "left")
    return document.select(
        "season_id",
        "season.current_round",
        "season.season_ended",
        F.size("ranking").cast("bigint").alias("teams"),
        F.get("ranking", F.lit(0))["team"].alias("first_team"),
        F.get("leaders_points", F.lit(0))["player"].alias("first_player"),
        F.size("leaders_assists").cast("bigint").alias("assist_leaders"),
        F.get("hot_streaks", F.lit(0))["player"].alias("hottest_player"),
        F.coalesce("n_live", zero).alias("live"),
        F.coalesce("n_players", zero).alias("players"),
        F.coalesce("n_points", zero).alias("points"),
        F.size("team_standings").cast("bigint").alias("standings"),
        F.col("latest_odds.teamA").alias("odds_team"),
        F.size("alerts").cast("bigint").alias("n_alerts"),
        F.get("alerts", F.lit(0)).alias("newest_alert"),
    )


# Player lists


@query
def list_teams(spark, sf):
    return roster.teams(tables.player_list(spark, sf))


@query
def starters(spark, sf):
    return roster.starters(tables.player_list(spark, sf))


@query
def sample_teams(spark, sf):
    return roster.sample_teams(tables.player_list(spark, sf), 6, seed=3)


@query
def round_robin(spark, sf):
    return roster.round_robin(roster.sample_teams(tables.player_list(spark, sf), 6, seed=3))


@query
def round_robin_odd(spark, sf):
    return roster.round_robin(roster.sample_teams(tables.player_list(spark, sf), 7, seed=5))


def _pick_query(mode: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return roster.weighted_pick(tables.player_list(spark, sf), ["Team"], mode, seed=11)

    return run


for _mode in ("equal", "min", "max"):
    register(f"weighted_pick_{_mode}", _pick_query(_mode))


# Streams over the same tables, run to the end of the data


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = tables.table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def _scoring_of(events: DataFrame) -> DataFrame:
    return parse.scoring_plays(parse.plays(parse.parse_feed(tables.plays_feed(events))))


def _in_parts(spark: SparkSession, sf: str, advance: Callable[[DataFrame], None]) -> None:
    """Feed the events to a stream part by part: three by time, a late one, a closing one.

    The late play belongs to a window that is over and must change nothing. The closing one
    comes long after all others, so every window before it ends.
    """
    events = tables.table(spark, sf, "events")
    first, last, top = events.agg(F.min("ts"), F.max("ts"), F.max("event_id")).first()
    third = (last - first) / 3
    # An event of this number is a three-point play, and none of the derived exceptions.
    free = next(n for n in range(top + 7 - top % 7, top + 700, 7) if n % 31 and n % 37 and n % 41)
    extra = events.limit(1).withColumns(
        {"event_id": F.lit(free), "user_id": F.lit(0).cast("bigint"), "event_type": F.lit("purchase")}
    )

    def at(ts) -> DataFrame:
        return extra.withColumn("ts", F.lit(ts).cast("timestamp_ntz")).select(events.columns)

    ts, path = F.col("ts"), new_path(spark, "events")
    parts = [
        events.where(ts < first + third),
        events.where((ts >= first + third) & (ts < first + 2 * third)),
        events.where(ts >= first + 2 * third),
        at(first),
        at(last + timedelta(days=30)),
    ]
    for part in parts:
        part.write.mode("append").parquet(path)
        advance(spark.readStream.schema(events.schema).parquet(path))


def _folder(spark: SparkSession) -> tuple[str, str]:
    base = new_path(spark, "stream")
    return f"{base}/table", f"{base}/checkpoint"


@query
def stream_player_points(spark, sf):
    path, checkpoint = _folder(spark)
    feed = tables.plays_feed(_stream(spark, sf, "events"))
    jobs.player_points(feed, path, checkpoint, available_now=True).awaitTermination()
    return sinks.read_latest(spark, path, ["player"])


@query
def stream_team_stats(spark, sf):
    path, checkpoint = _folder(spark)
    feed = tables.finals_of(_stream(spark, sf, "orders"))
    jobs.team_stats(feed, path, checkpoint, available_now=True).awaitTermination()
    return sinks.read_latest(spark, path, ["team"])


@query
def compacted_player_points(spark, sf):
    """Totals from a changelog of many batches that is compacted after every second one."""
    path, checkpoint = _folder(spark)
    events, parts = tables.table(spark, sf, "events"), new_path(spark, "events")
    events.repartition(7).write.parquet(parts)
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(parts)
    feed = tables.plays_feed(arriving)
    jobs.player_points(feed, path, checkpoint, available_now=True, compact_every=2).awaitTermination()
    return sinks.read_latest(spark, path, ["player"])


def _arriving_feed(spark: SparkSession, sf: str) -> DataFrame:
    """The whole feed as a stream of four parts by time, one part per trigger."""
    feed, path = tables.events_feed(spark, sf), new_path(spark, "feed")
    feed.repartitionByRange(4, "ts").write.parquet(path)
    return spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query
def stream_live_matches(spark, sf):
    """Open matches by game key, kept by a stream from which finals remove theirs."""
    path, checkpoint = _folder(spark)
    feed = _arriving_feed(spark, sf)
    jobs.live_matches(feed, path, checkpoint, available_now=True, compact_every=2).awaitTermination()
    return sinks.read_latest(spark, path, ["game_key"], removed="removed")


@query
def stream_open_odds(spark, sf):
    """Odds of open matches by game key, kept by a stream from which finals remove theirs."""
    path, checkpoint = _folder(spark)
    jobs.open_odds(_arriving_feed(spark, sf), path, checkpoint, available_now=True, compact_every=2).awaitTermination()
    return _rounded(sinks.read_latest(spark, path, ["game_key"], removed="removed"), "oddsA", "oddsB")


@query
def stream_odds(spark, sf):
    path, checkpoint = _folder(spark)
    feed = tables.plays_feed(_stream(spark, sf, "events"))
    jobs.odds(feed, path, checkpoint, available_now=True).awaitTermination()
    return _plain_time(_rounded(spark.read.parquet(path), "oddsA", "oddsB"))


@query
def stream_hot_streaks(spark, sf):
    """Every window's streaks, each when its window closes."""
    path, checkpoint = _folder(spark)

    def advance(events: DataFrame) -> None:
        found = jobs.hot_streak_windows(_scoring_of(events), STREAK_WINDOW)
        sinks.write_stream(found, path, checkpoint, available_now=True).awaitTermination()

    _in_parts(spark, sf, advance)
    return _plain_time(spark.read.parquet(path))


@query
def stream_hot_streak_updates(spark, sf):
    path, checkpoint = _folder(spark)
    found = stateful.hot_streak_updates(_scoring_of(_stream(spark, sf, "events")), STREAK_WINDOW)
    sinks.write_stream(found, path, checkpoint, available_now=True).awaitTermination()
    return _plain_time(spark.read.schema(found.schema).parquet(path))


@query
def stream_simultaneous_streaks(spark, sf):
    """Every alert record is stored by one query and counted by the next."""
    alerts, alerts_checkpoint = _folder(spark)
    path, checkpoint = _folder(spark)

    def advance(events: DataFrame) -> None:
        sent = stateful.hot_streak_updates(_scoring_of(events), STREAK_WINDOW)
        sinks.write_stream(sent, alerts, alerts_checkpoint, available_now=True).awaitTermination()
        stored = sinks.read_table_stream(spark, alerts, sent.schema)
        found = jobs.simultaneous_windows(stored, TOGETHER_WINDOW)
        sinks.write_stream(found, path, checkpoint, available_now=True).awaitTermination()

    _in_parts(spark, sf, advance)
    return _plain_time(spark.read.parquet(path))
