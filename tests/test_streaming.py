import pytest
from conftest import GOLDEN, make_feed, play, rows
from pyspark.sql import functions as F

from courtside.functions.text import decode_int
from courtside.operators import parse, segments, stats, streaks
from courtside.plans import dashboard as dash
from courtside.schema import FEED_SCHEMA
from courtside.sources.feed import KafkaSource, read_feed, route, text_values
from courtside.sources.store import read_parsed, shared_folder, stored_once, write_parsed
from courtside.streaming import jobs, sinks, stateful


@pytest.fixture
def stored(spark, golden, tmp_path):
    """The golden feed as three files, in feed order."""
    path = str(tmp_path / "feed")
    for part in range(3):
        chunk = golden.where(F.floor(F.col("offset") / 5) == part)
        chunk.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path, files=None):
    return read_feed(spark, path, streaming=True, max_files_per_trigger=files)


def test_latest_tables_equal_batch(spark, golden, stored, tmp_path):
    parsed = parse.parse_feed(golden)
    points, teams = str(tmp_path / "p"), str(tmp_path / "t")
    jobs.player_points(stream(spark, stored, 1), points, f"{points}.c", available_now=True).awaitTermination()
    jobs.team_stats(stream(spark, stored, 1), teams, f"{teams}.c", available_now=True).awaitTermination()
    assert rows(sinks.read_latest(spark, points, ["player"])) == rows(
        stats.player_points(parse.scoring_plays(parse.plays(parsed)))
    )
    assert rows(sinks.read_latest(spark, teams, ["team"])) == rows(
        stats.team_stats(stats.match_outcomes(parse.match_ends(parsed)))
    )
    # A1 changed in two batches; both changes are kept, the newer one is read.
    assert spark.read.parquet(points).where("player = 'A1'").count() == 2


def test_a_finished_job_adds_nothing_when_started_again(spark, stored, tmp_path):
    path = str(tmp_path / "o")
    for _ in range(2):
        jobs.odds(stream(spark, stored), path, f"{path}.c", available_now=True).awaitTermination()
    assert spark.read.parquet(path).count() == 6


def scoring_feed(spark, path, plays):
    for i, batch in enumerate(plays):
        messages = [
            (f"g{i}", s, play("A", 1, "A 0 X 0 B", acao="POINT", jogador=p, valor=v)) for p, s, v in batch
        ]
        make_feed(spark, messages).coalesce(1).write.mode("append").parquet(path)


def test_streak_updates_and_late_plays(spark, tmp_path):
    sinks.configure_state(spark)
    path = str(tmp_path / "f")
    scoring_feed(spark, path, [[("a", 1, 2), ("a", 2, 2)], [("b", 7, 3), ("a", 4, 2)], [("a", 3, 3), ("c", 21, 3)]])
    scoring = parse.scoring_plays(parse.plays(parse.parse_feed(stream(spark, path, 1))))
    out = str(tmp_path / "o")
    sinks.write_stream(stateful.hot_streak_updates(scoring), out, f"{out}.c", available_now=True).awaitTermination()
    got = rows(spark.read.parquet(out), "player", F.second("alert_ts").alias("s"), "points")
    # Window 0-5 was open in the second batch (time had reached 2), over in the third (7).
    assert got == [("a", 2, 4), ("a", 4, 6), ("b", 7, 3), ("c", 21, 3)]


def test_players_of_a_window_share_state(spark, tmp_path):
    """A window costs a bounded number of states, not one per player."""
    path, out = str(tmp_path / "f"), str(tmp_path / "o")
    scoring_feed(spark, path, [[(f"p{n}", 1 + n / 100, 2) for n in range(200)] * 2])
    scoring = parse.scoring_plays(parse.plays(parse.parse_feed(stream(spark, path, 1))))
    found = stateful.hot_streak_updates(scoring, parts=4)
    job = sinks.write_stream(found, out, f"{out}.c", available_now=True)
    job.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in job.recentProgress if p["stateOperators"]) <= 4
    assert rows(spark.read.parquet(out), "player", "points") == sorted((f"p{n}", 4) for n in range(200))


def test_exact_and_chained_simultaneous_streaks(spark, tmp_path):
    path = str(tmp_path / "f")
    scoring_feed(spark, path, [[("a", 1, 3), ("b", 1.5, 3), ("c", 4, 3)], [("z", 60, 1)]])
    scoring = parse.scoring_plays(parse.plays(parse.parse_feed(stream(spark, path, 1))))
    found = jobs.hot_streak_windows(scoring, "5 seconds")
    one, two, three = (str(tmp_path / n) for n in "123")
    sinks.write_stream(found, one, f"{one}.c", available_now=True).awaitTermination()
    assert rows(spark.read.parquet(one), "player", "points") == [("a", 3), ("b", 3), ("c", 3)]
    make_alert = spark.read.parquet(one).limit(1).withColumn("alert_ts", F.col("alert_ts") + F.expr("INTERVAL 1 HOUR"))
    make_alert.write.mode("append").parquet(f"{one}.more")
    alerts = spark.read.parquet(one).union(spark.read.parquet(f"{one}.more"))
    alerts.coalesce(1).write.parquet(f"{one}.all")
    source = sinks.read_table_stream(spark, f"{one}.all", found.schema)
    sinks.write_stream(jobs.simultaneous_windows(source, "2 seconds"), two, f"{two}.c", available_now=True).awaitTermination()
    assert rows(spark.read.parquet(two), F.second("window_start"), "streaks") == [(0, 2)]
    scoring = parse.scoring_plays(parse.plays(parse.parse_feed(stream(spark, path, 1))))
    chained = jobs.chained_simultaneous(scoring, "5 seconds", "2 seconds")
    sinks.write_stream(chained, three, f"{three}.c", available_now=True).awaitTermination()
    assert rows(spark.read.parquet(three), F.second("window_start"), "streaks") == [(4, 3)]


def test_live_dashboard_ends_like_the_batch_one(spark, golden, stored, tmp_path):
    out = str(tmp_path / "d")
    jobs.live_dashboard(
        stream(spark, stored, 2), f"{out}.m", out, f"{out}.c", available_now=True, label="x"
    ).awaitTermination()
    last = spark.read.parquet(f"{out}/document").agg(F.max("batch_id")).first()[0]
    assert last == 1
    want = dash.tables(spark, segments.segment(parse.parse_feed(golden)), label="x")
    for name in ("ranking", "leaders", "log", "info"):
        got = spark.read.parquet(f"{out}/{name}").where(F.col("batch_id") == last).drop("batch_id")
        assert rows(got) == rows(getattr(want, name))


def test_topic_records(spark, golden):
    parsed = parse.parse_feed(golden)
    points = sinks.topic_records(stats.player_points(parse.scoring_plays(parse.plays(parsed))), "stats_jogador")
    assert rows(points, "key", decode_int("value")) == [("A1", 5), ("B1", 3)]
    bad = make_feed(spark, [("g", 1, play("A", 1, "A B", acao="TURNOVER", jogador="p"))])
    odds = sinks.topic_records(stats.odds(parse.plays(parse.parse_feed(bad))), "odds_game")
    assert rows(odds) == [("g", '{"teamA":null,"teamB":null,"oddsA":null,"oddsB":null}')]
    updates = streaks.alerts(streaks.hot_streaks(parse.scoring_plays(parse.plays(parsed)), emit="updates"))
    assert rows(sinks.topic_records(updates, "hotstreak_player"), "key") == [("A1",), ("B1",)]
    count = sinks.topic_records(streaks.simultaneous_streaks(updates), "simultaneous_streaks")
    assert rows(count, "key", F.hex("value")) == [("HOTSTREAK", "0000000000000002")]
    with pytest.raises(ValueError):
        sinks.topic_records(updates, "elsewhere")


def test_sources(spark, golden, stored, tmp_path):
    kafka = KafkaSource("h:1", ["nba_game", "odds_game"], "latest", {"failOnDataLoss": "false"})
    assert kafka.reader_options() == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "nba_game,odds_game",
        "startingOffsets": "latest", "failOnDataLoss": "false",
    }
    assert read_feed(spark, stored).schema == spark.createDataFrame([], FEED_SCHEMA).schema
    other = golden.withColumn("topic", F.lit("odds_game")).withColumn("value", F.col("value").cast("binary"))
    both = golden.unionByName(text_values(other))
    assert route(both, "odds_game").count() == len(GOLDEN)
    assert read_feed(spark, stored, topics=["odds_game"]).count() == 0


def test_stored_tables(spark, golden, stored, tmp_path):
    parsed = parse.parse_feed(golden)
    write_parsed(parsed, str(tmp_path / "parsed"))
    again = read_parsed(spark, str(tmp_path / "parsed")).select(*parsed.columns)
    assert rows(again) == rows(parsed)
    built = []

    def build():
        built.append(1)
        return parsed

    source = f"file://{stored}"
    first = stored_once(spark, "t", source, build, ["tipo"])
    assert rows(stored_once(spark, "t", source, build, ["tipo"])) == rows(first) and len(built) == 1
    golden.coalesce(1).write.mode("append").parquet(stored)
    stored_once(spark, "t", source, build, ["tipo"])
    assert len(built) == 2
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir", shared_folder(spark)).rstrip("/")
