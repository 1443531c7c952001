"""Operators that depend on feed order, against brute force; a third of the rows is one key."""

import random

from conftest import make_feed, play, rows, start
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.operators import latest, lineups, parse, segments, stats, streaks
from courtside.operators.ordered import running, seconds
from courtside.schema import ORDER


def skewed(spark, n=900, span=4000, seed=1):
    rng = random.Random(seed)
    data = [
        ("hot" if rng.random() < 0.34 else f"k{rng.randrange(9)}", rng.randrange(span) / 4, i, rng.randrange(3), rng.choice(["a", "b", None]))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "k STRING, s DOUBLE, `offset` BIGINT, v INT, t STRING").select(
        "k", F.timestamp_micros((F.col("s") * 1e6).cast("bigint")).alias("ts"), F.lit(0).alias("partition"), "offset", "v", "t"
    )


def test_running_equals_one_window(spark):
    df = skewed(spark)
    for by in (["k"], []):
        w = Window.partitionBy(*by).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
        want = df.select("offset", F.sum("v").over(w), F.last("t", ignorenulls=True).over(w))
        for bucket in (1, 60, 100_000):
            got = running(df, by, ORDER, {"total": F.col("v")}, {"seen": F.col("t")}, bucket)
            assert rows(got, "offset", "total", "seen") == rows(want)


def test_durations():
    assert seconds("5 seconds") == 5 and seconds("6 hours") == 21600 and seconds("1 day") == 86400


def test_repeated_keys_seasons_and_stray_finals(spark):
    final = {"tipo": "FINAL", "match": "A 1 X 0 B"}
    kick = start("A", "B", A=(["p"], []), B=(["q"], []))
    season = {"tipo": "SEASON_START", "times": ["A", "B"]}
    feed = make_feed(
        spark,
        [
            ("g", 1, final),
            (None, 2, season),
            ("g", 3, kick),
            ("g", 4, final),
            ("g", 5, kick),
            ("h", 6, final),
            (None, 7, {"tipo": "SEASON_START", "times": [" "]}),
            ("g", 8, kick),
            (None, 9, season),
            ("g", 10, final),
            ("g", 10, final),
        ],
    )
    parsed = parse.parse_feed(feed)
    for length in (2, 86_400):
        got = segments.with_match(segments.with_season(parsed, length), length)
        by_offset = {r["offset"]: (r["season_id"], r["match_seq"]) for r in got.collect()}
        assert by_offset == {
            0: (0, 0), 1: (1, 0), 2: (1, 1), 3: (1, 1), 4: (1, 2), 5: (1, 0),
            6: (1, 0), 7: (1, 3), 8: (2, 0), 9: (2, 3), 10: (2, 3),
        }
    # Only the match at offset 3 ended in its own season with a roster.
    assert rows(stats.games_played(parse.rosters(got), parse.match_ends(got))) == [(1, "p", 1), (1, "q", 1)]
    assert rows(segments.season_markers(parsed), "season_id", F.size("teams")) == [(1, 2), (2, 2)]
    # The newest match of a key is live until its final; the older open one is not.
    assert rows(latest.live_matches(got), "season_id", "game_key", "match_seq") == [(1, "g", 3)]


def simulate(first, rest, swaps):
    first, rest = list(first), list(rest)
    for out, come in swaps:
        for a, b in ((first, rest), (rest, first)):
            if out != come and out in a and come in b:
                i, j = a.index(out), b.index(come)
                a[i], b[j] = b[j], a[i]
                break
    return [("starter", i, p) for i, p in enumerate(first)] + [("reserve", i, p) for i, p in enumerate(rest)]


def test_lineups_equal_replay(spark):
    rng = random.Random(5)
    first, rest = [f"s{i}" for i in range(5)], [f"r{i}" for i in range(4)]
    names = [*first, *rest, "stranger"]
    swaps = [(rng.choice(names), rng.choice(names)) for _ in range(120)]
    messages = [("g", 0, start("A", "B", A=(first, rest), B=(first[:2], [])))]
    messages += [
        ("g", 1 + i, play("A", 1, "A 0 X 0 B", acao="SUBSTITUTION", jogador_out=o, jogador_in=n))
        for i, (o, n) in enumerate(swaps)
    ]
    feed = segments.segment(parse.parse_feed(make_feed(spark, messages)))
    want = sorted(simulate(first, rest, swaps), key=repr)
    for bucket in (1, 7, 1000):
        got = lineups.lineups(parse.start_teams(feed), parse.plays(feed), bucket)
        assert rows(got.where("team = 'A'"), "slot", "pos", "player") == want
        assert rows(got.where("team = 'B'"), "slot", "pos", "player") == [("starter", 0, "s0"), ("starter", 1, "s1")]


def test_streak_updates_equal_across_window_forms(spark):
    scoring = skewed(spark).select(*ORDER, F.col("k").alias("player"), F.col("v").alias("points"))
    w = Window.partitionBy("player", F.window("ts", "20 minutes")).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    want = scoring.withColumn("total", F.sum("points").over(w)).where("total > 2").select("offset", "total")
    got = streaks.hot_streaks(scoring, "20 minutes", emit="updates")
    assert rows(got, "offset", "points") == rows(want)


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(3)
    spans = []
    for i in range(60):
        a = rng.randrange(300)
        spans.append((f"p{i}", a, a + rng.randrange(25)))
    df = spark.createDataFrame(spans, "player STRING, a INT, b INT").select(
        "player", F.timestamp_seconds("a").alias("first_ts"), F.timestamp_seconds("b").alias("alert_ts")
    )
    # Half-second steps tell touching periods from periods with a gap between them.
    crowd = [sum(a <= t / 2 <= b for _, a, b in spans) for t in range(800)]
    want, begin = [], None
    for t, n in enumerate(crowd):
        if n > 2 and begin is None:
            begin = t
        if n <= 2 and begin is not None:
            want.append((begin // 2, (t - 1) // 2, max(crowd[begin:t])))
            begin = None
    got = streaks.streak_overlaps(df).select(
        F.unix_seconds("start_ts").alias("a"), F.unix_seconds("end_ts"), "max_players"
    )
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and len(want) > 2


def test_alert_context_is_as_of_the_alert(spark):
    messages = [
        (None, 0, {"tipo": "SEASON_START", "times": ["A", "B"]}),
        ("g", 1, start("A", "B", A=(["p"], []), B=(["q"], []))),
        ("g", 2, play("A", 2, "A 0 X 0 B", acao="POINT", jogador="p", valor=3)),
        ("g", 3, play("B", 3, "A 3 X 0 B", acao="TURNOVER", jogador="p")),
        ("g", 20, {**play("A", 4, "A 3 X 0 B", acao="POINT", jogador="p", valor=3), "quarto": None}),
        ("g", 40, play("B", 4, "A 6 X 0 B", acao="FOUL", jogador_commit="q", jogador_receive="p")),
    ]
    feed = segments.segment(parse.parse_feed(make_feed(spark, messages)))
    played = parse.plays(feed)
    sent = streaks.alerts(streaks.hot_streaks(parse.scoring_plays(played), emit="updates"))
    got = streaks.enrich_alerts(sent, parse.rosters(feed), played, feed)
    # The second alert has no quarter of its own and takes the live match's as it was then.
    assert rows(got, "offset", "player", "team", "quarter") == [(2, "p", "A", 2), (4, "p", "A", 3)]


def test_plays_that_come_after_the_clock_has_closed_their_window_are_late(spark):
    import random

    from courtside.operators import streaks

    rng = random.Random(5)
    plays = [(rng.choice(["a", "b", None]), 2, rng.randrange(3), n, n // 3 + rng.randrange(-30, 30)) for n in range(300)]
    clock, want = {}, []
    for player, _, partition, offset, second in plays:
        if player is not None:
            clock[partition] = max(clock.get(partition, second), second)
            if (second // 5 + 1) * 5 > clock[partition]:
                want.append(offset)
    schema = "player string, points int, `partition` int, `offset` bigint, s int"
    df = spark.createDataFrame(plays, schema).selectExpr("* except (s)", "timestamp_seconds(1700000000 + s) AS ts")
    for block in (7, 100_000):
        kept = streaks.in_stream_time(df, "5 seconds", block=block)
        assert kept.columns == df.columns
        assert sorted(r["offset"] for r in kept.collect()) == want
    assert 0 < len(want) < 150
