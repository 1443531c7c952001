import pytest
from conftest import make_feed, play, rows, start
from pyspark.sql import functions as F

from courtside.functions import text
from courtside.functions.scoreboard import scoreboard, title_teams
from courtside.operators import latest, parse, segments, stats


def test_fields_and_defaults(spark):
    feed = make_feed(
        spark,
        [
            ("g", 1, play("IND", "3", "IND 1 X 2 BRK", acao="POINT", jogador="A", valor="3")),
            ("", 2, play("IND", 2.7, "", acao="POINT", jogador="B", valor=2.7)),
            (None, 3, {"tipo": "EVENTO", "detalhes": {"ação": "POINT"}}),
            ("g", 4, {"tipo": "EVENTO"}),
            ("g", 5, play("IND", 9e12, "x", acao="DANCE", jogador="C")),
            ("g", 6, play("IND", 1, "x", acao="FOUL", jogador_commit=None)),
        ],
    )
    got = rows(parse.plays(parse.parse_feed(feed)), "offset", "game_key", "quarter", "team", "action", "player", "player2", "points")
    assert got == [
        (0, "g", 3, "IND", "POINT", "A", None, 3),
        (1, "unknown", 2, "IND", "POINT", "B", None, 2),
        (2, "unknown", -1, "", "POINT", "", None, 0),
        (3, "g", -1, "", "UNKNOWN", None, None, None),
        (4, "g", -1, "IND", "UNKNOWN", None, None, None),
        (5, "g", 1, "IND", "FOUL", "", "", None),
    ]


def test_unreadable_records_are_set_aside(spark):
    feed = make_feed(
        spark,
        [
            ("g", 1, None),
            ("g", 2, "  "),
            ("g", 3, "{broken"),
            ("g", 4, '[{"tipo":"EVENTO"}]'),
            ("g", 5, '{"tipo":"PAUSA"}'),
            ("g", 6, "{'tipo':'EVENTO'}"),
            ("g", 7, {"a": 1}),
            ("g", 8, {"tipo": "FINAL", "match": "A 1 X 2 B"}),
        ],
    )
    assert [r["offset"] for r in parse.parse_feed(feed).collect()] == [7]
    assert rows(parse.quarantine(feed), "offset", "reason") == [
        (0, "empty"), (1, "empty"), (2, "malformed"), (3, "not an object"),
        (4, "unknown kind"), (5, "malformed"), (6, "unknown kind"),
    ]


def test_rosters_keep_text_items_only(spark):
    message = start("LA Lakers", "BOS", **{"LA Lakers": (["Luka Dončić", 5, None], []), "BOS": ("x", ["J"])})
    message["extra"] = 3
    got = rows(parse.rosters(parse.parse_feed(make_feed(spark, [("g", 1, message)]))), "team_pos", "team", "slot", "pos", "player")
    assert got == [(0, "LA Lakers", "starter", 0, "Luka Dončić"), (1, "BOS", "reserve", 0, "J")]


def test_control_trims_and_keeps_round(spark):
    feed = make_feed(
        spark,
        [
            (None, 1, {"tipo": "SEASON_START", "times": [" A ", "", "B", None]}),
            (None, 2, {"tipo": "RODADA_INICIO", "rodada": "2"}),
            (None, 3, {"tipo": "RODADA_INICIO"}),
            (None, 4, {"tipo": "SEASON_START", "times": []}),
        ],
    )
    parsed = segments.with_season(parse.parse_feed(feed))
    assert rows(parse.control(parsed).where("tipo = 'SEASON_START'"), "teams") == [(["A", "B"],), ([],)]
    assert rows(latest.season_info(parsed)) == [(1, "2025/2026", 2, False)]


LINES = [
    ("IND 103 X 101 BRK", ("IND", 103, 101, "BRK"), ("IND", 103, 101, "BRK"), ("IND", 103, 101, "BRK")),
    ("LA Lakers 10 X 8 BOS", ("LA Lakers", 10, 8, "BOS"), None, ("LA", None, None, "BOS")),
    ("IND x X 3 BRK", None, None, ("IND", None, None, "BRK")),
    ("IND 5 BRK", None, None, (None, None, None, None)),
    ("", None, None, (None, None, None, None)),
    (None, None, None, (None, None, None, None)),
    ("IND 5 X 3", None, None, (None, None, None, None)),
    (" IND 5 X 3 BRK ", ("IND", 5, 3, "BRK"), ("IND", 5, 3, "BRK"), ("", None, None, "BRK")),
    ("IND  5 X 3 BRK", ("IND", 5, 3, "BRK"), ("IND", 5, 3, "BRK"), ("IND", None, None, "BRK")),
    ("A 1 X 2 B X ", ("A", 1, 2, "B X"), ("A", 1, 2, "B"), ("A", 1, 2, "B")),
    ("A 1 X 2 B X 3", ("A", 1, 2, "B X 3"), None, ("A", 1, 2, "B")),
    ("A 99999999999 X 2 B", None, None, ("A", None, None, "B")),
    ("A -1 X +2 B c", ("A", -1, 2, "B c"), ("A", -1, 2, "B"), ("A", -1, 2, "B")),
]


@pytest.mark.parametrize("form,at", [("wide", 1), ("strict", 2), ("odds", 3)])
def test_score_lines(spark, form, at):
    df = spark.createDataFrame([(i, l[0]) for i, l in enumerate(LINES)], "i INT, line STRING")
    got = {r["i"]: r["s"] and tuple(r["s"]) for r in df.select("i", scoreboard("line", form).alias("s")).collect()}
    assert got == {i: l[at] for i, l in enumerate(LINES)}


def test_dashboard_score_line(spark):
    df = spark.createDataFrame(
        [("IND X BRK", True), ("IND X BRK", False), ("IND 1 X 2 BRK", True), ("LA L X BRK", True), ("", True)],
        "line STRING, title BOOLEAN",
    )
    got = [tuple(r["s"]) for r in df.select(scoreboard("line", "dashboard", F.col("title")).alias("s")).collect()]
    blank = ("", 0, 0, "")
    assert got == [("IND", 0, 0, "BRK"), blank, ("IND", 1, 2, "BRK"), blank, blank]


def test_titles(spark):
    df = spark.createDataFrame([("A X B X C",), (" X B",), ("A",), ("LA L X B",)], "t STRING")
    got = [r["t"] and tuple(r["t"]) for r in df.select(title_teams("t").alias("t")).collect()]
    assert got == [("A", "B X C"), None, None, ("LA L", "B")]


def test_draw_is_a_loss_for_both(spark):
    feed = make_feed(spark, [("g", 1, {"tipo": "FINAL", "match": "IND 90 X 90 BRK"})])
    got = stats.team_stats(stats.match_outcomes(parse.match_ends(parse.parse_feed(feed))))
    assert rows(got, "team", "win", "lose") == [("BRK", 0, 1), ("IND", 0, 1)]


def test_odds_bounds_and_other_quarters(spark):
    feed = make_feed(
        spark,
        [
            ("g", 1, play("A", 4, "A 60 X 0 B", acao="TURNOVER", jogador="p")),
            ("g", 2, play("A", 4, "A 0 X 60 B", acao="TURNOVER", jogador="p")),
            ("g", 3, play("A", 5, "A 2 X 0 B", acao="TURNOVER", jogador="p")),
            ("g", 4, play("A", 1, "A B", acao="TURNOVER", jogador="p")),
        ],
    )
    got = [
        (r["oddsA"] and round(r["oddsA"], 6), r["oddsB"] and round(r["oddsB"], 6))
        for r in stats.odds(parse.plays(parse.parse_feed(feed))).orderBy("offset").collect()
    ]
    assert got == [(1.06383, 16.666667), (16.666667, 1.06383), (1.904837, 2.105171), (None, None)]


def test_texts(spark):
    df = spark.createDataFrame(
        [("k", "O Ana Lima está pegando fogo! Fez 7 pontos em sequência!"), ("k", "nada")], "p STRING, m STRING"
    )
    assert [tuple(r["a"]) for r in df.select(text.parse_alert("p", "m").alias("a")).collect()] == [("Ana Lima", 7), ("k", 0)]
    one = spark.range(1)
    assert one.select(
        text.truncate(F.lit("abcdefgh"), 6),
        text.quarter_label(F.lit(0)),
        text.quarter_label(F.lit(2)),
        text.odds_label(F.lit(1.956)),
        text.odds_label(F.lit(None).cast("double")),
        text.average_label(F.lit(0), F.lit(1.0)),
        text.rounded_average(F.lit(25), F.lit(4)),
        text.decode_int(text.encode_int(F.lit(258))),
        F.hex(text.encode_int(F.lit(258), 8)),
    ).first()[:] == ("abc...", "Ao vivo", "2º Q", "1.96", "", "—", 6.3, 258, "0000000000000102")
