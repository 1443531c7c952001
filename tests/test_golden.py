"""The hand-made feed against hand-computed results."""

import pytest
from conftest import GOLDEN, make_feed, play, rows, start
from pyspark.sql import functions as F

from courtside.operators import boxscore, latest, lineups, parse, segments, stats, streaks
from courtside.plans import dashboard as dash
from courtside.plans import ranking as rank
from courtside.plans.catalog import team_catalog
from courtside.schema import MATCH


@pytest.fixture(scope="module")
def feed(golden):
    return segments.segment(parse.parse_feed(golden)).cache()


@pytest.fixture(scope="module")
def t(spark, feed):
    return dash.tables(spark, feed)


def test_odds(feed):
    got = [
        (r["offset"], round(r["oddsA"], 6), round(r["oddsB"], 6))
        for r in stats.odds(parse.plays(feed)).orderBy("offset").collect()
    ]
    assert got == [
        (3, 2.0, 2.0),
        (4, 1.951229, 2.051271),
        (5, 2.025315, 1.97531),
        (6, 1.951229, 2.051271),
        (7, 1.904837, 2.105171),
        (8, 1.904837, 2.105171),
    ]


def test_player_points(feed):
    scoring = parse.scoring_plays(parse.plays(feed))
    assert rows(stats.player_points(scoring)) == [("A1", 5), ("B1", 3)]


def test_team_stats(feed):
    got = rows(stats.team_stats(stats.match_outcomes(parse.match_ends(feed))))
    assert got == [("BRK", 0, 1, 3, 5), ("IND", 1, 0, 5, 3)]


def test_hot_streaks(feed):
    scoring = parse.scoring_plays(parse.plays(feed))
    assert rows(streaks.hot_streaks(scoring), "player", "points") == [("A1", 5), ("B1", 3)]
    updates = streaks.alerts(streaks.hot_streaks(scoring, emit="updates"))
    assert rows(updates, "player", "points", F.second("alert_ts")) == [("A1", 5, 13), ("B1", 3, 12)]
    together = streaks.simultaneous_streaks(updates)
    assert rows(together, F.second("window_start"), "streaks") == [(12, 2)]
    assert rows(streaks.simultaneous_streaks(updates, emit="updates"), "streaks") == [(2,)]


def test_ranking(t):
    got = rows(t.ranking, "rank", "team", "team_name", "points", "wins", "losses")
    assert got == [
        (1, "IND", "Indiana Pacers", 3, 1, 0),
        (2, "BRK", "Brooklyn Nets", 0, 0, 1),
        (3, "CHO", "CHO", 0, 0, 0),
        (4, "LAL", "Los Angeles Lakers", 0, 0, 0),
    ]


def test_matchup(t):
    row = t.ranking.where("team = 'IND'").first()
    assert (row["team_score"], row["opponent"], row["opponent_score"], row["live"]) == (5, "BRK", 3, False)
    assert round(row["team_odds"], 6) == 1.904837 and round(row["opponent_odds"], 6) == 2.105171


def test_leaders(t, feed):
    assert rows(t.leaders.drop("season_id")) == [
        (1, "A1", "IND", 5, 1, 5.0),
        (2, "B1", "BRK", 3, 1, 3.0),
    ]
    played, started = parse.plays(feed), parse.rosters(feed)
    totals = rank.player_totals(
        t.points, stats.games_played(started, parse.match_ends(feed)), latest.player_context(started, played)
    )
    assert rows(rank.player_leaders(totals, as_coded=True), "rank", "player") == [(1, "B1"), (2, "A1")]
    assert rank.player_leaders(totals, category="ASSISTS").count() == 0


def test_games_played(feed):
    got = stats.games_played(parse.rosters(feed), parse.match_ends(feed))
    assert rows(got, "player", "games") == [(p, 1) for p in ("A1", "A2", "A3", "B1", "B2", "B3")]


def test_box_score_and_report(feed):
    played = parse.plays(feed)
    box = stats.box_score(played)
    assert rows(box, "team", "player", "points", "fouls") == [
        ("BRK", "B1", 3, 0), ("BRK", "B2", 0, 1), ("IND", "A1", 5, 0),
    ]
    assert rows(stats.turnovers(played), "turnovers") == [(1,)]
    lineup = lineups.lineups(parse.start_teams(feed), played)
    ind = rows(lineup.where("team = 'IND'"), "slot", "pos", "player")
    assert ind == [("reserve", 0, "A2"), ("starter", 0, "A1"), ("starter", 1, "A3")]
    report = boxscore.match_report(box, lineup).where("team = 'IND'").orderBy("line")
    assert [r["player"] for r in report.collect()] == ["A1", "A3", "A2"]
    assert rows(boxscore.top_scorers(box), "team", "rank", "player") == [("BRK", 1, "B1"), ("IND", 1, "A1")]


def test_season_info_and_live(spark, t, feed):
    assert rows(t.info) == [(1, "2025/2026", 1, True)]
    assert t.live.count() == 0
    before_final = segments.segment(parse.parse_feed(make_feed(spark, GOLDEN[:9])))
    got = rows(latest.live_matches(before_final), "home", "home_score", "away_score", "away", "quarter")
    assert got == [("IND", 5, 3, "BRK", 2)]


def test_hot_board_and_log(t):
    assert rows(t.hot.drop("season_id")) == [(1, "A1", "IND", 1, 5), (2, "B1", "BRK", 1, 3)]
    log = [r["message"] for r in t.log.orderBy("position").collect()]
    assert log == [
        "2 jogadores em hot streak simultânea",
        "O A1 está pegando fogo! Fez 5 pontos em sequência!",
        "O B1 está pegando fogo! Fez 3 pontos em sequência!",
    ]


def test_dashboard_document(t):
    doc = dash.dashboard(t).collect()
    assert len(doc) == 1
    doc = doc[0].asDict(recursive=True)
    assert doc["season"] == {"label": "2025/2026", "current_round": 1, "season_ended": True}
    assert [r["team"] for r in doc["ranking"]] == ["IND", "BRK", "CHO", "LAL"]
    assert rows(t.points, "player", "total") == [("A1", 5), ("B1", 3)]
    assert doc["leaders_assists"] == [] and t.live.count() == 0
    assert len(doc["alerts"]) == 3 and doc["latest_odds"]["teamA"] == "IND"


@pytest.mark.parametrize("entries", [1, 5, 10_000])
def test_maps_hold_every_player_whatever_their_size(t, entries):
    maps = dash.snapshot_maps(t.points, entries).collect()
    assert sorted(p for row in maps for p in row["player_points"].items()) == [("A1", 5), ("B1", 3)]


def test_quarter_of_the_match_that_was_live_at_the_alert(spark):
    """A play without a quarter takes that of its match then, also when the match is over by now."""
    messages = [
        (None, 0, {"tipo": "SEASON_START", "times": ["IND", "BRK"]}),
        ("Game_1", 1, start("IND", "BRK", IND=(["A1"], []), BRK=(["B1"], []))),
        ("Game_1", 2, play("IND", 3, "IND 0 X 0 BRK", acao="FOUL", jogador_commit="B1", jogador_receive="A1")),
        ("Game_1", 3, play("IND", None, "IND 0 X 0 BRK", acao="POINT", jogador="A1", valor=3)),
        ("Game_1", 4, {"tipo": "FINAL", "match": "IND 3 X 0 BRK"}),
        ("Game_2", 5, start("IND", "BRK", IND=(["A1"], []), BRK=(["B1"], []))),
        ("Game_2", 6, play("IND", 4, "IND 0 X 0 BRK", acao="TURNOVER", jogador="B1")),
    ]
    feed = segments.segment(parse.parse_feed(make_feed(spark, messages)))
    played = parse.plays(feed)
    sent = streaks.alerts(streaks.hot_streaks(parse.scoring_plays(played), emit="updates"))
    found = streaks.enrich_alerts(sent, parse.rosters(feed), played, feed)
    assert rows(found, "player", "team", "quarter", "points") == [("A1", "IND", 3, 3)]


def test_match_board(feed):
    board = dash.match_tables(feed)["board"]
    assert rows(board, *MATCH[1:], "home", "home_score", "away_score", "away", "quarter", "ended", "turnovers") == [
        ("Game_101", 1, "IND", 5, 3, "BRK", 2, True, 1)
    ]


def test_catalog_can_be_extended(spark):
    names = dict(rows(team_catalog(spark, {"CHO": "Charlotte Hornets"})))
    assert names["CHO"] == "Charlotte Hornets" and len(names) == 31
