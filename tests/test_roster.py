import itertools

from conftest import rows
from pyspark.sql import functions as F

from courtside.operators import roster
from courtside.sources.players import read_players

CSV = """,Player,Age,Team,Pos,Rank,FG,P3
0,Órfhlaith Žůrek,31,LAL,PG,10,0.5,0.25
1,"Ada ""Ace"" Zimmer",22,DEN,C,10,0.75,
2,A,20,LAL,C,1,0.1,0.2
3,B,20,DEN,C,4,0.1,0.2
"""


def test_player_csv(spark, tmp_path):
    path = tmp_path / "players.csv"
    path.write_text(CSV, encoding="utf-8")
    df = read_players(spark, str(path))
    assert df.columns == ["Player", "Age", "Team", "Pos", "Rank", "FG", "P3"]
    first = df.where("Rank = 10").orderBy("Player").collect()
    assert [r["Player"] for r in first] == ['Ada "Ace" Zimmer', "Órfhlaith Žůrek"]
    assert first[0]["P3"] is None and first[1]["FG"] == 0.5
    listed = read_players(spark, str(path), keep_index=True)
    assert rows(roster.starters(listed, 1), "Player", "slot")[0] == ("A", "reserve")
    older = tmp_path / "older.csv"
    older.write_text("Unnamed: 0,Player,Age,Team,Pos,Rank\n0,X,1,LAL,C,3\n", encoding="utf-8")
    assert rows(read_players(spark, str(older)), "Player", "Rank", "FG") == [("X", 3, None)]


def test_round_robin_meets_every_pair_once(spark):
    for n in (2, 5, 6, 9):
        teams = spark.range(n).select(F.col("id").cast("int").alias("idx"), F.concat(F.lit("t"), "id").alias("team"))
        games = roster.round_robin(teams).collect()
        pairs = sorted(tuple(sorted((g["home"], g["away"]))) for g in games)
        assert pairs == sorted(itertools.combinations(sorted(f"t{i}" for i in range(n)), 2))
        for _, group in itertools.groupby(sorted(games, key=lambda g: g["round"]), key=lambda g: g["round"]):
            playing = [t for g in group for t in (g["home"], g["away"])]
            assert len(playing) == len(set(playing)) == n - n % 2
    # First round: first against last, second against last but one.
    four = spark.range(4).select(F.col("id").cast("int").alias("idx"), F.col("id").cast("string").alias("team"))
    assert rows(roster.round_robin(four).where("round = 1"), "slot", "home", "away") == [(0, "0", "3"), (1, "1", "2")]
    assert rows(roster.round_robin(four).where("round = 2"), "slot", "home", "away") == [(0, "0", "2"), (1, "3", "1")]


def test_weighted_pick_follows_the_weights(spark):
    players = spark.range(4000).select(
        F.floor(F.col("id") / 2).cast("string").alias("Team"),
        F.col("id").cast("string").alias("Player"),
        F.when(F.col("id") % 2 == 0, 9).otherwise(1).alias("Rank"),
    )
    share = {}
    for mode in ("equal", "max", "min"):
        picked = roster.weighted_pick(players, ["Team"], mode, seed=1)
        assert picked.count() == 2000
        share[mode] = picked.where("Rank = 9").count() / 2000
    assert abs(share["equal"] - 0.5) < 0.05
    assert abs(share["max"] - 0.9) < 0.04
    assert abs(share["min"] - 2 / 12) < 0.04


def test_sample_is_reproducible(spark):
    players = spark.range(300).select((F.col("id") % 30).cast("string").alias("Team"))
    first = rows(roster.sample_teams(players, 6, seed=2))
    assert first == rows(roster.sample_teams(players.repartition(7), 6, seed=2))
    assert len(first) == 6 and first != rows(roster.sample_teams(players, 6, seed=3))
