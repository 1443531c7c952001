from __future__ import annotations

import json
import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from courtside.schema import FEED_SCHEMA  # noqa: E402
from courtside.sources.store import drop_stored  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("TEST_SHARED_DIR", "/tmp/courtside-shared"))
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_stored(session)


def play(team, quarter, line, **details):
    details = {("ação" if k == "acao" else k): v for k, v in details.items()}
    return {"tipo": "EVENTO", "time": team, "quarto": quarter, "placar": line, "detalhes": details}


def start(home, away, **teams):
    message = {"tipo": "INICIO", "match": f"{home} X {away}"}
    for name, (first, rest) in teams.items():
        message[name] = {"titulares": first, "reservas": rest}
    return message


GOLDEN = [
    (None, 0, {"tipo": "SEASON_START", "times": ["IND", "BRK", "CHO", "LAL"]}),
    (None, 1, {"tipo": "RODADA_INICIO", "rodada": 1}),
    ("Game_101", 10, start("IND", "BRK", IND=(["A1", "A2"], ["A3"]), BRK=(["B1", "B2"], ["B3"]))),
    ("Game_101", 11, play("IND", 1, "IND 0 X 0 BRK", acao="POINT", jogador="A1", valor=2)),
    ("Game_101", 12, play("BRK", 1, "IND 2 X 0 BRK", acao="POINT", jogador="B1", valor=3)),
    ("Game_101", 13, play("IND", 1, "IND 2 X 3 BRK", acao="POINT", jogador="A1", valor=3)),
    ("Game_101", 14, play("BRK", 1, "IND 5 X 3 BRK", acao="FOUL", jogador_commit="B2", jogador_receive="A2")),
    ("Game_101", 16, play("IND", 2, "IND 5 X 3 BRK", acao="SUBSTITUTION", jogador_out="A2", jogador_in="A3")),
    ("Game_101", 17, play("IND", 2, "IND 5 X 3 BRK", acao="TURNOVER", jogador="A3")),
    ("Game_101", 20, {"tipo": "FINAL", "match": "IND 5 X 3 BRK"}),
    (None, 21, {"tipo": "RODADA_FIM", "rodada": 1}),
    (None, 22, {"tipo": "SEASON_END"}),
]


def make_feed(spark, messages, topic="nba_game"):
    """Messages as ``(key, seconds past midnight, message or raw text)`` in one partition."""
    rows = [
        (k, m if m is None or isinstance(m, str) else json.dumps(m, ensure_ascii=False), topic, 0, i, float(s))
        for i, (k, s, m) in enumerate(messages)
    ]
    schema = FEED_SCHEMA.replace("ts TIMESTAMP", "s DOUBLE")
    midnight = F.unix_timestamp(F.lit("2026-01-01 00:00:00"))
    return spark.createDataFrame(rows, schema).select(
        "key", "value", "topic", "partition", "offset",
        F.timestamp_micros(((midnight + F.col("s")) * 1_000_000).cast("bigint")).alias("ts"),
    )


@pytest.fixture(scope="session")
def golden(spark):
    return make_feed(spark, GOLDEN)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)
