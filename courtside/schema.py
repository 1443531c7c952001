"""Column layout of the feed and the keys every operator agrees on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FEED_SCHEMA = (
    "key STRING, value STRING, topic STRING, `partition` INT, `offset` BIGINT, ts TIMESTAMP"
)

# Total order of the feed. Equal timestamps are ordered by partition, then offset.
ORDER = ["ts", "partition", "offset"]

# A match is one start message and what follows it under the same game key. Game
# keys repeat, so the key alone is no identity.
MATCH = ["season_id", "game_key", "match_seq"]

# Message tags of the feed (fixed values).
SEASON_START = "SEASON_START"
ROUND_START = "RODADA_INICIO"
ROUND_END = "RODADA_FIM"
SEASON_END = "SEASON_END"
START = "INICIO"
PLAY = "EVENTO"
FINAL = "FINAL"
KNOWN_TAGS = [SEASON_START, ROUND_START, ROUND_END, SEASON_END, START, PLAY, FINAL]

# Topic names (fixed values).
GAME_TOPIC = "nba_game"
ODDS_TOPIC = "odds_game"
POINTS_TOPIC = "stats_jogador"
TEAM_TOPIC = "stats_time"
STREAK_TOPIC = "hotstreak_player"
SIMULTANEOUS_TOPIC = "simultaneous_streaks"


def order_key(*extra: Column) -> Column:
    """The feed order as one comparable value."""
    return F.struct(*[F.col(c) for c in ORDER], *extra)
