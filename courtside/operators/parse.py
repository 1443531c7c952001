"""From feed records to typed messages: one projection per message kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions.text import as_int, decode_json, is_blank
from courtside.schema import FINAL, KNOWN_TAGS, MATCH, PLAY, ROUND_START, SEASON_END, SEASON_START, START

_ACTION_FIELD = "ação"
_MESSAGE = (
    "tipo STRING, `match` STRING, time STRING, quarto STRING, placar STRING, rodada STRING, "
    "times ARRAY<STRING>, "
    f"detalhes STRUCT<`{_ACTION_FIELD}`: STRING, jogador: STRING, valor: STRING, "
    "jogador_commit: STRING, jogador_receive: STRING, jogador_out: STRING, jogador_in: STRING>"
)
_ROSTER = "titulares ARRAY<VARIANT>, reservas ARRAY<VARIANT>"

# Which detail fields hold the acting and the other player (fixed values).
_PLAYERS = {
    "POINT": ("jogador", None),
    "FOUL": ("jogador_commit", "jogador_receive"),
    "TURNOVER": ("jogador", None),
    "SUBSTITUTION": ("jogador_out", "jogador_in"),
}
UNKNOWN_ACTION = "UNKNOWN"
UNKNOWN_GAME = "unknown"


def _identity(df: DataFrame) -> list[str]:
    """Key, order and (once assigned) season and match columns, carried everywhere."""
    known = ["game_key", "ts", "partition", "offset", "season_id", "match_seq"]
    return [c for c in known if c in df.columns]


def _text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def _decoded(feed: DataFrame) -> DataFrame:
    """Every record with its message ``m`` (NULL where it is no object) and ``readable``."""
    # Filters are not pushed below a generator, so every value is decoded once.
    message = F.when(F.col("value").rlike(r"^\s*\{"), decode_json("value", _MESSAGE))
    known = F.col("m.tipo").isin(KNOWN_TAGS) & F.col("ts").isNotNull()
    return feed.select("*", F.explode(F.array(message)).alias("m")).withColumn(
        "readable", F.coalesce(known, F.lit(False))
    )


def parse_feed(feed: DataFrame) -> DataFrame:
    """One row per readable record, with every field any message kind uses.

    Records that are empty, broken JSON, not an object, of no known kind, or without a
    time are left out; :func:`quarantine` returns exactly those.
    """
    parsed = _decoded(feed).where("readable")
    action = F.col(f"m.detalhes.`{_ACTION_FIELD}`")
    player = other = F.lit(None).cast("string")
    for name, (first, second) in _PLAYERS.items():
        player = F.when(action == name, _text(f"m.detalhes.{first}")).otherwise(player)
        if second:
            other = F.when(action == name, _text(f"m.detalhes.{second}")).otherwise(other)
    is_play = F.col("m.tipo") == PLAY
    return parsed.select(
        F.when(is_blank("key"), UNKNOWN_GAME).otherwise(F.col("key")).alias("game_key"),
        "ts",
        "partition",
        "offset",
        F.col("m.tipo").alias("tipo"),
        _text("m.match").alias("match_line"),
        as_int("m.rodada").alias("round"),
        F.when(F.col("m.tipo") == SEASON_START, F.col("m.times")).alias("times"),
        as_int("m.quarto").alias("quarter"),
        _text("m.time").alias("team"),
        _text("m.placar").alias("scoreboard"),
        F.when(
            is_play,
            F.when(action.isin(list(_PLAYERS)), action).otherwise(UNKNOWN_ACTION),
        ).alias("action"),
        F.when(is_play, player).alias("player"),
        F.when(is_play, other).alias("player2"),
        F.when(
            is_play & (action == "POINT"),
            F.coalesce(as_int("m.detalhes.valor"), F.lit(0)),
        ).alias("points"),
        F.when(is_play, F.col("m.detalhes.jogador")).alias("subject"),
        F.when(F.col("m.tipo") == START, F.col("value")).alias("start_value"),
    )


def quarantine(feed: DataFrame) -> DataFrame:
    """The records :func:`parse_feed` leaves out, each with the reason."""
    known = F.coalesce(F.col("m.tipo").isin(KNOWN_TAGS), F.lit(False))
    reason = (
        F.when(known, "no time")
        .when(is_blank("value"), "empty")
        .when(F.try_parse_json("value").isNull(), "malformed")
        .when(~F.col("value").rlike(r"^\s*\{"), "not an object")
        .otherwise("unknown kind")
    )
    left_out = _decoded(feed).where(~F.col("readable"))
    return left_out.select(*feed.columns, reason.alias("reason"))


def plays(parsed: DataFrame) -> DataFrame:
    """Play messages: quarter -1 when missing, action decoded, players by role."""
    return parsed.where(F.col("tipo") == PLAY).select(
        *_identity(parsed),
        F.coalesce("quarter", F.lit(-1)).alias("quarter"),
        "team",
        "scoreboard",
        "action",
        "player",
        "player2",
        "points",
        "subject",
    )


def scoring_plays(plays: DataFrame) -> DataFrame:
    """Scoring plays only, keyed by player."""
    keep = [*_identity(plays), "team", "quarter", "player", "points"]
    return plays.where(F.col("action") == "POINT").select(*keep)


def match_ends(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("tipo") == FINAL).select(
        *_identity(parsed), F.col("match_line").alias("final_scoreboard")
    )


def start_teams(parsed: DataFrame) -> DataFrame:
    """One row per team named in a start message, in message order.

    Teams are field *names* of the message, so it is read as a map first. Only text
    items of the player lists count.
    """
    entries = F.from_json(
        "start_value", "MAP<STRING, STRING>", {"allowSingleQuotes": "false"}
    )
    starts = parsed.where(F.col("tipo") == START).select(
        *_identity(parsed), F.col("match_line").alias("title"), F.map_entries(entries).alias("e")
    )
    fields = F.filter("e", lambda f: ~f["key"].isin("tipo", "match"))
    teams = starts.select(
        *[c for c in starts.columns if c != "e"], F.posexplode(fields).alias("team_pos", "entry")
    )
    lists = F.from_json(F.col("entry.value"), _ROSTER)

    def names(field: str) -> Column:
        texts = F.filter(
            F.coalesce(lists[field], F.array().cast("array<variant>")),
            lambda item: F.schema_of_variant(item) == "STRING",
        )
        return F.transform(texts, lambda item: F.variant_get(item, "$", "string"))

    return teams.select(
        *[c for c in teams.columns if c != "entry"],
        F.col("entry.key").alias("team"),
        names("titulares").alias("starters"),
        names("reservas").alias("reserves"),
    )


def rosters(parsed: DataFrame) -> DataFrame:
    """One row per player of a start message: team, slot and 0-based position in it."""
    teams = start_teams(parsed)
    base = [c for c in teams.columns if c not in ("starters", "reserves")]
    slot = F.explode(
        F.array(
            F.struct(F.lit("starter").alias("slot"), F.col("starters").alias("names")),
            F.struct(F.lit("reserve").alias("slot"), F.col("reserves").alias("names")),
        )
    )
    slots = teams.select(*base, slot.alias("s"))
    return slots.select(
        *base, F.col("s.slot").alias("slot"), F.posexplode("s.names").alias("pos", "player")
    )


def control(parsed: DataFrame) -> DataFrame:
    """Season and round markers; team names trimmed, blank ones dropped."""
    trimmed = F.transform("times", lambda t: F.trim(F.coalesce(t, F.lit(""))))
    return parsed.where(F.col("tipo").isin(SEASON_START, ROUND_START, SEASON_END)).select(
        *_identity(parsed),
        "tipo",
        "round",
        F.filter(trimmed, lambda t: t != "").alias("teams"),
    )


def match_key(df: DataFrame) -> list[str]:
    return [c for c in MATCH if c in df.columns]
