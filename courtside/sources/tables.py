"""Feeds derived from the benchmark tables, as message text for the parsers.

``events`` becomes a whole play-by-play feed: every event is a play of one of twelve
games, every game and day is a match with a start and (mostly) a final message, and
days open and close rounds and seasons. ``orders`` becomes final score lines in volume.
``customer`` and ``nation`` become a player list.

Plays are a projection of single events. Start, final, round and season messages come
from a grouped minimum and maximum, so no history is ordered to build a feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.schema import GAME_TOPIC

GAMES = 12
SEASON_DAYS = 10
STARTERS = 5
ROSTER = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(
        *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    )


def _div(a: Column, b: Column | int) -> Column:
    return F.floor(a / (F.lit(b) if isinstance(b, int) else b)).cast("bigint")


def _team(game: Column, side: int | Column) -> Column:
    return _text("T", game * 2 + side)


def _score_line(game: Column, day: Column, second: Column) -> Column:
    """Both scores grow with the second of the day, at a pace set by game and day."""
    home = _div(second, 600 + 150 * (game % 4))
    away = _div(second, 600 + 150 * ((game + day) % 3))
    return _text(_team(game, 0), " ", home, " X ", away, " ", _team(game, 1))


def _record(key: Column, value: Column, partition: Column, offset: Column, ts: Column) -> Column:
    return F.struct(
        key.alias("key"),
        value.alias("value"),
        F.lit(GAME_TOPIC).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        ts.alias("ts"),
    )


def _game_columns(events: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return events.select("event_id", "user_id", "event_type", ts.alias("ts")).withColumns(
        {
            "game": F.col("user_id") % GAMES,
            "day": _div(F.unix_micros("ts"), 86_400_000_000),
            "second": _div(F.unix_micros("ts"), 1_000_000) % 86_400,
        }
    )


def _play() -> Column:
    eid, user, game = F.col("event_id"), F.col("user_id"), F.col("game")
    kind = F.col("event_type")
    side = _div(user, GAMES) % 2
    player = _text("P", user)
    points = (
        F.when(eid % 7 == 0, F.lit('"3"'))
        .when(eid % 7 == 1, F.lit("2.7"))
        .otherwise((2 + eid % 2).cast("string"))
    )
    first_opponent = _text("P", game + GAMES * (1 - side))
    substitute = _text("P", game + GAMES * (2 * (STARTERS + eid % STARTERS) + side))
    details = (
        F.when(eid % 37 == 0, _text('{"ação":"TIMEOUT","jogador":"', player, '"}'))
        .when(
            kind.isin("purchase", "click"),
            _text(
                '{"ação":"POINT","jogador":"',
                F.when(eid % 31 == 0, F.lit("")).otherwise(player),
                '","valor":',
                points,
                "}",
            ),
        )
        .when(
            kind == "error",
            _text(
                '{"ação":"FOUL","jogador_commit":"', player, '","jogador_receive":"', first_opponent, '"}'
            ),
        )
        .when(kind == "view", _text('{"ação":"TURNOVER","jogador":"', player, '"}'))
        .otherwise(
            _text(
                '{"ação":"SUBSTITUTION","jogador_out":"', player, '","jogador_in":"', substitute, '"}'
            )
        )
    )
    line = F.when(
        eid % 53 == 0, _text(_team(game, 0), " x X 3 ", _team(game, 1))
    ).otherwise(_score_line(game, F.col("day"), F.col("second")))
    quarter = F.when(eid % 29 == 0, F.lit("")).otherwise(_text(',"quarto":', 1 + eid % 4))
    value = _text(
        '{"tipo":"EVENTO","time":"', _team(game, side), '"', quarter,
        ',"placar":"', line, '","detalhes":', details, "}",
    )
    return _record(_text("Game_", 100 + game), value, game % 3, (eid + 1) * 8 + 4, F.col("ts"))


def _junk() -> Column:
    """Unreadable records next to some events: broken, empty, of no known kind, no object."""
    eid = F.col("event_id")
    which = _div(eid, 41) % 4
    value = (
        F.when(which == 0, '{"tipo":"EVENTO"')
        .when(which == 1, F.lit(None).cast("string"))
        .when(which == 2, '{"tipo":"PAUSA"}')
        .otherwise("[1]")
    )
    record = _record(F.lit(" "), value, F.col("game") % 3, (eid + 1) * 8 + 5, F.col("ts"))
    return F.when((eid % 41 == 0) & (F.col("event_type") == "error"), record)


def _roster(game: Column, side: int) -> Column:
    def players(first: int, last: int) -> Column:
        names = F.transform(
            F.sequence(F.lit(first), F.lit(last)),
            lambda k: _text('"P', game + GAMES * (2 * k + side), '"'),
        )
        return F.array_join(names, ",")

    return _text(
        '"', _team(game, side), '":{"titulares":[', players(0, STARTERS - 1),
        '],"reservas":[', players(STARTERS, ROSTER - 1), "]}",
    )


def _match_messages(events: DataFrame) -> DataFrame:
    game, day = F.col("game"), F.col("day")
    at = F.struct("ts", "event_id")
    ends = events.groupBy("game", "day").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    key = _text("Game_", 100 + game)
    title = _text(_team(game, 0), " X ", _team(game, 1))
    start = _record(
        key,
        _text(
            '{"tipo":"INICIO","match":"', title, '",', _roster(game, 0), ",", _roster(game, 1), "}"
        ),
        game % 3,
        (F.col("first.event_id") + 1) * 8 + 1,
        F.col("first.ts"),
    )
    last_second = _div(F.unix_micros(F.col("last.ts")), 1_000_000) % 86_400
    final = _record(
        key,
        _text('{"tipo":"FINAL","match":"', _score_line(game, day, last_second), '"}'),
        game % 3,
        (F.col("last.event_id") + 1) * 8 + 6,
        F.col("last.ts"),
    )
    over = (day + game) % 5 != 4
    return ends.select(F.explode(F.array_compact(F.array(start, F.when(over, final)))).alias("r"))


def _calendar_messages(events: DataFrame) -> DataFrame:
    day = F.col("day")
    morning = F.timestamp_micros(day * 86_400_000_000)
    night = F.timestamp_micros(day * 86_400_000_000 + 86_399_999_999)
    teams = F.array_join(
        F.transform(
            F.sequence(F.lit(0), F.lit(2 * GAMES - 1)),
            lambda i: F.when(
                i % 5 == 0, _text('" T', (i * 7 + day) % (2 * GAMES), ' "')
            ).otherwise(_text('"T', (i * 7 + day) % (2 * GAMES), '"')),
        ),
        ",",
    )

    def mark(value: Column, offset: int, ts: Column) -> Column:
        return _record(F.lit(None).cast("string"), value, F.lit(0), F.lit(offset), ts)

    season_day = day % SEASON_DAYS
    number = _div(season_day, 2) + 1
    marks = F.array(
        F.when(season_day == 0, mark(_text('{"tipo":"SEASON_START","times":[', teams, '," "]}'), 0, morning)),
        F.when(season_day % 2 == 0, mark(_text('{"tipo":"RODADA_INICIO","rodada":', number, "}"), 1, morning)),
        F.when(season_day % 2 == 1, mark(_text('{"tipo":"RODADA_FIM","rodada":', number, "}"), 2, night)),
        F.when(season_day == SEASON_DAYS - 1, mark(F.lit('{"tipo":"SEASON_END"}'), 3, night)),
    )
    return events.select("day").distinct().select(F.explode(F.array_compact(marks)).alias("r"))


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as a play-by-play feed."""
    events = _game_columns(table(spark, sf_dir, "events"))
    records = events.select(
        F.explode(F.array_compact(F.array(_play(), _junk()))).alias("r")
    )
    return records.union(_match_messages(events)).union(_calendar_messages(events)).select("r.*")


def plays_feed(events: DataFrame) -> DataFrame:
    """Play records only, one per event, by projection; ``events`` may be a stream."""
    return _game_columns(events).select(_play().alias("r")).select("r.*")


def _order_sides() -> tuple[Column, Column, Column, Column]:
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    n = 2 * GAMES
    home = _text("T", cust % n)
    away = _text("T", (cust % n + 1 + order % (n - 1)) % n)
    return home, 80 + order % 50, 80 + _div(F.col("o_totalprice"), 1) % 50, away


def finals_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``orders`` table as final messages, one per order."""
    return finals_of(table(spark, sf_dir, "orders"))


def finals_of(orders: DataFrame) -> DataFrame:
    home, home_score, away_score, away = _order_sides()
    order = F.col("o_orderkey")
    value = _text(
        '{"tipo":"FINAL","match":"', home, " ", home_score, " X ", away_score, " ", away, '"}'
    )
    record = _record(
        _text("Game_", 100 + order % 899), value, order % 3, order, F.col("o_orderdate").cast("timestamp")
    )
    return orders.select(record.alias("r")).select("r.*")


def score_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score line per order, in regular and irregular spellings."""
    home, home_score, away_score, away = _order_sides()
    order = F.col("o_orderkey")
    regular = _text(home, " ", home_score, " X ", away_score, " ", away)
    way = order % 10
    line = (
        F.when(way == 3, _text("LA ", regular))
        .when(way == 4, _text(home, " ", home_score, " ", away_score, " ", away))
        .when(way == 5, _text(home, " x X ", away_score, " ", away))
        .when(way == 6, _text(home, " X ", away))
        .when(way == 7, _text("  ", home, "  ", home_score, " X ", away_score, "  ", away, " "))
        .when(way == 8, _text(regular, " X extra"))
        .when(way == 9, F.lit(None).cast("string"))
        .otherwise(regular)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", line.alias("line"))


def player_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as players, their nations as teams, in key order."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("Team"))
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("idx"),
            F.col("c_name").alias("Player"),
            "Team",
            F.element_at(F.array(*[F.lit(p) for p in ("C", "PF", "PG", "SF", "SG")]), (key % 5 + 1).cast("int")).alias("Pos"),
            (1 + key % 10).cast("int").alias("Rank"),
        )
    )
