"""Text, number and codec expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alert wording (fixed values).
ALERT_FORMAT = "O %s está pegando fogo! Fez %d pontos em sequência!"
ALERT_PATTERN = r"O (.+) está pegando fogo! Fez (\d+) pontos"
SIMULTANEOUS_SUFFIX = " jogadores em hot streak simultânea"
# Labels that readers of the tables know (fixed values).
NO_VALUE = "—"
AVERAGE_FORMAT = "%.1f méd"
LIVE_LABEL = "Ao vivo"
QUARTER_SUFFIX = "º Q"
_SPACES = " \t\n\x0b\f\r"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_int(c: Column | str) -> Column:
    """A JSON number or numeric string as INT (2.7 and "2.7" give 2), else NULL."""
    return _col(c).try_cast("double").try_cast("int")


def strict_int(c: Column | str) -> Column:
    """An INT written as an optional sign and digits only, else NULL."""
    c = _col(c)
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("int"))


def is_blank(c: Column | str) -> Column:
    """NULL, empty, or white space only."""
    return F.coalesce(F.btrim(_col(c), F.lit(_SPACES)) == "", F.lit(True))


def encode_int(c: Column | str, width: int = 4) -> Column:
    """A non-negative integer as big-endian bytes (4 for Int32, 8 for Int64)."""
    return F.unhex(F.lpad(F.hex(_col(c).cast("bigint")), 2 * width, "0"))


def decode_int(c: Column | str, width: int = 4) -> Column:
    """The inverse of :func:`encode_int`; NULL when the byte count does not fit."""
    c = _col(c)
    number = F.conv(F.hex(c), 16, 10).cast("bigint")
    return F.when(F.octet_length(c) == width, number.cast("int" if width == 4 else "bigint"))


def decode_json(c: Column | str, schema: str) -> Column:
    return F.from_json(_col(c).cast("string"), schema, {"allowSingleQuotes": "false"})


def encode_json(*cols: Column | str) -> Column:
    """A JSON object that writes NULL fields too."""
    return F.to_json(F.struct(*[_col(c) for c in cols]), {"ignoreNullFields": "false"})


def alert_message(player: Column | str, points: Column | str) -> Column:
    return F.format_string(ALERT_FORMAT, _col(player), _col(points).cast("int"))


def parse_alert(player: Column | str, message: Column | str) -> Column:
    """``struct(player, points)``: from the wording, else the record key and 0."""
    message = _col(message)
    points = F.regexp_extract(message, ALERT_PATTERN, 2).try_cast("int")
    name = F.trim(F.regexp_extract(message, ALERT_PATTERN, 1))
    return F.struct(
        F.when(points.isNotNull(), name).otherwise(_col(player)).alias("player"),
        F.coalesce(points, F.lit(0)).alias("points"),
    )


def simultaneous_message(count: Column | str) -> Column:
    return F.concat(_col(count).cast("string"), F.lit(SIMULTANEOUS_SUFFIX))


def rounded_average(total: Column | str, games: Column | str) -> Column:
    """Average to one decimal, halves up; 0 where nothing was played."""
    total, games = _col(total), _col(games)
    tenths = F.floor(total * F.lit(10.0) / F.nullif(games, F.lit(0)).cast("double") + F.lit(0.5))
    return F.when(games > 0, tenths / F.lit(10.0)).otherwise(F.lit(0.0))


def odds_label(odds: Column | str) -> Column:
    odds = _col(odds)
    return F.when(odds.isNull() | F.isnan(odds), "").otherwise(F.format_string("%.2f", odds))


def average_label(games: Column | str, average: Column | str) -> Column:
    return F.when(_col(games) <= 0, NO_VALUE).otherwise(
        F.format_string(AVERAGE_FORMAT, _col(average))
    )


def quarter_label(quarter: Column | str) -> Column:
    quarter = _col(quarter)
    return F.when(quarter <= 0, LIVE_LABEL).otherwise(
        F.concat(quarter.cast("string"), F.lit(QUARTER_SUFFIX))
    )


def truncate(text: Column | str, width: int) -> Column:
    text = F.coalesce(_col(text), F.lit(""))
    return F.when(
        F.length(text) > width, F.concat(F.substring(text, 1, max(0, width - 3)), F.lit("..."))
    ).otherwise(text)
