"""Score lines such as ``IND 103 X 101 BRK`` in their four accepted readings.

Every reading is a projection of built-in string expressions:

``wide``       team names may have several words; the score stands next to the separator
``strict``     exactly two sides, name and score are the first two words of each side
``dashboard``  as strict; a start title may carry names only; failure gives blanks and zeros
``odds``       no trimming; a line without both sides gives all NULL, a bad number NULL scores
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtside.functions.text import strict_int

SEPARATOR = " X "
_CONTROL = "".join(map(chr, range(1, 32)))
_TWO_WORDS = r"^[\x00-\x20]*(\S+)\s+(\S+)"
_ONE_WORD = r"^[\x00-\x20]*(\S*)[\x00-\x20]*$"
_NAME_THEN_SCORE = r"(?s)^(.+) ([^ ]+)$"
_SCORE_THEN_NAME = r"(?s)^([^ ]+) (.+)$"


def _result(home: Column, home_score: Column, away_score: Column, away: Column) -> Column:
    return F.struct(
        home.alias("home"),
        home_score.alias("home_score"),
        away_score.alias("away_score"),
        away.alias("away"),
    )


def _sides(line: Column) -> tuple[Column, Column, Column]:
    """Left side, right side, and whether nothing else follows them.

    Empty pieces at the end of the line do not count as sides.
    """
    pieces = F.split(line, SEPARATOR)
    left, right = F.get(pieces, F.lit(0)), F.get(pieces, F.lit(1))
    rest = F.array_join(F.slice(pieces, F.lit(3), F.greatest(F.size(pieces), F.lit(1))), "")
    return left, right, (right != "") & (rest == "")


def _wide(line: Column) -> Column:
    text = F.trim(line)
    at = F.instr(text, SEPARATOR)
    left = F.trim(F.substring(text, F.lit(1), at - 1))
    right = F.trim(F.substring(text, at + len(SEPARATOR), F.length(text)))
    home_score = strict_int(F.regexp_extract(left, _NAME_THEN_SCORE, 2))
    away_score = strict_int(F.regexp_extract(right, _SCORE_THEN_NAME, 1))
    valid = (at > 0) & home_score.isNotNull() & away_score.isNotNull()
    return F.when(
        valid,
        _result(
            F.trim(F.regexp_extract(left, _NAME_THEN_SCORE, 1)),
            home_score,
            away_score,
            F.trim(F.regexp_extract(right, _SCORE_THEN_NAME, 2)),
        ),
    )


def _strict(line: Column) -> Column:
    left, right, two_sides = _sides(line)
    home_score = strict_int(F.regexp_extract(left, _TWO_WORDS, 2))
    away_score = strict_int(F.regexp_extract(right, _TWO_WORDS, 1))
    return F.when(
        two_sides & home_score.isNotNull() & away_score.isNotNull(),
        _result(
            F.regexp_extract(left, _TWO_WORDS, 1),
            home_score,
            away_score,
            F.regexp_extract(right, _TWO_WORDS, 2),
        ),
    )


def _dashboard(line: Column, names_only: Column) -> Column:
    left, right, two_sides = _sides(line)
    bare = names_only & two_sides & left.rlike(_ONE_WORD) & right.rlike(_ONE_WORD)
    zero = F.lit(0)
    return F.coalesce(
        F.when(
            bare,
            _result(
                F.regexp_extract(left, _ONE_WORD, 1),
                zero,
                zero,
                F.regexp_extract(right, _ONE_WORD, 1),
            ),
        ),
        _strict(line),
        _result(F.lit(""), zero, zero, F.lit("")),
    )


def _odds(line: Column) -> Column:
    left, right, _ = _sides(line)

    def words(side: Column) -> Column:
        # Blanks at the end make no words; an empty side is one empty word.
        kept = F.regexp_replace(side, " +$", "")
        return F.when((side != "") & (kept == ""), F.array().cast("array<string>")).otherwise(
            F.split(kept, " ")
        )

    a, b = words(left), words(right)
    named = (
        F.coalesce(right, F.lit("")) != ""
    ) & (F.size(a) >= 1) & (F.size(b) >= 2)
    home_score, away_score = strict_int(F.get(a, F.lit(1))), strict_int(F.get(b, F.lit(0)))
    complete = named & home_score.isNotNull() & away_score.isNotNull()
    return _result(
        F.when(named, F.trim(F.get(a, F.lit(0)))),
        F.when(complete, home_score),
        F.when(complete, away_score),
        F.when(named, F.trim(F.get(b, F.lit(1)))),
    )


def _regular(line: Column) -> tuple[Column, Column]:
    """Whether a line is ``NAME n X m NAME`` with single blanks, and its parts if so.

    All readings agree on such lines, which are nearly all there are, and cutting at
    blanks costs a fraction of the patterns the other lines need.
    """
    words = F.split(line, " ")
    word = [F.get(words, F.lit(i)) for i in range(5)]
    home_score, away_score = word[1].try_cast("int"), word[3].try_cast("int")
    regular = (
        (F.size(words) == 5)
        & (word[2] == "X")
        & (word[0] != "")
        & (word[4] != "")
        & home_score.isNotNull()
        & away_score.isNotNull()
        & (F.length(F.translate(line, _CONTROL, "")) == F.length(line))
    )
    return regular, _result(word[0], home_score, away_score, word[4])


def scoreboard(
    line: Column | str, form: str = "strict", names_only: Column | bool = False
) -> Column:
    """``struct(home, home_score, away_score, away)`` read from a score line.

    ``wide`` and ``strict`` give NULL for an unreadable line. ``names_only`` (used by
    ``dashboard``) tells which rows may carry a title without scores.
    """
    line = F.col(line) if isinstance(line, str) else line
    line = F.coalesce(line, F.lit(""))
    if form == "wide":
        other = _wide(line)
    elif form == "strict":
        other = _strict(line)
    elif form == "dashboard":
        other = _dashboard(line, F.lit(names_only) if isinstance(names_only, bool) else names_only)
    elif form == "odds":
        other = _odds(line)
    else:
        raise ValueError(f"unknown score line form: {form}")
    regular, parts = _regular(line)
    return F.when(regular, parts).otherwise(other)


def title_teams(title: Column | str) -> Column:
    """``struct(home, away)`` of a match title; NULL when the separator is missing or leads."""
    title = F.col(title) if isinstance(title, str) else title
    at = F.instr(title, SEPARATOR)
    return F.when(
        at > 1,
        F.struct(
            F.trim(F.substring(title, F.lit(1), at - 1)).alias("home"),
            F.trim(F.substring(title, at + len(SEPARATOR), F.length(title))).alias("away"),
        ),
    )
