"""Secret scans: fixed patterns, and a battery of randomness tests over what looks encoded.

Patterns (spans of whole matches in code points, leftmost and not overlapping per kind):
``assign`` (a key word, = or :, and a value of 6 or more characters), ``access`` (AKIA and
letters, 20 or more), ``hex`` (24 or more).

Battery. A token is a run of 16 or more letters, digits and ``+/_-``, with its ``=`` padding.
Its encoding is the narrowest alphabet that has all its symbols. Three tests ask how likely
random symbols of that alphabet look at least as regular:

* chi-squared of the symbol counts against uniform ones, with the mean and the variance
  that the statistic has at the token's length (Wilson-Hilferty), so that short tokens of
  large alphabets count right;
* runs of symbols in the lower and the upper half of the alphabet, both ways;
* serial correlation of neighbouring symbols, both ways.

Fisher's method combines them into one chance. Random tokens have any chance alike; ordinary
ones, which are words in some disguise, have low ones, but the shorter the less clearly.

Length-aware false-discovery control. Each token is compared with ``decoys`` ordinary strings
of the same length in the same encoding, made of words around it in the same document (run
together, capitalised, joined by signs, or written as bytes in that encoding). Chances of
tokens and decoys are counted over the whole corpus per encoding and length class. A class
reports tokens down to the least chance at which the expected share of ordinary ones among
those reported, (decoys + 1) / decoys per token / tokens, is at most ``rate``; a class in
which ordinary strings pass as often as tokens reports nothing. Tokens inside of a span of a
pattern count, but are not reported again. Digits alone are never reported: card, phone and
order numbers are as random as keys. Kind of what is reported: ``random``.

Texts are scanned once; what is staged are spans and classes. The driver gets a row per
class and chance step (some hundred classes, 65 steps).

Defined results: null and empty texts have no spans; a document of one token alone has no
decoys and is judged by those of its class in others, a corpus without any reports nothing;
repeated rows give repeated rows; tokens of any length are tested whole; empty tables give
no rows; further columns are not read.
"""

from __future__ import annotations

import base64
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.staging import Shared

KINDS = ("assign", "access", "hex", "random")
_KEY_WORDS = ("password", "passwd", "secret", "token", "api")
_ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"([A-Za-z0-9+/_-]{16,})={0,2}")
_WORD = re.compile(r"[A-Za-z0-9]+")

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
#: Alphabets in the order of their symbols, narrow ones first. Digits alone are no encoding of keys.
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "upper hex": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "upper": _UPPER,
    "base32": _UPPER + "234567",
    "lower digits": _DIGITS + _LOWER,
    "upper digits": _DIGITS + _UPPER,
    "letters": _UPPER + _LOWER,
    "letters digits": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_NAMES = list(ALPHABETS)
_FITS = {name: re.compile(f"[{re.escape(a)}]+") for name, a in ALPHABETS.items()}
_INDEX = {}
for _name, _alphabet in ALPHABETS.items():
    _INDEX[_name] = np.full(256, 255, np.uint8)
    _INDEX[_name][np.frombuffer(_alphabet.encode(), np.uint8)] = np.arange(len(_alphabet))
#: Chances are counted in steps of a quarter of a power of ten; the last step has all lower ones.
STEPS, _PER_TEN = 65, 4
_LENGTHS = 64


def patterns(text: str) -> list[tuple[str, int, int]]:
    """The spans of the fixed patterns, by start and kind."""
    found = []
    low = text.lower()
    if any(word in low for word in _KEY_WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def encoding_of(token: str) -> str | None:
    """The narrowest alphabet of the token's symbols; none for digits alone and for mixed signs."""
    if token.isdigit():
        return None
    return next((name for name in _NAMES if _FITS[name].fullmatch(token)), None)


def _two_sided(z: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(abs(v) / math.sqrt(2)) for v in z])


def battery(symbols: np.ndarray, size: int) -> np.ndarray:
    """For rows of symbols (0 to size - 1): how likely random rows look at least as regular."""
    rows, n = symbols.shape
    counts = np.zeros((rows, size), np.int64)
    switches, products = np.zeros(rows), np.zeros(rows)
    middle, half = (size - 1) / 2, size // 2
    step = max(2, (1 << 20) // rows)
    for at in range(0, n, step):
        part = symbols[:, at : at + step].astype(np.int64)
        counts += np.bincount((part + size * np.arange(rows)[:, None]).ravel(), minlength=rows * size).reshape(rows, size)
        joined = symbols[:, max(0, at - 1) : at + step].astype(float)
        upper = joined >= half
        switches += np.count_nonzero(upper[:, 1:] != upper[:, :-1], axis=1)
        products += ((joined[:, 1:] - middle) * (joined[:, :-1] - middle)).sum(axis=1)
    chi = size / n * (counts.astype(float) ** 2).sum(axis=1) - n
    mean, variance = size - 1, 2 * (size - 1) * (n - 1) / n
    freedom = 2 * mean * mean / variance
    z = (np.cbrt(chi / mean) - (1 - 2 / (9 * freedom))) / math.sqrt(2 / (9 * freedom))
    uniform = np.array([math.erfc(v / math.sqrt(2)) / 2 for v in z])
    share = half / size
    change = 2 * share * (1 - share)
    # neighbouring changes have a covariance of share * (1 - share) - change^2, which is 0 at one half
    spread = (n - 1) * change * (1 - change) + 2 * (n - 2) * (share * (1 - share) - change * change)
    runs = _two_sided((switches - (n - 1) * change) / math.sqrt(spread))
    serial = _two_sided(products / (math.sqrt(n - 1) * (size * size - 1) / 12))
    chances = np.maximum(np.stack([uniform, runs, serial]), 1e-300)
    x = -np.log(chances).sum(axis=0)
    return np.exp(-x) * (1 + x + x * x / 2)


def _step_of(chances: np.ndarray) -> np.ndarray:
    return np.minimum(STEPS - 1, np.floor(-_PER_TEN * np.log10(np.maximum(chances, 1e-300)))).astype(int)


def class_of(encoding: str, length: int) -> int:
    """The number of an encoding and a length class; lengths are cut at half powers of two."""
    return _NAMES.index(encoding) * _LENGTHS + int(2 * math.log2(length))


def ordinary(words: list[str], encoding: str) -> str:
    """Words written so that they fit an encoding."""
    if encoding in ("hex", "upper hex"):
        digits = "".join(words).encode().hex()
        return digits if encoding == "hex" else digits.upper()
    if encoding == "base32":
        return base64.b32encode("".join(words).encode()).decode().rstrip("=")
    if encoding in ("base64", "base64url"):
        return ("/" if encoding == "base64" else "_").join(words)
    if encoding in ("letters", "letters digits"):
        line = "".join(w[:1].upper() + w[1:] for w in words)
    else:
        line = "".join(words)
        line = line.upper() if encoding.startswith("upper") else line.lower()
    return line if encoding.endswith("digits") else "".join(c for c in line if not c.isdigit())


def decoys_of(text: str, start: int, length: int, encoding: str, number: int) -> Iterator[np.ndarray]:
    """Ordinary strings of ``length`` symbols from places spread over the text, as symbol rows."""
    span = 2 * length + 64
    for k in range(number):
        at = (start + (2 * k + 1) * len(text) // (2 * number)) % len(text)
        piece = text[at : at + span]
        piece += text[: min(at, span - len(piece))]
        words = _WORD.findall(_TOKEN.sub(" ", piece))[1:]
        line = ordinary(words, encoding)
        if len(line) >= length:
            yield _INDEX[encoding][np.frombuffer(line[:length].encode(), np.uint8)]


def tokens(text: str, decoys: int) -> tuple[list[tuple[int, int, int, int]], Counter]:
    """Tokens (start, end, class, step) and how many decoys have a class and step."""
    found, ordinary_ones = [], Counter()
    for m in _TOKEN.finditer(text):
        token = m.group(1)
        encoding = encoding_of(token)
        if not encoding:
            continue
        size, kind = len(ALPHABETS[encoding]), class_of(encoding, len(token))
        own = _INDEX[encoding][np.frombuffer(token.encode(), np.uint8)]
        rows, most = [own], max(1, (1 << 20) // len(token))
        chances = []
        for row in decoys_of(text, m.start(), len(token), encoding, decoys):
            if len(rows) >= most:
                chances.append(battery(np.stack(rows), size))
                rows = []
            rows.append(row)
        steps = _step_of(np.concatenate([*chances, battery(np.stack(rows), size)])).tolist()
        found.append((*m.span(), kind, steps[0]))
        ordinary_ones.update((kind, step) for step in steps[1:])
    return found, ordinary_ones


_SPAN = "struct<start:bigint,rank:int,end:bigint>"
SCANNED = (
    f"key string, base array<{_SPAN}>, tokens array<struct<start:bigint,end:bigint,class:int,step:int,apart:boolean>>, "
    "decoys array<struct<class:int,step:int,n:bigint>>"
)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def scanned(docs: DataFrame, decoys: int) -> DataFrame:
    """Per row of ``docs`` (key, text): spans of patterns, tokens and counts of decoys."""

    schema = _arrow(SCANNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, value in zip(batch.column(0), batch.column(1)):
                text = value.as_py() or ""
                base = [{"start": a, "rank": KINDS.index(k), "end": b} for k, a, b in patterns(text)]
                found, ordinary_ones = tokens(text, decoys)
                covered = _Covered(base)
                rows.append(
                    {
                        "key": key.as_py(),
                        "base": base,
                        "tokens": [
                            {"start": a, "end": b, "class": c, "step": s, "apart": not covered.holds(a, b)}
                            for a, b, c, s in found
                        ],
                        "decoys": [{"class": c, "step": s, "n": n} for (c, s), n in ordinary_ones.items()],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.mapInArrow(run, SCANNED)


class _Covered:
    """Stretches that lie within a span."""

    def __init__(self, spans: list[dict]):
        self.starts = [s["start"] for s in spans]
        self.ends = list(accumulate((s["end"] for s in spans), max))

    def holds(self, start: int, end: int) -> bool:
        before = bisect_right(self.starts, start)
        return before > 0 and self.ends[before - 1] >= end


def cuts(tokens_at: dict[tuple[int, int], int], decoys_at: dict[tuple[int, int], int], rate: float) -> dict[int, int]:
    """Per class the last step that is reported. Arguments: counts by class and step."""
    out = {}
    for kind in {c for c, _ in tokens_at}:
        own = np.cumsum([tokens_at.get((kind, s), 0) for s in range(STEPS)])
        others = np.cumsum([decoys_at.get((kind, s), 0) for s in range(STEPS)])
        if not others[-1]:
            continue
        expected = (others + 1) * (own[-1] / others[-1])
        good = np.flatnonzero((own > 0) & (expected <= rate * own))
        if len(good):
            out[kind] = int(good[-1])
    return out


def _by_class(df: DataFrame, column: str, n: Column) -> dict[tuple[int, int], int]:
    rows = df.select(F.explode(column).alias("t")).groupBy("t.class", "t.step").agg(n.alias("n"))
    return {(r["class"], r["step"]): r["n"] for r in rows.collect()}  # classes times steps at most


def scan(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", decoys: int = 20, rate: float = 0.05
) -> DataFrame:
    """One row per input row: the id and ``spans``, an array of (start, rank, end, kind) in order;
    rank is the place of the kind in ``KINDS``."""
    shared = Shared(df.sparkSession)
    docs = df.select(F.col(id_col).cast("string").alias("key"), F.col(text_col).cast("string").alias("text"))
    found = shared.table(scanned(docs, decoys))
    last = cuts(_by_class(found, "tokens", F.count("*")), _by_class(found, "decoys", F.sum("t.n")), rate)
    limit = F.map_from_arrays(F.lit([*last, -1]), F.lit([*last.values(), -1]))
    reported = F.filter("tokens", lambda t: t["apart"] & (t["step"] <= F.coalesce(F.element_at(limit, t["class"]), F.lit(-1))))
    fourth = F.lit(KINDS.index("random"))
    added = F.transform(reported, lambda t: F.struct(t["start"].alias("start"), fourth.alias("rank"), t["end"].alias("end")))
    names = F.array(*map(F.lit, KINDS))
    spans = F.transform(
        F.array_sort(F.concat("base", added)),
        lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), names[s["rank"]].alias("kind")),
    )
    return found.select(F.col("key").cast(df.schema[id_col].dataType.simpleString()).alias(id_col), spans.alias("spans"))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Numbers of spans of each pattern, the digest of their list, and the list of all spans."""
    count = lambda rank: F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < KINDS.index("random"))
    return found.select(
        id_col,
        *(count(rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS[:-1])),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
