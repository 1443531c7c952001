"""Importance resampling towards a target distribution, over hashed word n-grams.

Words are runs of 0-9, a-z and non-ASCII characters after A-Z are lower-cased. Features are
all runs of one to ``longest`` words, joined by one space; a feature's bucket is its crc32.

Method.

1. Overlapped regex scanning: separators are collapsed to single spaces; then an expression
   for each order, with look-arounds for the ends of words, is searched with overlaps, and
   its spans are n-grams that crc32 takes from the collapsed text as they are. Long texts are
   scanned in slices that share their last words. What is staged are bucket numbers, so
   texts are scanned once.
2. Each task adds up its buckets; Spark adds the tasks. The driver gets one row per bucket
   of the documents and of the target (``buckets`` rows at most) and forms the gains.
3. A document's weight is the floored mean of its gains. Gumbel noise from a digest of the
   id makes the highest scores a draw without replacement in proportion to the weights.
4. Scores are sorted by range; a rank is the row's place within its range plus the rows of
   earlier ranges. No task holds more than a range, and rows that repeat an id and a score
   are split between ranges, too.

Defined results: null and empty texts have no features and weight 0; documents under
``least_words`` words are scored but never drawn; a null id is scored as an empty one and
drawn after all others of its score; repeated rows are documents of their own; empty tables
give empty results, and an empty target gains that favour rare words; further columns are
not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.slices import slices
from courtside.llm.staging import Shared

_GAPS = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition


class OverlappedNgrams:
    """Crc32 sums of the runs of one to ``longest`` words."""

    def __init__(self, longest: int):
        self.longest = longest
        self.of_order = [
            regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (order - 1)) for order in range(1, longest + 1)
        ]

    def scan(self, text: bytes) -> Iterator[tuple[int, list[int]]]:
        """For each slice: its number of words, and the sums of the n-grams that end in it."""
        carried = b""
        for piece in slices(text.lower(), _GAPS):
            fresh = _GAPS.sub(b" ", piece).strip(b" ")
            if not fresh:
                continue
            line = carried + b" " + fresh if carried else fresh
            sums, words = [], 0
            for order, pattern in enumerate(self.of_order, 1):
                found = pattern.finditer(line, overlapped=True)
                if carried:
                    crcs = [zlib.crc32(line[m.start() : m.end()]) for m in found if m.end() > len(carried)]
                else:
                    crcs = [zlib.crc32(m.group()) for m in found]
                words = len(crcs) if order == 1 else words
                sums += crcs
            yield words, sums
            if self.longest > 1:
                carried = b" ".join(line.rsplit(b" ", self.longest - 1)[1 - self.longest :])


def _kind(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def features(docs: DataFrame, longest: int, buckets: int) -> DataFrame:
    """Per row of ``docs`` (key, text): key, n_words, n_features and the packed bucket numbers."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ngrams = OverlappedNgrams(longest)
        for batch in batches:
            words, sizes, packed = [], [], []
            for text in batch.column(1):
                n, parts = 0, []
                for some, sums in ngrams.scan((text.as_py() or "").encode()):
                    n += some
                    parts.append((np.array(sums, np.uint32) % np.uint32(buckets)).astype(kind))
                words.append(n)
                sizes.append(sum(map(len, parts)))
                packed.append(b"".join(p.tobytes() for p in parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                ["key", "n_words", "n_features", "packed"],
            )

    return docs.mapInArrow(run, "key string, n_words bigint, n_features bigint, packed binary")


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all rows are in each bucket."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = found.select("packed").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for r in rows.collect():  # at most one row per bucket
        counts[r["bucket"]] = r["n"]
    return counts


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of smoothed bucket shares, target over documents."""
    size = len(documents)
    more = (target + 1.0) * float(documents.sum() + size)
    less = (documents + 1.0) * float(target.sum() + size)
    return np.floor(1000 * np.log(more / less)).astype(np.int64)


def _weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    kind = _kind(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = (np.frombuffer(p.as_buffer(), kind) for p in batch.column(3))
            weight = [int(gain[b].sum()) // len(b) if len(b) else 0 for b in each]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(3)), pa.array(weight, pa.int64())],
                ["key", "n_words", "n_features", "weight"],
            )

    return found.mapInArrow(run, "key string, n_words bigint, n_features bigint, weight bigint")


def _ranked(pool: DataFrame, percent: int, shared: Shared) -> DataFrame:
    """``pool`` with the rank of its best ``percent`` rows by score and id."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("row")]
    split = pool.withColumn("row", F.monotonically_increasing_id())
    placed = split.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = shared.table(placed.withColumn("at", F.monotonically_increasing_id()).drop("row"))
    part, place = F.shiftright("at", _ROW_BITS), F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # one per range
    before = np.cumsum([0, *(r["n"] for r in sizes)]).tolist()
    offsets = pool.sparkSession.createDataFrame(
        [(r["part"], n) for r, n in zip(sizes, before)], "part bigint, before bigint"
    )
    rank = F.col("before") + place + 1
    numbered = placed.withColumn("part", part).join(F.broadcast(offsets), "part")
    return numbered.withColumn("rank", F.when(rank <= percent * before[-1] // 100, rank)).drop("part", "at", "before")


def resample(
    df: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    longest: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: str = "2024",
) -> DataFrame:
    """One row per input row: the id, ``n_features``, ``weight``, ``score`` and ``rank``, which is
    null for what is not drawn."""
    shared = Shared(df.sparkSession)
    key = F.col(id_col).cast("string").alias("key")
    found = shared.table(features(df.select(key, F.col(text_col).cast("string").alias("text")), longest, buckets))
    aim = target.select(F.lit("").alias("key"), F.col(target_text_col).cast("string").alias("text"))
    gain = gains(bucket_counts(found, buckets), bucket_counts(features(aim, longest, buckets), buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("key", F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    id_type = df.schema[id_col].dataType.simpleString()
    scored = _weights(found, gain).select(
        F.col("key").cast(id_type).alias("id"),
        "n_words",
        "n_features",
        "weight",
        (F.col("weight") + noise).alias("score"),
    )
    scored = shared.table(scored)
    shared.drop(found)
    drawn = _ranked(scored.where(F.col("n_words") >= least_words), percent, shared)
    others = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score", "rank"]
    return drawn.select(*columns).unionByName(others.select(*columns))


def drawn_rows(df: DataFrame, ranked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` whose id was drawn."""
    ids = ranked.where("rank IS NOT NULL").select(F.col(id_col).alias("_drawn"))
    return df.join(ids, df[id_col] == F.col("_drawn"), "left_semi")
