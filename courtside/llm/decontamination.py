"""Benchmark decontamination by Wu-Manber search over words.

Method: the windows of all benchmark items (ten consecutive words; an item of fewer words
is one window) are the patterns. Patterns of one length are searched together: a table over
blocks of two words says how far the search may jump when it sees that block, at jump 0 the
block's bucket lists the patterns that end with it, and direct comparison confirms an
occurrence. Since most blocks of a document occur in no pattern, the search looks at about
every ninth word.

The patterns are sent to the executors in blocks of bounded size (``block_bytes`` of item
text); a larger benchmark takes several passes over the documents, whose hit stretches are
then united per document.

Words: A-Z lower-cased, then runs of 0-9, a-z and non-ASCII characters.

Defined results: null texts have no words; items without words have no window; equal
windows of several items count for all of them; items that repeat an id count as one item;
a null item id is written as an empty string; an empty benchmark leaves all documents clean;
repeated documents give repeated rows; further columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.staging import Shared

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_SLICE = 1 << 22

HITS = "struct<n_words:bigint,n_items:bigint,n_hit:bigint,spans:array<struct<first:bigint,last:bigint>>,items:array<string>>"


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8."""
    return _WORD.findall(text.lower())


class WuManber:
    """Patterns of one length, searched together."""

    def __init__(self, patterns: dict[tuple[bytes, ...], frozenset[str]], length: int):
        self.length = length
        self.block = min(2, length)
        self.patterns = patterns
        self.jump: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], list[tuple[bytes, ...]]] = defaultdict(list)
        far = length - self.block + 1
        for pattern in patterns:
            for end in range(self.block, length + 1):
                key = pattern[end - self.block : end]
                self.jump[key] = min(self.jump.get(key, far), length - end)
            self.bucket[pattern[length - self.block :]].append(pattern)
        self.far = far

    def search(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """Starts of occurrences and their patterns."""
        length, far, jump, n = self.length, self.far, self.jump.get, len(words)
        at = length
        if self.block == 1:
            for start, word in enumerate(words):
                if (word,) in self.patterns:
                    yield start, (word,)
            return
        while at <= n:
            key = (words[at - 2], words[at - 1])
            step = jump(key, far)
            if step:
                at += step
                continue
            found = tuple(words[at - length : at])
            for pattern in self.bucket[key]:
                if pattern == found:
                    yield at - length, pattern
            at += 1


class WindowSearch:
    """All windows of some benchmark items, by length."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            words = words_of(text)
            length = min(size, len(words))
            for start in range(len(words) - length + 1 if length else 0):
                by_length[length][tuple(words[start : start + length])].add(item)
        self.tables = [
            WuManber({p: frozenset(i) for p, i in patterns.items()}, length)
            for length, patterns in sorted(by_length.items())
        ]
        self.size = size

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, the stretches of hit words (first, past the last), the items found."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        known, carried = 0, []
        for piece in _slices(text):
            words = carried + words_of(piece)
            base = known - len(carried)
            for table in self.tables:
                for start, pattern in table.search(words):
                    spans.append((base + start, base + start + table.length))
                    items |= table.patterns[pattern]
            known = base + len(words)
            carried = words[max(0, len(words) - self.size + 1) :]
        return known, unite(spans), items


def _slices(text: bytes) -> Iterator[bytes]:
    """A long text in slices that end between words."""
    at = 0
    while len(text) - at > _SLICE:
        gap = _GAP.search(text, at + _SLICE)
        if not gap:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:] if at else text


def unite(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches without overlaps."""
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def _hits(text: Column, items: list[tuple[str, bytes]], size: int) -> Column:
    @F.arrow_udf(HITS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        search = WindowSearch(items, size)
        for batch in batches:
            rows = []
            for value in batch:
                n_words, spans, found = search.scan((value.as_py() or "").encode())
                rows.append(
                    {
                        "n_words": n_words,
                        "n_items": len(found),
                        "n_hit": sum(b - a for a, b in spans),
                        "spans": [{"first": a, "last": b} for a, b in spans],
                        "items": sorted(found),
                    }
                )
            yield pa.array(rows, _HITS_ARROW)

    return run(text.cast("string"))


_HITS_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_items", pa.int64()),
        ("n_hit", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def _united(hits: Column) -> Column:
    """The hits of several passes over one document as one."""

    @F.arrow_udf(HITS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for passes in batch.to_pylist():
                spans = unite([(s["first"], s["last"]) for p in passes for s in p["spans"]])
                items = sorted({i for p in passes for i in p["items"]})
                rows.append(
                    {
                        "n_words": max(p["n_words"] for p in passes),
                        "n_items": len(items),
                        "n_hit": sum(b - a for a, b in spans),
                        "spans": [{"first": a, "last": b} for a, b in spans],
                        "items": items,
                    }
                )
            yield pa.array(rows, _HITS_ARROW)

    return run(hits)


def item_blocks(
    benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int
) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's items in blocks of about ``block_bytes`` of text, one at a time."""
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // block_bytes
    if blocks > 1:
        items = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    for block in range(blocks):
        chosen = items.where(F.col("block") == block) if blocks > 1 else items
        yield [(r["item"], r["text"].encode()) for r in chosen.select("item", "text").toLocalIterator()]


def contamination(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """One row per document: the id and the struct ``hits``.

    One pass without a shuffle while the benchmark has at most ``block_bytes`` of text.
    Beyond that every block takes its own pass, whose hits are staged before the next
    block is read; they meet by id and digest of the text.
    """
    text = F.col(text_col).cast("string")
    blocks = item_blocks(benchmark, item_col, item_text_col, block_bytes)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return df.select(F.col(id_col).alias(id_col), _hits(text, first, window).alias("hits"))
    docs = df.select(F.col(id_col).alias("_id"), F.sha2(text, 256).alias("_sha"), text.alias("_text"))
    shared = Shared(df.sparkSession)
    passes = []
    for block in chain([first, second], blocks):
        found = docs.select("_id", "_sha", _hits(F.col("_text"), block, window).alias("_h"))
        passes.append(shared.table(found.where(F.col("_h.n_hit") > 0)))
    met = reduce(DataFrame.unionByName, passes).groupBy("_id", "_sha").agg(F.collect_set("_h").alias("_p"))
    met = met.select(F.col("_id").alias("_id2"), F.col("_sha").alias("_sha2"), _united(F.col("_p")).alias("_met"))
    counted = docs.select("_id", "_sha", _hits(F.col("_text"), [], window).alias("_none"))
    same = F.col("_id").eqNullSafe(F.col("_id2")) & F.col("_sha").eqNullSafe(F.col("_sha2"))
    return counted.join(met, same, "left").select(
        F.col("_id").alias(id_col), F.coalesce("_met", "_none").alias("hits")
    )


def clean(
    df: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """The rows of ``df`` whose text holds no window of any item. A filter per block of items,
    without a shuffle; rows that a block rejects are staged away before the next block."""
    shared = Shared(df.sparkSession)
    blocks = item_blocks(benchmark, item_col, item_text_col, block_bytes)
    kept, block = df, next(blocks)
    while block is not None:
        kept = kept.where(_hits(F.col(text_col).cast("string"), block, window)["n_hit"] == 0)
        block = next(blocks, None)
        if block is not None:
            kept = shared.table(kept)
    return kept
