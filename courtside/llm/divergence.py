"""Source divergence audit: how the sources of a language differ in their terms.

Terms are runs of letters (A-Z lower-cased, a-z, non-ASCII). Each language keeps the terms
of at least ``least_docs`` of its documents. Each source of a language, and the language
itself, gives every kept term a smoothed share in billionths; two shares differ by the floor
of (p-q)^2/(p+q). The audit returns, per language and source, all other sources with the sum
over all kept terms (part ``pair``) and the terms that the source favours most over its
language (part ``term``).

Method: late string materialization.

1. Tasks count terms per (language, source) while reading and write rows of term, 64-bit
   digest, occurrences and documents, one per term that a task holds. This table is written,
   not shuffled.
2. Counting reads the digest and number columns of that table only: fixed-width term digests
   are shuffled, sums are combined before the shuffle.
3. For the digests that can be kept, the smallest and the largest string are looked up. Where
   they differ, several terms share the digest; such digests are counted again by string and
   split into one entry per term (``bits`` narrows the digest, for tests).
4. Shares and differences are computed by digest. Strings are joined back just to the rows
   whose value is among a source's best, and order what is equal.
5. Sums over pairs of sources are made in tasks that hold some terms of a language as a table
   of terms by sources; what leaves a task is one number per pair of sources, which is also
   what the result lists. A term that a source does not use has the source's smallest share.

All arithmetic is on integers; products beyond 64 bits are decimals.

Defined results: null text, language and source are empty ones; a group without terms, and
a language that keeps none, has pairs of value 0 (kept terms give it equal shares); a
language with one source has no pairs; repeated rows are documents of their own; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.slices import slices
from courtside.llm.staging import Shared

_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")

OCCURRENCES = "lang string, source string, digest bigint, term string, n bigint, d bigint"


def count_terms(docs: DataFrame, bits: int, held_terms: int) -> DataFrame:
    """Rows of ``OCCURRENCES``: n occurrences in d documents. ``docs``: lang, source, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (times, documents) in held.items():
                terms = list(times)
                digest = np.fromiter(map(xxh3_64_intdigest, terms), np.uint64, len(terms)) >> np.uint64(64 - bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(terms), pa.string()),
                        pa.array([source] * len(terms), pa.string()),
                        pa.array(digest.view(np.int64)),
                        pa.array(terms, pa.binary()).cast(pa.string()),
                        pa.array(np.fromiter(times.values(), np.int64, len(terms))),
                        pa.array(np.fromiter(map(documents.__getitem__, terms), np.int64, len(terms))),
                    ],
                    ["lang", "source", "digest", "term", "n", "d"],
                )

        for batch in batches:
            for lang, source, text in zip(*(batch.column(k) for k in range(3))):
                group = lang.as_py(), source.as_py()
                if group not in held:
                    held[group] = Counter(), Counter()
                times, documents = held[group]
                seen: set[bytes] = set()
                for piece in slices(text.as_py().encode().lower(), _GAP):
                    terms = _TERM.findall(piece)
                    times.update(terms)
                    seen.update(terms)
                documents.update(seen)
            if sum(len(times) for times, _ in held.values()) > held_terms:
                yield from out()
                held.clear()
        yield from out()

    return docs.mapInArrow(run, OCCURRENCES)


def _kept_terms(occurrences: DataFrame, least_docs: int, shared: Shared) -> tuple[DataFrame, DataFrame]:
    """Counts (lang, source, digest, nth, n) of kept terms, and their texts (lang, digest, nth, term).

    ``nth`` is 0, or the number of the term among those that share the digest.
    """
    key = ["lang", "digest"]
    sums = occurrences.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    sums = shared.table(sums)
    frequent = shared.table(sums.groupBy(*key).agg(F.sum("d").alias("d")).where(F.col("d") >= least_docs).select(*key))
    strings = occurrences.select(*key, "term").join(frequent, key, "left_semi")
    ends = shared.table(strings.groupBy(*key).agg(F.min("term").alias("term"), F.max("term").alias("last")))
    whole = ends.where("term = last").select(*key, F.lit(0).alias("nth"), "term")
    counts = sums.join(whole.select(*key, "nth"), key).select("lang", "source", "digest", "nth", "n")
    collided = ends.where("term <> last").select(*key)
    if collided.isEmpty():
        return shared.table(counts), whole
    apart = occurrences.join(collided, key, "left_semi").groupBy("lang", "source", "digest", "term")
    apart = shared.table(apart.agg(F.sum("n").alias("n"), F.sum("d").alias("d")))
    kept = apart.groupBy(*key, "term").agg(F.sum("d").alias("d")).where(F.col("d") >= least_docs)
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("term"))
    split = shared.table(kept.select(*key, nth.alias("nth"), "term"))
    parts = apart.join(split, [*key, "term"]).select("lang", "source", "digest", "nth", "n")
    return shared.table(counts.unionByName(parts)), whole.unionByName(split)


def share(times: Column, total: Column, kept: Column) -> Column:
    """The smoothed share of a term in billionths, one more than its floor."""
    top = F.lit(1_000_000_000).cast("decimal(10,0)") * (times + 2).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", top, (total + 2 * kept).cast("decimal(20,0)"))


def difference(p: Column, q: Column) -> Column:
    """Floor of (p-q)^2/(p+q); shares are below 1.1 billion, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _shard_sums(key: tuple, table: pa.Table) -> pa.Table:
    """Differences of all pairs of sources, added up over the terms of one shard.

    ``table``: per source a row without digest and with the share of a term it does not use,
    and a row per term and source that uses it.
    """
    heads = table.filter(pc.is_null(table.column("digest")))
    used = table.filter(pc.is_valid(table.column("digest")))
    size = heads.num_rows
    floor = np.zeros(size, np.int64)
    floor[heads.column("idx").to_numpy()] = heads.column("p").to_numpy()
    digest, nth = used.column("digest").to_numpy(), used.column("nth").to_numpy()
    order = np.lexsort([nth, digest])
    digest, nth = digest[order], nth[order]
    idx, p = used.column("idx").to_numpy()[order], used.column("p").to_numpy()[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (digest[1:] != digest[:-1]) | (nth[1:] != nth[:-1])
    term = np.cumsum(fresh) - 1
    terms = int(term[-1]) + 1 if len(term) else 0
    total = np.zeros((size, size), np.int64)
    step = max(1, (1 << 21) // max(1, size))
    for first in range(0, terms, step):
        a, b = np.searchsorted(term, [first, first + step])
        shares = np.tile(floor[:, None], (1, min(step, terms - first)))
        shares[idx[a:b], term[a:b] - first] = p[a:b]
        for i in range(size - 1):
            gap = shares[i + 1 :] - shares[i]
            total[i, i + 1 :] += (gap * gap // (shares[i + 1 :] + shares[i])).sum(axis=1)
    i, j = np.triu_indices(size, 1)
    return pa.table(
        {"lang": pa.array([key[0].as_py()] * len(i), pa.string()), "i": pa.array(i), "j": pa.array(j), "value": pa.array(total[i, j])}
    )


def _pairs(counts: DataFrame, groups: DataFrame, shard_rows: int) -> DataFrame:
    """Rows (lang, source, item, value) for all ordered pairs of sources of a language."""
    shards = F.lit(1).cast("bigint") + F.call_function("div", F.col("rows"), F.lit(shard_rows))
    sized = groups.withColumn("shards", shards)
    lone = F.lit(None).cast("bigint")
    none = F.lit(0).cast("bigint")
    heads = sized.select(
        "lang",
        F.explode(F.sequence(none, F.col("shards") - 1)).alias("shard"),
        "idx",
        lone.alias("digest"),
        F.lit(None).cast("int").alias("nth"),
        F.when(F.col("kept") > 0, share(none, F.col("total"), F.col("kept"))).otherwise(none).alias("p"),
    )
    used = counts.join(sized, ["lang", "source"]).select(
        "lang",
        F.pmod(F.xxhash64("digest", "nth"), F.col("shards")).alias("shard"),
        "idx",
        "digest",
        "nth",
        share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
    )
    parts = heads.unionByName(used).groupBy("lang", "shard").applyInArrow(
        _shard_sums, "lang string, i bigint, j bigint, value bigint"
    )
    sums = parts.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("i").alias("a"), F.col("j").alias("b")), F.struct(F.col("j").alias("a"), F.col("i").alias("b"))))
    both = sums.select("lang", ways.alias("w"), "value").select("lang", "w.a", "w.b", "value")
    own = groups.select("lang", F.col("idx").alias("a"), "source")
    other = groups.select("lang", F.col("idx").alias("b"), F.col("source").alias("item"))
    return both.join(own, ["lang", "a"]).join(other, ["lang", "b"]).select("lang", "source", "item", "value")


def _favoured(counts: DataFrame, texts: DataFrame, groups: DataFrame, best: int) -> DataFrame:
    """Rows (lang, source, item, value, rank) of the terms that a source favours over its language."""
    key = ["lang", "digest", "nth"]
    whole = counts.groupBy(*key).agg(F.sum("n").alias("lang_n"))
    sized = groups.select("lang", "source", "total", "kept", "lang_total")
    p = share(F.col("n"), F.col("total"), F.col("kept"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    shares = counts.join(whole, key).join(sized, ["lang", "source"]).select(*key, "source", p.alias("p"), q.alias("q"))
    more = shares.where("p > q").select(*key, "source", difference(F.col("p"), F.col("q")).alias("value"))
    group = Window.partitionBy("lang", "source")
    near = more.withColumn("at", F.rank().over(group.orderBy(F.col("value").desc()))).where(F.col("at") <= best)
    named = near.join(texts, key).select("lang", "source", F.col("term").alias("item"), "value")
    rank = F.row_number().over(group.orderBy(F.col("value").desc(), "item"))
    return named.withColumn("rank", rank).where(F.col("rank") <= best)


def audit(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = 10,
    best: int = 10,
    bits: int = 64,
    held_terms: int = 400_000,
    shard_rows: int = 200_000,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank); see the module."""
    shared = Shared(df.sparkSession)
    columns = {"lang": lang_col, "source": source_col, "text": text_col}
    docs = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for k, c in columns.items()))
    occurrences = shared.table(count_terms(docs, bits, held_terms))
    counts, texts = _kept_terms(occurrences, least_docs, shared)
    by_source = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("rows"))
    kept = texts.groupBy("lang").agg(F.count("*").alias("kept"))
    groups = docs.select("lang", "source").distinct().join(by_source, ["lang", "source"], "left")
    groups = groups.join(by_lang, "lang", "left").join(kept, "lang", "left").fillna(0)
    idx = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = shared.table(groups.withColumn("idx", idx))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    pairs = _pairs(counts, groups, shard_rows).withColumn("rank", place)
    terms = _favoured(counts, texts, groups, best)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(*columns)
        .unionByName(terms.withColumn("part", F.lit("term")).select(*columns))
    )
