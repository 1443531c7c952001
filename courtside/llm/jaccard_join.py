"""Near-duplicate texts: a Jaccard join on word shingles by chosen paths.

A text's set holds its runs of five words (lower-cased; a text of fewer words is one run).
Texts are linked when their sets overlap by 0.8 or more of their union.

Method. Each run starts one path; a path is continued by tokens (shingles) of the set that a
hash of path and token samples, at a rate inverse to the size of the set, so that two similar
sets expect to sample a shared token. Sets that chose the same path meet in its bucket.
The sets of buckets split further along their next sampled tokens; parts of at most ``bucket``
sets split once more, and what still meets is compared by brute force. From the second token
on, tokens are sampled from the set's sketch, the smallest shingle of each of 128 bins, which
travels with the set. A bucket of at most ``room`` sets splits within its task; only the
members of larger buckets are shuffled to the paths that they choose next. Within a task,
what most sets of a part share is not sampled, as it would not split them, so parts halve at
least. Where ``DEPTH`` shuffled tokens do not make a bucket small, it is compared as it is, in
tiles of bounded size, so no case is left out. Sets of one candidate group need no more of
their bucket, and a task holds one link per set that joins a group. Runs repeat until the chance to have missed a pair of similarity 0.8 is below
one minus ``recall`` (``runs_for``).

In buckets, sets are compared by size and by 128 one-byte minima of their hashes (a pair of
similarity 0.8 passes but for a chance below 1e-5). What passes forms candidate groups; then
the whole sets of each group meet, every pair of the group is compared exactly, and links
below the threshold do not exist. Equal sets are one set with a count, and groups send no
pairs but per text the number of its links and a chain through what is linked.

Groups and buckets beyond a bound are cut into blocks that meet pairwise, so no task holds
a group of unbounded size.

Defined results: texts without words (null, empty, signs only) link with nothing; a null id
has no class and no links; rows that repeat an id and text count as further copies; if one
id has several texts, their links are added up; further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.components import connected_components, spread, whole_groups
from courtside.llm.staging import Shared

_WORD = re.compile(r"\w+")
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BINS, DEPTH = 128, 16
#: Parts of at most so many sets are compared at once, without a look at whether they split.
FEW = 8
#: Children that a path of one set expects, over what two sets of the threshold need to share one.
OVERSAMPLE = 1.5
#: Least share of its bins in which a set of the threshold agrees with another (2.8 deviations below the mean).
AGREEING = 0.7
_BIN = np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of texts; remembers the hashes of words."""

    def __init__(self, width: int = 5, cache: int = 400_000):
        self.width, self.cache, self.known = width, cache, {}

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted distinct hashes of a text's shingles."""
        words = _WORD.findall((text or "").lower())
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > self.cache:
            self.known.clear()
        for word in set(words).difference(self.known):
            self.known[word] = int.from_bytes(_digest(word), "little")
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        n = len(words) - width + 1
        total = np.full(n, width, np.uint64)
        for k in range(width):
            total = mix(total + h[k : k + n])
        return np.unique(total)


def _digest(word: str) -> bytes:
    from xxhash import xxh3_64_digest

    return xxh3_64_digest(word.encode())


def sketch(shingles: np.ndarray) -> np.ndarray:
    """One byte for the smallest hash of each bin; 0 for an empty bin."""
    out = np.zeros(BINS, np.uint8)
    bins = (shingles >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    out[bins[first]] = 1 + (shingles[first] & np.uint64(0xFFFF)) % np.uint64(255)
    return out


def survival(levels: int = 64) -> float:
    """The least chance that one run keeps two sets of the threshold together for ``levels``."""
    p = 1.0
    for _ in range(levels):
        p = 1 - math.exp(-OVERSAMPLE * p)
    return p


def runs_for(recall: float) -> int:
    """Runs after which a pair of the threshold is missed with a chance of at most 1 - recall,
    however deep its buckets split."""
    return math.ceil(math.log(1 - recall) / math.log(1 - survival()))


def _limit(rate: np.ndarray | float) -> np.ndarray:
    """The largest hash that is sampled at a rate."""
    return np.minimum(np.asarray(rate) * 2.0**64, 2.0**64 - 1025).astype(np.uint64)


def first_paths(shingles: np.ndarray, runs: int, threshold: float) -> np.ndarray:
    """The paths of one token that a set chooses."""
    # sets of Jaccard similarity s share at least s of the larger one: just s if it contains the other
    limit = _limit(min(1.0, OVERSAMPLE / (threshold * max(1, len(shingles)))))
    parents = mix(np.arange(1, runs + 1, dtype=np.uint64) * _B)
    # shingles and paths are scrambled already: one odd multiplication pairs them
    i, j = np.nonzero((shingles[None, :] ^ parents[:, None]) * _A <= limit)
    return mix(mix(shingles[j] + parents[i]) ^ parents[i])


def sampling(sketches: np.ndarray) -> np.ndarray:
    """Per sketch the largest hash of a bin that a path samples."""
    used = np.maximum(1, np.count_nonzero(sketches, axis=1))
    return _limit(np.minimum(1.0, OVERSAMPLE / (AGREEING * used)))


def next_paths(paths: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers, and the path that the row's set chooses next. Rows: a path and a sketch."""
    hashes = mix(paths[:, None] ^ _BIN[None, :])
    i, b = np.nonzero((hashes <= sampling(sketches)[:, None]) & (sketches > 0))
    return i, mix(hashes[i, b] + sketches[i, b].astype(np.uint64))


def _signed(values: list[int] | np.ndarray) -> np.ndarray:
    return np.asarray(values, np.uint64).view(np.int64)


SETS = "node bigint, key_high bigint, key_low bigint, n bigint, sketch binary, first array<bigint>"


def _describe(docs: DataFrame, runs: int, threshold: float, width: int) -> DataFrame:
    """Per text: key of its set, size, sketch and chosen paths. ``docs``: node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                columns: list[list] = [[] for _ in range(6)]
                for node, text in zip(part.column(0).to_pylist(), part.column(1)):
                    s = shingler.shingles(text.as_py())
                    with np.errstate(over="ignore"):
                        high, low = mix(s).sum(), np.bitwise_xor.reduce(mix(s + _A)) + s.sum() * _B
                        chosen = first_paths(s, runs, threshold)
                    row = [node, *_signed([int(high), int(low)]).tolist(), len(s), sketch(s).tobytes(), _signed(chosen)]
                    for column, value in zip(columns, row):
                        column.append(value)
                kinds = [pa.int64()] * 4 + [pa.binary(), pa.list_(pa.int64())]
                names = [f.split()[0] for f in SETS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.mapInArrow(run, SETS)


def _possible(n1: np.ndarray, n2: np.ndarray, s1: np.ndarray, s2: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sizes and sketches leave the threshold possible; rows against rows."""
    same = np.count_nonzero((s1 == s2) & (s1 > 0), axis=-1)
    used = np.count_nonzero(s1 | s2, axis=-1)
    least = threshold * used - 4.5 * np.sqrt(used * threshold * (1 - threshold)) - 1
    return (np.minimum(n1, n2) >= threshold * np.maximum(n1, n2) - 1e-9) & (same >= least)


def _pairs(starts: np.ndarray, sizes: np.ndarray, at_once: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of positions within parts, about ``at_once`` at a time."""
    for size in np.unique(sizes[sizes > 1]):
        own = starts[sizes == size]
        if size > 256:
            for start in own:
                for k in range(start, start + size - 1):
                    yield np.full(start + size - 1 - k, k), np.arange(k + 1, start + size)
            continue
        i, j = np.triu_indices(size, 1)
        step = max(1, at_once // len(i))
        for at in range(0, len(own), step):
            base = own[at : at + step, None]
            yield (base + i).ravel(), (base + j).ravel()


def split_links(
    path: int, n: np.ndarray, sketches: np.ndarray, bucket: int, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate links (row numbers) that make the candidate groups of one bucket, which splits
    along sampled tokens of its sketches until its parts are small or one candidate group.

    What most rows of a part have in common would not split it, so such bins are not sampled,
    and the others at a rate that makes up for them. Rows that hold little else meet the whole
    part, and leave it. So every part has at most half the rows of the one that it came from.
    Pairs within a candidate group are neither compared nor returned.
    """
    used = np.count_nonzero(sketches, axis=1)
    labels = np.arange(len(n))

    def joined(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The possible ones of row pairs that are not in one candidate group, which they then are."""
        nonlocal labels
        ok = labels[a] != labels[b]
        ok &= np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b]) - 1e-9
        a, b = a[ok], b[ok]
        for at in range(0, len(a), 1 << 15):
            i, j = a[at : at + (1 << 15)], b[at : at + (1 << 15)]
            ok = _possible(n[i], n[j], sketches[i], sketches[j], threshold)
            if ok.any():
                labels = spread(labels, i[ok], j[ok])
                yield i[ok], j[ok]

    nothing = np.zeros(BINS, np.uint8)
    pending = [(np.arange(len(n)), np.zeros(1, int), np.array([path], np.uint64), 0, nothing)]
    while pending:
        rows, starts, paths, splits, common = pending.pop()
        sizes = np.diff(starts, append=len(rows))
        part = np.repeat(np.arange(len(sizes)), sizes)
        yield from joined(rows[starts][part], rows)
        open_ = np.minimum.reduceat(labels[rows], starts) < np.maximum.reduceat(labels[rows], starts)
        alone = len(starts) == 1 and sizes[0] > bucket
        if alone:
            common = nothing.copy()
            for b in range(BINS):
                times = np.bincount(sketches[rows, b], minlength=256)
                times[0] = 0
                common[b] = times.argmax() if 2 * times.max() > sizes[0] else 0
        held = np.concatenate(
            [np.count_nonzero((sketches[r] == common) & (common > 0), axis=1) for r in np.split(rows, range(4096, len(rows), 4096))]
        )
        left = AGREEING * used[rows] - held
        bound = left < OVERSAMPLE
        if alone and open_[0]:
            for k in np.flatnonzero(bound):
                met = rows[~bound | (np.arange(len(rows)) > k)]
                if len(met := met[labels[met] != labels[rows[k]]]):
                    yield from joined(np.full(len(met), rows[k]), met)
        elif not alone:
            whole = open_ & ((sizes <= FEW) | (splits > 1) | np.logical_or.reduceat(bound, starts))
            for i, j in _pairs(starts[whole], sizes[whole]):
                yield from joined(rows[i], rows[j])
            open_ &= ~whole
        going = np.flatnonzero(open_[part] & ~bound)
        limits = _limit(np.minimum(1.0, OVERSAMPLE / np.maximum(left[going], OVERSAMPLE)))
        found, onward = [np.zeros(0, int)], [np.zeros(0, np.uint64)]
        for at in range(0, len(going), 4096):
            own = going[at : at + 4096]
            values = sketches[rows[own]]
            hashes = mix(paths[part[own]][:, None] ^ _BIN[None, :])
            i, b = np.nonzero((hashes <= limits[at : at + 4096, None]) & (values > 0) & (values != common))
            found.append(rows[own[i]])
            onward.append(mix(hashes[i, b] + values[i, b].astype(np.uint64)))
        found, onward = np.concatenate(found), np.concatenate(onward)
        order = np.argsort(onward, kind="stable")
        found, onward = found[order], onward[order]
        starts = np.flatnonzero(np.concatenate([[True], onward[1:] != onward[:-1]])[: len(onward)])
        sizes = np.diff(starts, append=len(onward))
        for start, size in zip(starts[sizes > bucket], sizes[sizes > bucket]):
            pending.append((found[start : start + size], np.zeros(1, int), onward[start : start + 1], 0, nothing))
        few = (sizes > 1) & (sizes <= bucket)
        if few.any():
            kept = np.repeat(few, sizes)
            firsts = np.cumsum(sizes[few]) - sizes[few]
            pending.append((found[kept], firsts, onward[starts[few]], 1 if alone else splits + 1, common))


def _bucket_links(batches: Iterator[pa.RecordBatch], bucket: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Chains through the possible pairs of buckets, and of blocks of what does not split."""
    for table in whole_groups(batches, ["path", "low", "high"]):
        keys = np.column_stack([table.column(k).to_numpy() for k in ("path", "low", "high")])
        nodes, n, block = (table.column(k).to_numpy() for k in ("node", "n", "block"))
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
        starts = np.concatenate([[0], np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1])
        sizes = np.diff(starts, append=len(nodes))
        tiled = keys[starts, 2] > 0
        found: list[tuple[np.ndarray, np.ndarray]] = []
        few = (sizes <= 32) & ~tiled
        for size in np.unique(sizes[few]):
            i, j = np.triu_indices(size, 1)
            if not len(i):
                continue
            groups = starts[few & (sizes == size)]
            step = max(1, 100_000 // len(i))
            for at in range(0, len(groups), step):
                base = groups[at : at + step, None]
                a, b = (base + i).ravel(), (base + j).ravel()
                ok = _possible(n[a], n[b], sketches[a], sketches[b], threshold)
                found.append((a[ok], b[ok]))
        for start, size in zip(starts[~few & ~tiled], sizes[~few & ~tiled]):
            own = slice(start, start + size)
            path = int(np.int64(keys[start, 0]).view(np.uint64))
            with np.errstate(over="ignore"):
                found += [(a + start, b + start) for a, b in split_links(path, n[own], sketches[own], bucket, threshold)]
        for start, size in zip(starts[tiled], sizes[tiled]):
            end = start + size
            inner = keys[start, 1] == keys[start, 2]
            for a in range(start, end - 1):
                rest = np.arange(a + 1, end)
                rest = rest if inner else rest[block[rest] != block[a]]
                b = rest[_possible(n[a], n[rest], sketches[a], sketches[rest], threshold)]
                found.append((np.full(len(b), a), b))
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            labels = spread(np.arange(len(nodes)), a, b)
            at = np.flatnonzero(nodes != nodes[labels])
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(nodes[labels[at]])], ["a", "b"])


def _tiles(rows: DataFrame, blocks: str, *columns: str) -> DataFrame:
    """Every row in all pairs of blocks (low, high) that its block is part of."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col(blocks)))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    return dealt.withColumn("other", other).select(
        *columns, "node", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements every two sets share (upper triangle), by counting common bits."""
    m = len(sets)
    sizes = [len(s) for s in sets]
    values, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), sizes)
    shared = times > 1
    rank = np.cumsum(shared) - 1
    kept = shared[place]
    owner, column = owner[kept], rank[place[kept]]
    out = np.zeros((m, m), np.int32)
    width = 1 << 15
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for first in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [first, first + width])
        words = -(-min(width, int(shared.sum()) - first) // 64)
        bits = np.zeros((m, words), np.uint64)
        c = column[a:b] - first
        np.bitwise_or.at(bits, (owner[a:b], c >> 6), np.uint64(1) << (c & 63).astype(np.uint64))
        for i in range(m - 1):
            out[i, i + 1 :] += np.bitwise_count(bits[i] & bits[i + 1 :]).sum(axis=1, dtype=np.int32)
    return out


def _exact_links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Per text of two blocks of a group: exact links into the other block, smallest text reached."""
    for table in whole_groups(batches, ["group", "low", "high"]):
        keys = np.column_stack([table.column(k).to_numpy() for k in ("group", "low", "high")])
        starts = np.concatenate([[0], np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1])
        for first, last in zip(starts, [*starts[1:], len(keys)]):
            part = table.slice(first, last - first)
            nodes, block = part.column("node").to_numpy(), part.column("block").to_numpy()
            times = part.column("times").to_numpy().astype(float)
            sets = [np.frombuffer(s, np.uint64) for s in part.column("shingles").to_pylist()]
            order = np.argsort(nodes, kind="stable")
            nodes, block, times, sets = nodes[order], block[order], times[order], [sets[k] for k in order]
            n = np.array([len(s) for s in sets])
            both = _intersections(sets)
            union = n[:, None] + n[None, :] - both
            linked = np.triu(both >= threshold * union - 1e-9, 1) & (nodes[:, None] != nodes[None, :])
            if keys[first][1] != keys[first][2]:
                linked &= block[:, None] != block[None, :]
            i, j = np.nonzero(linked)
            links = np.bincount(i, times[j], len(nodes)) + np.bincount(j, times[i], len(nodes))
            labels = spread(np.arange(len(nodes)), i, j)
            at = np.flatnonzero(links)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[at]), pa.array(links[at].astype(np.int64)), pa.array(nodes[labels[at]])],
                    ["node", "links", "root"],
                )


def _with_shingles(docs: DataFrame, width: int) -> DataFrame:
    """``docs`` (node, group, blocks, times, text) with the set of each text instead of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingler.shingles(t.as_py()).tobytes() for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in ("node", "group", "blocks", "times")] + [pa.array(sets, pa.binary())],
                    ["node", "group", "blocks", "times", "shingles"],
                )

    return docs.mapInArrow(run, "node bigint, group bigint, blocks bigint, times bigint, shingles binary")


def _pivot_links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of texts to the pivots of their buckets, where possible."""
    for batch in batches:
        column = {name: batch.column(name) for name in ("node", "pivot", "n", "pivot_n")}
        node, pivot, n, pivot_n = (c.to_numpy() for c in column.values())
        own, other = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS)
            for c in ("sketch", "pivot_sketch")
        )
        ok = np.flatnonzero(_possible(n, pivot_n, own, other, threshold))
        yield pa.RecordBatch.from_arrays([pa.array(node[ok]), pa.array(pivot[ok])], ["a", "b"])


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The next paths of sets (node, path, sketch)."""
    for batch in batches:
        sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
        paths = batch.column("path").to_numpy().view(np.uint64)
        for at in range(0, len(paths), 4096):
            with np.errstate(over="ignore"):
                i, chosen = next_paths(paths[at : at + 4096], sketches[at : at + 4096])
            node = batch.column("node").to_numpy()[at + i]
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(chosen.view(np.int64))], ["node", "path"])


def _compared(buckets: DataFrame, sketches: DataFrame, bucket: int, threshold: float) -> DataFrame:
    """Candidate links (a, b) of buckets (path, block, low, high, node)."""
    keys = ["path", "low", "high"]
    met = buckets.join(sketches, "node").repartition(*keys).sortWithinPartitions(*keys)
    return met.mapInArrow(lambda batches: _bucket_links(batches, bucket, threshold), "a bigint, b bigint")


def _candidates(
    sets: DataFrame, bucket: int, room: int, block: int, threshold: float, shared: Shared, depth: int = DEPTH
) -> DataFrame:
    """Candidate links (a, b) from all runs.

    The members of a bucket beyond ``room`` are first compared with one of them. A bucket
    whose members are all in one candidate group by then can add nothing and is left; so a
    large group of near copies, which no further token would split, is not carried on.
    """
    sketches = sets.select("node", "n", "sketch")
    none = [F.lit(0).cast("long").alias(k) for k in ("block", "low", "high")]
    nodes = sets.select("node", F.explode("first").alias("path"))
    links, groups = [], None
    for level in range(1, depth + 1):
        sizes = nodes.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        met = shared.table(nodes.join(sizes, "path"))
        found = _compared(met.where(F.col("size") <= room).select("path", *none, "node"), sketches, bucket, threshold)
        links.append(shared.table(found))
        large = met.where(F.col("size") > room)
        if large.isEmpty():
            shared.drop(met)
            break
        if groups is None:
            pivots = large.groupBy("path").agg(F.min("node").alias("pivot"))
            named = sketches.select(
                F.col("node").alias("pivot"), F.col("n").alias("pivot_n"), F.col("sketch").alias("pivot_sketch")
            )
            pairs = large.join(sketches, "node").join(pivots.join(named, "pivot"), "path").where("node <> pivot")
            starred = pairs.mapInArrow(lambda batches: _pivot_links(batches, threshold), "a bigint, b bigint")
            links.append(shared.table(starred))
            groups = shared.table(connected_components(links[0].unionByName(links[1]), shared))
        grouped = large.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
        mixed = grouped.groupBy("path").agg(F.min("group").alias("one"), F.max("group").alias("other"))
        large = shared.table(large.join(mixed.where("one <> other"), "path", "left_semi"))
        shared.drop(met)
        if level == depth:
            tiled = _tiles(large.withColumn("blocks", F.ceil(F.col("size") / block)), "blocks", "path")
            # blocks from 1 on: bucket 0, 0 is one that splits in its task
            apart = [F.col("block") + 1, F.col("low") + 1, F.col("high") + 1]
            tiled = tiled.select("path", *(c.alias(k) for c, k in zip(apart, ("block", "low", "high"))), "node")
            links.append(shared.table(_compared(tiled, sketches, bucket, threshold)))
            break
        nodes = large.join(sketches, "node").select("node", "path", "sketch").mapInArrow(_children, "node bigint, path bigint")
    return reduce(DataFrame.unionByName, links)


def similar_texts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    width: int = 5,
    recall: float = 0.9995,
    bucket: int = 100,
    room: int = 1 << 16,
    block: int = 1024,
    block_shingles: int = 1 << 20,
) -> DataFrame:
    """One row per input row: the id, ``class_id`` (the smallest id that links reach) and ``n_links``."""
    shared = Shared(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("string").alias("text"))
    docs = docs.where("node IS NOT NULL")
    described = shared.table(_describe(docs, runs_for(recall), threshold, width))
    key = ["key_high", "key_low"]
    worded = described.where("n > 0")
    classes = shared.table(worded.groupBy(*key).agg(F.min("node").alias("node"), F.count("*").alias("times")))
    # one row per different set: the row of the class's smallest id
    sets = worded.join(classes.select(*key, "node"), [*key, "node"], "left_semi").dropDuplicates([*key])
    sets = shared.table(sets)
    candidates = _candidates(sets, bucket, room, block, threshold, shared)
    groups = shared.table(connected_components(candidates, shared))
    sizes = groups.join(sets.select("node", "n"), "node").groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / block_shingles)).alias("blocks")
    )
    times = classes.groupBy("node").agg(F.max("times").alias("times"))
    members = groups.join(sizes, "component").join(times, "node").select(
        "node", F.col("component").alias("group"), "blocks", "times"
    )
    texts = docs.join(members, "node").select("node", "group", "blocks", "times", "text")
    whole = _with_shingles(texts, width)
    tiled = _tiles(whole, "blocks", "group", "times", "shingles")
    keys = ["group", "low", "high"]
    met = tiled.repartition(*keys).sortWithinPartitions(*keys)
    found = shared.table(
        met.mapInArrow(lambda batches: _exact_links(batches, threshold), "node bigint, links bigint, root bigint")
    )
    chains = found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    components = connected_components(chains, shared)
    per_class = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.join(per_class, "node", "left").join(components, "node", "left").select(
        *key,
        F.coalesce("component", "node").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
    )
    out = worded.select("node", *key).join(named, key).select(F.col("node").alias(id_col), "class_id", "n_links")
    own = [F.lit(0).cast("long").alias("n_links")]
    wordless = described.where("n = 0").select(F.col("node").alias(id_col), F.col("node").alias("class_id"), *own)
    none = F.lit(None).cast("long")
    nulls = df.where(F.col(id_col).isNull()).select(none.alias(id_col), none.alias("class_id"), *own)
    return out.unionByName(wordless).unionByName(nulls)
