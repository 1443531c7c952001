"""Connected components of links, and whole groups from sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.staging import Shared


def connected_components(links: DataFrame, shared: Shared) -> DataFrame:
    """Rows (node, component) for all ends of ``links`` (columns a, b); a component is named
    by its smallest node.

    Alternates two steps until nothing changes: every node hands its larger neighbours to the
    smallest node it knows, then its smaller ones. Minima are combined before the shuffle and
    every round is staged; the driver sees only a count and a checksum of each round.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v")
    edges, mark = shared.table(edges.distinct()), None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == tuple(seen) or not seen[0]:
            break
        mark = tuple(seen)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = shared.table(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        shared.drop(edges)
        edges = following
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by integer ``keys``."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        if held and last != tuple(c[0] for c in columns):
            yield pa.Table.from_batches(held)
            held = []
        last = tuple(c[-1] for c in columns)
        other = np.zeros(batch.num_rows, bool)
        for c, end in zip(columns, last):
            other |= c != end
        cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def spread(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after the links i-j: every row gets the smallest row that it can reach."""
    while len(i):
        a, b = labels[i], labels[j]
        open_ = a != b
        if not open_.any():
            break
        i, j, low, high = i[open_], j[open_], np.minimum(a, b)[open_], np.maximum(a, b)[open_]
        np.minimum.at(labels, high, low)
        while True:
            shorter = labels[labels]
            if np.array_equal(shorter, labels):
                break
            labels = shorter
    return labels
