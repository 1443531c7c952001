"""Near-duplicate embeddings by quantised tile products.

Method: unit vectors are rounded to int8 with one scale per vector; the length of what the
rounding took away is kept, in double precision. The integer product of two rounded vectors
then misses their cosine by at most ``e1 + e2 + e1 * e2``. Vectors are dealt into blocks, a
task multiplies two blocks tile by tile, and only pairs that the bound leaves possible are
computed again, in double precision, from the vectors as given. No pair at or above the
threshold can be lost, and pairs below it are never linked.

Equal vectors are one vector with a count. A task sends no pairs: per vector the number of
its links, and a chain that connects what is linked within the two blocks; components are
formed from the chains. The products themselves grow with the square of the number of
different vectors, which is the method's nature.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
have no links and are components of their own; vectors of different lengths never link; rows
that repeat an id count as one vector, the smallest in array order; a null id has no
component and is not kept; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.components import connected_components, spread, whole_groups
from courtside.llm.staging import Shared

_TILE = 2048


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times powers of two, with a largest component between 1/2 and 1, so that no square over- or underflows."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 vectors, their scales, and the lengths of the rounding errors, for unit rows."""
    scale = np.abs(unit).max(axis=1) / 127
    whole = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - whole * scale[:, None], axis=1)
    return whole, scale, error


def linked_pairs(
    left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...], threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of two tiles whose cosine reaches the threshold. Tiles: vectors, norms,
    int8 vectors, scales, errors."""
    (x, nx, qx, sx, ex), (y, ny, qy, sy, ey) = left, right
    # products of int8 numbers are exact in float32 up to 1,040 components, in float64 beyond
    kind = np.float32 if qx.shape[1] <= 1040 else np.float64
    upper = (qx.astype(kind) @ qy.astype(kind).T).astype(np.float32)
    upper *= sx.astype(np.float32)[:, None]
    upper *= sy.astype(np.float32)[None, :]
    upper += ex.astype(np.float32)[:, None]
    upper += ey.astype(np.float32)[None, :]
    # 1e-5 covers the float32 arithmetic of the bound itself
    i, j = np.nonzero(upper >= threshold - float(ex.max() * ey.max()) - 1e-5)
    kept = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 16):
        a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        kept[at : at + (1 << 16)] = np.einsum("nd,nd->n", x[a], y[b]) / (nx[a] * ny[b]) >= threshold
    return i[kept], j[kept]


def _links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Per vector of a pair of blocks: links into the other block, and the smallest vector reached."""
    for table in whole_groups(batches, ["dim", "low", "high"]):
        edges = np.column_stack([table.column(k).to_numpy() for k in ("dim", "low", "high")])
        bounds = np.flatnonzero(np.any(edges[1:] != edges[:-1], axis=1)) + 1
        for first, last in zip([0, *bounds], [*bounds, len(edges)]):
            group = table.slice(first, last - first).combine_chunks().to_batches()[0]
            dim, low, high = edges[first]
            ids, block = group.column("node").to_numpy(), group.column("block").to_numpy()
            times = group.column("times").to_numpy().astype(float)
            order = np.lexsort((ids, block))
            x = group.column("vector").flatten().to_numpy().astype(np.float64).reshape(-1, dim)[order]
            ids, block, times = ids[order], block[order], times[order]
            x = scaled(x)
            norm = np.linalg.norm(x, axis=1)
            parts = (x, norm, *quantise(x / norm[:, None]))
            split = int(np.searchsorted(block, low, "right"))
            rows, columns = ((0, split), (split, len(ids))) if low != high else ((0, len(ids)), (0, len(ids)))
            links, labels = np.zeros(len(ids)), np.arange(len(ids))
            for a in range(*rows, _TILE):
                b_from = columns[0] if low != high else a
                for b in range(b_from, columns[1], _TILE):
                    one, two = slice(a, min(a + _TILE, rows[1])), slice(b, min(b + _TILE, columns[1]))
                    i, j = linked_pairs(tuple(p[one] for p in parts), tuple(p[two] for p in parts), threshold)
                    i, j = i + a, j + b
                    if a == b:
                        i, j = i[i < j], j[i < j]
                    links += np.bincount(i, times[j], len(ids)) + np.bincount(j, times[i], len(ids))
                    labels = spread(labels, i, j)
            found = np.flatnonzero(links)
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[found]), pa.array(links[found].astype(np.int64)), pa.array(ids[labels[found]])],
                    ["node", "links", "root"],
                )


def near_duplicates(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.9,
    block: int = 8192,
) -> DataFrame:
    """One row per vector: the id, ``n_links``, ``component_id``, ``kept``."""
    shared = Shared(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.where("id IS NOT NULL").groupBy("id").agg(F.min("vector").alias("vector"))
    usable = (
        F.coalesce(F.size("vector"), F.lit(0)) > 0
    ) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(usable & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = shared.table(rows.select("id", F.when(usable, F.col("vector")).alias("vector")))
    good = rows.where("vector IS NOT NULL")
    classes = good.groupBy("vector").agg(F.min("id").alias("node"), F.count("*").alias("times"))
    classes = shared.table(classes.withColumn("dim", F.size("vector").cast("long")))
    blocks = max(1, -(-classes.count() // block))
    dealt = classes.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(blocks)))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "dim", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "times", "vector"
    )
    keys = ["dim", "low", "high"]
    tasks = blocks * (blocks + 1) // 2
    met = pairs.repartition(tasks, *keys).sortWithinPartitions(*keys)
    found = shared.table(
        met.mapInArrow(lambda batches: _links(batches, threshold), "node bigint, links bigint, root bigint")
    )
    chains = found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    components = connected_components(chains, shared)
    per_class = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.join(per_class, "node", "left").join(components, "node", "left")
    named = named.select(
        F.col("vector").alias("_v"),
        (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    hashed = named.withColumn("_h", F.xxhash64("_v"))
    mine = rows.withColumn("_h", F.xxhash64("vector"))
    joined = mine.join(hashed, (mine["_h"] == hashed["_h"]) & (F.col("vector") == F.col("_v")), "left")
    out = joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    nulls = df.where(F.col(id_col).isNull()).select(
        F.lit(None).cast("long").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id")
    )
    out = out.unionByName(nulls)
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
