"""Quality classifier: supervised subword embeddings.

Method: every word and every character n-gram of a text is hashed to a learned vector; a
document is the mean of its vectors, a softmax layer gives the classes, and numpy
stochastic gradient descent trains both. A word that repeats the one before it is one
further feature. As mean and layer are linear, scoring sums one number per feature.

Training uses at most ``sample`` labelled documents (those whose ids hash lowest), whole
texts; their hashed features, not their texts, come to the driver. Held-out documents, by
the fold of their id, are never used. Scoring covers all documents, without a shuffle.

Defined results: null, empty and white-space-only texts score 0; without any label every
other text scores the mean of no training, 0.5; a label row without a document, or with a
null label, is not used; several labels of one id count as the smallest, and of its texts the
smallest is learned from; repeated documents give repeated rows; texts of any length are read
whole, a word at a time; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.ngrams import HashedNgrams
from courtside.llm.staging import fold, sample_rows

ORDERS, BITS = (2, 3, 4), 16
REPEAT = 1 << BITS  # the feature of a repeated word


@dataclass
class Model:
    """What one feature adds to the evidence for label 1; the last entry is for repeats."""

    weight: np.ndarray
    bias: float


def _features(hashed: HashedNgrams, text: str | None) -> tuple[np.ndarray, np.ndarray, float]:
    """The buckets of a text, the share of each, and the share of repeated words."""
    counts, repeated = np.zeros(REPEAT, np.int64), 0
    for buckets, repeats in hashed.of_words((text or "").encode().split()):
        counts += np.bincount(buckets, minlength=REPEAT)
        repeated += repeats
    kept, total = np.flatnonzero(counts), max(1, int(counts.sum()) + repeated)
    return kept.astype(np.uint16), (counts[kept] / total).astype(np.float32), repeated / total


def _packed(text: Column) -> Column:
    @F.arrow_udf("struct<ids:binary,shares:binary,repeated:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashed = HashedNgrams(ORDERS, BITS, True)
        for batch in batches:
            found = [_features(hashed, t.as_py()) for t in batch]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([i.tobytes() for i, _, _ in found], pa.binary()),
                    pa.array([s.tobytes() for _, s, _ in found], pa.binary()),
                    pa.array([r for _, _, r in found], pa.float64()),
                ],
                ["ids", "shares", "repeated"],
            )

    return run(text)


def train(
    rows: list[tuple[np.ndarray, np.ndarray, float, int]], dim: int = 16, epochs: int = 10, rate: float = 0.5, seed: int = 1
) -> Model:
    """Vectors and layer from (buckets, their shares, share of repeats, label 0 or 1)."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (REPEAT + 1, dim)).astype(np.float32)
    layer, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    rows = [r for r in rows if len(r[0])]
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for at in rng.permutation(len(rows)):
            buckets, shares, repeated, label = rows[at]
            ids = np.append(buckets.astype(np.int64), REPEAT)
            share = np.append(shares, np.float32(repeated))
            mean = share @ vectors[ids]
            logits = layer @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            pace = rate * (1 - done / steps)
            back = p @ layer
            layer -= pace * np.outer(p, mean)
            bias -= pace * p
            # one feature's share is small: scale its step up to what a word in a short text gets
            vectors[ids] -= (pace * 20 * share)[:, None] * back
            done += 1
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float64), float(bias[1] - bias[0]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    held_out: int = 0,
    sample: int = 5000,
) -> Model:
    """The model of the labelled documents outside the held-out fold."""
    marked = labels.where((fold(F.col(id_col), folds) != held_out) & F.col(label_col).isin(0, 1))
    marked = marked.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_y"))
    marked = sample_rows(marked, "_id", sample)
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("_text"))
    # at most ``sample`` rows are broadcast
    found = texts.join(F.broadcast(marked), F.col("_doc") == F.col("_id"))
    # one row per id, the same however the rows lie
    found = found.groupBy("_doc").agg(F.min("_text").alias("_text"), F.min("_y").alias("_y"))
    packed = found.select("_doc", "_y", _packed(F.col("_text")).alias("_f")).select("_doc", "_y", "_f.*")
    rows = []
    for r in packed.toLocalIterator():  # at most ``sample`` rows, a partition at a time
        ids, shares = np.frombuffer(r["ids"], np.uint16), np.frombuffer(r["shares"], np.float32)
        rows.append((r["_doc"], ids, shares, r["repeated"], int(r["_y"])))
    rows.sort(key=lambda r: r[0])
    return train([r[1:] for r in rows])


def score(text: Column, model: Model) -> Column:
    """The probability of label 1."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashed = HashedNgrams(ORDERS, BITS, True)
        for batch in batches:
            scores = []
            for value in batch:
                total, count = 0.0, 0
                for buckets, repeats in hashed.of_words((value.as_py() or "").encode().split()):
                    total += float(model.weight[buckets].sum()) + repeats * float(model.weight[REPEAT])
                    count += len(buckets) + repeats
                scores.append(1 / (1 + np.exp(-np.clip(total / count + model.bias, -700, 700))) if count else 0.0)
            yield pa.array(scores, pa.float64())

    return run(text.cast("string"))


def classify(
    df: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 5,
    held_out: int = 0,
    threshold: float = 0.3,
) -> DataFrame:
    """One row per input row: the id, ``held_out``, ``score``, ``predicted``."""
    scored = df.select(
        F.col(id_col).alias(id_col),
        (fold(F.col(id_col), folds) == held_out).alias("held_out"),
        score(F.col(text_col), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
