"""Language identification: sparse multinomial logistic regression on character n-grams.

Method: character n-grams of lower-cased letters, weighted by relative frequency times
inverse document frequency; one-against-all-classes softmax weights trained by
follow-the-regularised-leader with elastic-net penalties, which sets most weights to 0;
then one temperature, fitted on sample rows that training left out, calibrates the
probabilities.

Document frequencies are counted over all documents that may be learned from, in Spark. The
weights are fitted on at most ``sample`` of them (ids that hash lowest), whole texts. Only
text and non-null languages of documents outside the held-out fold are used.

Defined results: a text that is null or has no letter (of Unicode; numerals are none) gets
``und`` and score 0; with no document to learn from, every text gets ``und`` and score 0; ties
go to the language that sorts first; repeated documents give repeated rows; of an id with
several texts the smallest may be in the sample, however the rows lie; texts of any length
are read whole, a word at a time; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.ngrams import HashedNgrams
from courtside.llm.staging import fold, sample_rows

ORDERS, BITS = (2, 3, 4), 15
_NO_LETTERS = regex.compile(r"\P{L}+")
#: Brings relative frequencies, which are small, to the order of 1.
_SCALE = 100.0


@dataclass
class Model:
    """languages: sorted. weight: per bucket and language, idf and temperature included."""

    languages: list[str]
    weight: np.ndarray
    bias: np.ndarray


def _letters(text: str | None) -> list[bytes]:
    """The words of letters of a text, lower-cased."""
    return _NO_LETTERS.sub(" ", (text or "").lower()).encode().split()


def _counts(hashed: HashedNgrams, text: str | None) -> np.ndarray:
    counts = np.zeros(hashed.size, np.int64)
    for buckets, _ in hashed.of_words(_letters(text)):
        counts += np.bincount(buckets, minlength=hashed.size)
    return counts


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and how many texts there are.

    Every task adds up its texts and sends a row per bucket; Spark adds those, so the driver
    gets as many rows as there are buckets.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = HashedNgrams(ORDERS, BITS, False)
        total, n = np.zeros(hashed.size, np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                total += _counts(hashed, value.as_py()) > 0
                n += 1
        buckets = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(buckets, -1)), pa.array(np.append(total[buckets], n))], ["bucket", "n"]
        )

    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "bucket bigint, n bigint")
    out, n = np.zeros(1 << BITS), 0
    for bucket, count_ in rows.groupBy("bucket").agg(F.sum("n")).collect():
        if bucket < 0:
            n = count_
        else:
            out[bucket] = count_
    return out, n


def _packed(text: Column) -> Column:
    @F.arrow_udf("struct<ids:binary,shares:binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashed = HashedNgrams(ORDERS, BITS, False)
        for batch in batches:
            ids, shares = [], []
            for value in batch:
                counts = _counts(hashed, value.as_py())
                kept = np.flatnonzero(counts)
                ids.append(kept.astype(np.uint16).tobytes())
                shares.append((counts[kept] / max(1, counts.sum())).astype(np.float32).tobytes())
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(shares, pa.binary())], ["ids", "shares"])

    return run(text)


def follow_the_leader(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    classes: int,
    size: int,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.05,
    epochs: int = 3,
    seed: int = 1,
) -> np.ndarray:
    """Weights (size, classes) by the proximal form of the method; rows: ids, values, class."""
    z, n = np.zeros((size, classes)), np.zeros((size, classes))

    def weights(ids: np.ndarray) -> np.ndarray:
        zi = z[ids]
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[ids])) / alpha + l2)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for at in rng.permutation(len(rows)):
            ids, values, label = rows[at]
            ids = ids.astype(np.int64)
            w = weights(ids)
            p = _softmax(values @ w)
            p[label] -= 1
            g = values[:, None] * p
            squared = n[ids]
            z[ids] += g - (np.sqrt(squared + g * g) - np.sqrt(squared)) / alpha * w
            n[ids] += g * g
    return weights(np.arange(size))


def _softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max())
    return p / p.sum()


def temperature(logits: list[np.ndarray], labels: list[int]) -> float:
    """The temperature under which the labels are likeliest, by golden-section search."""
    if not logits:
        return 1.0
    table, at = np.array(logits), np.array(labels)

    def loss(log_t: float) -> float:
        scaled = table / np.exp(log_t)
        scaled -= scaled.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(scaled).sum(axis=1)) - scaled[np.arange(len(at)), at]))

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 3,
    held_out: int = 1,
    sample: int = 5000,
) -> Model:
    """The model of the documents with a language outside the held-out fold."""
    known = docs.where((fold(F.col(id_col), folds) != held_out) & F.col(lang_col).isNotNull())
    known = known.select(
        F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), F.col(lang_col).cast("string").alias("_lang")
    )
    df, n = document_frequencies(known, "_text")
    idf = np.log((1 + n) / (1 + df))
    chosen = sample_rows(known, "_id", sample).select("_id", "_lang", _packed(F.col("_text")).alias("_f"))
    raw = []
    for r in chosen.select("_id", "_lang", "_f.*").toLocalIterator():  # at most ``sample`` rows, a partition at a time
        ids, shares = np.frombuffer(r["ids"], np.uint16), np.frombuffer(r["shares"], np.float32)
        if len(ids):
            # the last feature is the bias
            values = np.append(shares * idf[ids] * _SCALE, 1.0).astype(np.float32)
            raw.append((r["_id"], r["_lang"], np.append(ids, np.uint16(len(idf))), values))
    raw.sort(key=lambda r: r[:2])
    languages = sorted({r[1] for r in raw})
    number = {lang: k for k, lang in enumerate(languages)}
    rows = [(ids, values, number[lang]) for _, lang, ids, values in raw]
    if not rows:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0))
    held = [row for at, row in enumerate(rows) if at % 5 == 0]
    trained = [row for at, row in enumerate(rows) if at % 5] or rows
    w = follow_the_leader(trained, len(languages), (1 << BITS) + 1)
    heat = temperature([v @ w[i] for i, v, _ in held], [k for _, _, k in held])
    return Model(languages, w[:-1] * idf[:, None] * (_SCALE / heat), w[-1] / heat)


def predict(text: Column, model: Model) -> Column:
    """A struct of ``lang_pred`` and ``score``, the calibrated probability of that language."""

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashed = HashedNgrams(ORDERS, BITS, False)
        for batch in batches:
            langs, scores = [], []
            for value in batch:
                total, count = np.zeros(len(model.languages)), 0
                for buckets, _ in hashed.of_words(_letters(value.as_py())):
                    used, times = np.unique(buckets, return_counts=True) if len(buckets) > 20_000 else (buckets, None)
                    rows = model.weight[used]
                    total += rows.sum(axis=0) if times is None else times @ rows
                    count += len(buckets)
                if count and model.languages:
                    p = _softmax(total / count + model.bias)
                    best = int(np.argmax(p))
                    langs.append(model.languages[best])
                    scores.append(float(p[best]))
                else:
                    langs.append("und")
                    scores.append(0.0)
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
            )

    return run(text.cast("string"))


def identify(
    df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held_out: int = 1
) -> DataFrame:
    """One row per input row: the id, ``held_out``, ``lang_pred``, ``score``."""
    done = df.select(
        F.col(id_col).alias(id_col),
        (fold(F.col(id_col), folds) == held_out).alias("held_out"),
        predict(F.col(text_col), model).alias("_p"),
    )
    return done.select(id_col, "held_out", "_p.lang_pred", "_p.score")
