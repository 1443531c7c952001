"""Language model scoring with a hidden Markov model.

Tokens are the words of a text (A-Z lower-cased, cut at white space) and one end token. The
model: hidden states emit word classes, and a class emits its words by their smoothed counts
in all training texts. A class is the hash of a word's last three bytes, so short words
have classes of their own and longer ones share those of their endings; the end token has
its own class. Within a class every word has count + 1, and one further share is for words
that training has not seen, so the probabilities of all texts of a length sum to 1.

Method.

1. Documents are read once and written as chunks: token numbers of many texts, and the
   chunk's own dictionary with the training counts of its words.
2. Dictionaries are added up over all training documents by a shuffle on the word. The
   table of counts has a row per word and never leaves Spark.
3. Baum-Welch: tasks run the scaled forward and backward recursions over their chunks and
   send expected counts, a row per state and class; Spark adds them, and the driver, which
   gets as many rows as the model has parameters, forms the next model. Every round sees all
   training texts, so the model does not depend on how they lie in chunks and partitions.
   The texts of a chunk lie end to end in lanes that advance together, in tiles of steps that
   fit a processor's cache: the probabilities of states of one tile are held, not of a text.
4. The counts of each dictionary's words come back to their chunk by a join, and the scaled
   forward recursion gives every text's exact probability.

Defined results: null and empty texts consist of the end token; repeated rows give repeated
rows; with no training text all counts are 0 and the model is uniform; further columns are
not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.staging import Shared, fold

END = b""
_LN10 = float(np.log(10))

CHUNKS = (
    "chunk string, ids binary, keys array<string>, lengths binary, held binary, "
    "words array<binary>, counts array<bigint>, classes binary"
)


def word_class(word: bytes, classes: int) -> int:
    """0 for the end token, otherwise the hash of the last three bytes."""
    return 0 if word == END else 1 + zlib.crc32(word[-3:]) % (classes - 1)


def pack(numbers: np.ndarray) -> bytes:
    """Int32 numbers as four rows of bytes; the upper rows, nearly all 0, compress to nothing."""
    return np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    """The numbers that ``pack`` was given."""
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def chunk_texts(docs: DataFrame, classes: int, tokens: int) -> DataFrame:
    """Rows of ``CHUNKS``: about ``tokens`` tokens each, whole texts. ``docs``: key, text, held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        ids, keys, lengths, held, size, made = [], [], [], [], 0, 0

        def out() -> pa.RecordBatch:
            words = list(number)
            flat = np.concatenate(ids)
            training = np.repeat(~np.array(held, bool), lengths)
            counts = np.bincount(flat[training], minlength=len(words))
            kinds = np.fromiter((word_class(w, classes) for w in words), np.int32, len(words))
            name = f"{task}-{made}-{keys[0]}"
            return pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([name], pa.string()),
                    "ids": pa.array([pack(flat)], pa.binary()),
                    "keys": pa.array([keys], pa.list_(pa.string())),
                    "lengths": pa.array([np.array(lengths, np.int64).tobytes()], pa.binary()),
                    "held": pa.array([np.array(held, np.int8).tobytes()], pa.binary()),
                    "words": pa.array([words], pa.list_(pa.binary())),
                    "counts": pa.array([counts], pa.list_(pa.int64())),
                    "classes": pa.array([pack(kinds)], pa.binary()),
                }
            )

        from pyspark import TaskContext

        context = TaskContext.get()
        task = context.partitionId() if context else 0
        for batch in batches:
            for key, text, out_of_training in zip(batch.column(0), batch.column(1), batch.column(2)):
                found = (text.as_py() or "").encode().lower().split()  # at the white space of ASCII
                found.append(END)
                for word in set(found).difference(number):
                    number[word] = len(number)
                ids.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
                keys.append(key.as_py())
                lengths.append(len(found))
                held.append(out_of_training.as_py())
                size += len(found)
                if size >= tokens:
                    yield out()
                    made += 1
                    number.clear()
                    ids, keys, lengths, held, size = [], [], [], [], 0
        if ids:
            yield out()

    return docs.mapInArrow(run, CHUNKS)


@dataclass
class Hidden:
    """start (K), step (K, K), emit (K, C): probabilities of states and classes."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray


def first_model(states: int, classes: int, seed: int = 1) -> Hidden:
    """States that tend to stay, with emissions near uniform."""
    rng = np.random.default_rng(seed)
    step = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(step, 0.9 if states > 1 else 1.0)
    emit = rng.gamma(2.0, 1.0, (states, classes))
    return Hidden(np.full(states, 1 / states), step, emit / emit.sum(axis=1, keepdims=True))


LANES = 512  # sequences side by side
TILE = 1 << 14  # steps times lanes whose states are held at once
RESCALE = 8  # steps between two scalings; products of so few stay far above the smallest double


@dataclass
class Lanes:
    """Class sequences laid end to end in lanes, so that one step serves all lanes at once.

    ``grid``: classes by step and lane, longest lane first, a class more where a lane has ended.
    ``owner``: the sequence of each lane at every step that scales. ``begin`` and ``end``: rows
    of steps, lanes and sequences of all first and all last symbols, by step.
    """

    grid: np.ndarray
    loads: np.ndarray
    owner: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def live(self, at: int, size: int) -> list[int]:
        """How many lanes reach each of ``size`` steps."""
        return np.searchsorted(-self.loads, -np.arange(at, at + size)).tolist()


def _lanes(sequences: list[np.ndarray], pad: int) -> Lanes:
    """As few steps as the longest sequence and ``LANES`` allow; long sequences are placed first."""
    lengths = np.array([len(s) for s in sequences])
    steps = max(int(lengths.max()), -(-int(lengths.sum()) // LANES))
    lanes: list[tuple[int, int, list[int]]] = [(0, i, []) for i in range(-(-int(lengths.sum()) // steps))]
    for j in np.argsort(-lengths, kind="stable").tolist():
        load, i, own = lanes[0]
        own.append(j)
        heapq.heapreplace(lanes, (load + len(sequences[j]), i, own))
    lanes.sort(key=lambda lane: -lane[0])
    loads = np.array([load for load, _, _ in lanes])
    grid = np.full((len(lanes), loads[0]), pad, np.int32)
    owner = np.zeros((len(lanes), loads[0] // RESCALE), np.int32)
    begin, end = [], []
    for i, (load, _, own) in enumerate(lanes):
        grid[i, :load] = np.concatenate([sequences[j] for j in own])
        owner[i, : load // RESCALE] = np.repeat(own, lengths[own])[RESCALE - 1 :: RESCALE]
        ends = np.cumsum(lengths[own])
        begin.append(np.stack([ends - lengths[own], np.full(len(own), i), own]))
        end.append(np.stack([ends - 1, np.full(len(own), i), own]))
    begin, end = (x[:, np.argsort(x[0], kind="stable")] for x in (np.hstack(begin), np.hstack(end)))
    return Lanes(np.ascontiguousarray(grid.T), loads, np.ascontiguousarray(owner.T), begin, end)


def _cuts(events: np.ndarray, at: int, size: int) -> list[int]:
    """Where the events of each of ``size`` steps begin, and where the last ones end."""
    return np.searchsorted(events[0], np.arange(at, at + size + 1)).tolist()


class _Recursions:
    """Scaled forward recursion over lanes, tile by tile, a tile being some steps of all lanes.

    Only the states before each tile are kept; ``tile`` computes one tile again.
    """

    def __init__(self, lanes: Lanes, model: Hidden):
        self.lanes, self.model = lanes, model
        (steps, n), states = lanes.grid.shape, len(model.start)
        self.size = max(1, min(steps, TILE // n))
        self.table = np.hstack([model.emit, np.zeros((states, 1))])
        self.onward = np.ascontiguousarray(model.step.T)
        # a step is one block of memory, a row per state: numpy's loops then run over the lanes
        self.emit = np.zeros((self.size, states, n))
        self.alphas = np.zeros((self.size + 1, states, n))
        self.scales = np.ones((steps // RESCALE, n))
        self.sums = np.ones(lanes.end.shape[1])
        self.before = []
        for at in range(0, steps, self.size):
            self.before.append(self.alphas[0].copy())
            size = self.tile(at, self.before[-1])
            a, b = (int(x) for x in np.searchsorted(lanes.end[0], (at, at + size)))
            last, lane, _ = lanes.end[:, a:b]
            self.sums[a:b] = self.alphas[last - at + 1, :, lane].sum(axis=1)
            self.alphas[0] = self.alphas[size]

    def tile(self, at: int, before: np.ndarray) -> int:
        """Fill ``emit`` and ``alphas`` from step ``at`` on; the number of steps."""
        lanes, start, emit, alphas = self.lanes, self.model.start, self.emit, self.alphas
        grid, n = lanes.grid[at : at + self.size].astype(np.intp), lanes.grid.shape[1]
        size = len(grid)
        for state, row in enumerate(self.table):
            emit[:size, state] = row.take(grid)
        alphas[0] = before
        cuts = _cuts(lanes.begin, at, size)
        for i, k in enumerate(lanes.live(at, size)):
            earlier, alpha, factor = alphas[i], alphas[i + 1], emit[i]
            if k < n:
                earlier, alpha, factor = earlier[:, :k], alpha[:, :k], factor[:, :k]
            np.matmul(self.onward, earlier, out=alpha)
            if cuts[i] < cuts[i + 1]:
                alpha.T[lanes.begin[1, cuts[i] : cuts[i + 1]]] = start
            alpha *= factor
            if (at + i) % RESCALE == RESCALE - 1:
                scale = self.scales[(at + i) // RESCALE, :k]
                np.add.reduce(alpha, axis=0, out=scale)
                alpha /= scale
        return size

    def logs(self) -> np.ndarray:
        """Natural log of each sequence's probability."""
        logs = np.zeros(len(self.sums))
        logs[self.lanes.end[2]] = np.log(self.sums)
        return logs + np.bincount(self.lanes.owner.ravel(), np.log(self.scales).ravel(), len(logs))


def forward(sequences: list[np.ndarray], model: Hidden) -> np.ndarray:
    """Natural log of each class sequence's probability."""
    return _Recursions(_lanes(sequences, model.emit.shape[1]), model).logs()


def expected(sequences: list[np.ndarray], model: Hidden, sums: Hidden) -> float:
    """Add the expected counts of class sequences to ``sums``; their log probability."""
    states, classes = model.emit.shape
    lanes = _lanes(sequences, classes)
    run = _Recursions(lanes, model)
    steps, n = lanes.grid.shape
    ones = 1 / run.sums[:, None]  # backward probability of last symbols, in scale with the forward one
    betas, carry = np.zeros((run.size, states, n)), np.zeros((states, n))
    for at in reversed(range(0, steps, run.size)):
        size = run.tile(at, run.before.pop())
        emit, alphas = run.emit[:size], run.alphas[: size + 1]
        betas[size - 1] = carry
        cuts, live = _cuts(lanes.end, at, size), lanes.live(at, size)
        for i in range(size - 1, -1, -1):
            k, beta, back, earlier = live[i], betas[i], emit[i], betas[i - 1] if i else carry
            if k < n:
                beta, back, earlier = beta[:, :k], back[:, :k], earlier[:, :k]
            if cuts[i] < cuts[i + 1]:
                beta.T[lanes.end[1, cuts[i] : cuts[i + 1]]] = ones[cuts[i] : cuts[i + 1]]
            # from here ``emit`` becomes emission times backward probability
            back *= beta
            if (at + i) % RESCALE == RESCALE - 1:
                back /= run.scales[(at + i) // RESCALE, :k]
            np.matmul(model.step, back, out=earlier)
        gamma = betas[:size]
        gamma *= alphas[1:]
        a, b = (int(x) for x in np.searchsorted(lanes.begin[0], (at, at + size)))
        first, lane, _ = lanes.begin[:, a:b]
        sums.start += gamma[first - at, :, lane].sum(axis=0)
        emit[first - at, :, lane] = 0  # nothing steps into a first symbol
        sums.step += np.matmul(alphas[:-1], emit.transpose(0, 2, 1)).sum(axis=0) * model.step
        flat = lanes.grid[at : at + size].ravel().astype(np.intp)
        for state in range(states):
            sums.emit[state] += np.bincount(flat, gamma[:, state].ravel(), classes + 1)[:classes]
    return float(run.logs().sum())


def _round(chunks: DataFrame, model: Hidden) -> Hidden:
    """Expected counts over the training texts of all chunks."""
    states, classes = model.emit.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Hidden(np.zeros(states), np.zeros((states, states)), np.zeros((states, classes)))
        for batch in batches:
            for row in batch.to_pylist():
                ids, kinds = unpack(row["ids"]), unpack(row["classes"])
                lengths = np.frombuffer(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                chosen = np.flatnonzero(np.frombuffer(row["held"], np.int8) == 0)
                symbols = kinds[ids]
                if len(chosen):
                    expected([symbols[ends[t] - lengths[t] : ends[t]] for t in chosen], model, sums)
        values = np.concatenate([sums.start, sums.step.ravel(), sums.emit.ravel()])
        at = np.flatnonzero(values)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(values[at])], ["at", "n"])

    needed = chunks.select("ids", "lengths", "held", "classes")
    rows = needed.mapInArrow(run, "at bigint, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
    values = np.zeros(states + states * states + states * classes)
    for r in rows:
        values[r["at"]] = r["n"]
    start, rest = values[:states], values[states:]
    return Hidden(start, rest[: states * states].reshape(states, states), rest[states * states :].reshape(states, classes))


def _normal(sums: Hidden) -> Hidden:
    """The model that expected counts stand for, with a little weight on everything."""

    def rows(table: np.ndarray, extra: float) -> np.ndarray:
        return (table + extra) / (table + extra).sum(axis=-1, keepdims=True)

    return Hidden(rows(sums.start, 0.1), rows(sums.step, 0.1), rows(sums.emit, 0.01))


def baum_welch(chunks: DataFrame, states: int, classes: int, rounds: int = 6) -> Hidden:
    """The trained model, after ``rounds`` rounds over all training texts."""
    model = first_model(states, classes)
    for _ in range(rounds):
        model = _normal(_round(chunks, model))
    return model


def score_texts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 7,
    held_out: int = 2,
    states: int = 8,
    classes: int = 2048,
    chunk_tokens: int = 1_500_000,
) -> DataFrame:
    """One row per input row: the id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (log10 of the smoothed unigram probability), ``score`` (log10 of the model's
    probability)."""
    shared = Shared(df.sparkSession)
    docs = df.select(
        F.col(id_col).cast("string").alias("key"),
        F.col(text_col).cast("string").alias("text"),
        (fold(F.col(id_col), folds) == held_out).alias("held"),
    )
    chunks = shared.table(chunk_texts(docs, classes, chunk_tokens))
    entries = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "_e"))
    words = entries.select("chunk", "at", F.col("_e.words").alias("word"), F.col("_e.counts").alias("n"))
    counts = shared.table(words.groupBy("word").agg(F.sum("n").alias("c")))
    known = counts.where("c > 0")
    suffix = F.substring(F.col("word"), F.greatest(F.octet_length("word") - 2, F.lit(1)), F.lit(3))
    per_class = known.groupBy(
        F.when(F.octet_length("word") == 0, 0).otherwise(1 + F.crc32(suffix) % (classes - 1)).alias("class")
    ).agg(F.sum("c").alias("n"), F.count("*").alias("v"))
    mass = np.zeros((classes, 2))
    for r in per_class.collect():  # at most one row per class
        mass[r["class"]] = r["n"], r["v"]
    total, distinct = int(mass[:, 0].sum()), int(mass[:, 1].sum())
    model = baum_welch(chunks, states, classes)
    back = words.join(counts, "word").groupBy("chunk").agg(F.collect_list(F.struct("at", "c")).alias("found"))
    ready = chunks.select("chunk", "ids", "keys", "lengths", "held", "classes").join(back, "chunk")
    share = np.log(mass.sum(axis=1) + 1)
    return _scored(ready, model, share, total, distinct, df.schema[id_col].dataType.simpleString(), id_col)


def _scored(
    ready: DataFrame, model: Hidden, share: np.ndarray, total: int, distinct: int, key_type: str, id_col: str
) -> DataFrame:
    base = float(np.log(total + distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                take = lambda name, kind: np.frombuffer(row.column(name)[0].as_py(), kind)  # noqa: B023, E731
                ids, kinds = (unpack(row.column(name)[0].as_py()) for name in ("ids", "classes"))
                lengths, held = take("lengths", np.int64), take("held", np.int8)
                keys = row.column("keys")[0].as_py()
                found = row.column("found").flatten()
                c = np.zeros(len(kinds), np.int64)
                c[found.field(0).to_numpy()] = found.field(1).to_numpy()
                starts = np.cumsum(lengths) - lengths
                logs = np.log(c + 1.0)
                base_scores = np.add.reduceat(logs[ids], starts) - lengths * base
                within = np.add.reduceat((logs - share[kinds])[ids], starts)
                known = np.add.reduceat((c > 0)[ids].astype(np.int64), starts)
                hidden = forward(np.split(kinds[ids], starts[1:]), model)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.string()),
                        pa.array(held == 1),
                        pa.array(lengths),
                        pa.array(known),
                        pa.array(np.full(len(lengths), total, np.int64)),
                        pa.array(base_scores / _LN10),
                        pa.array((hidden + within) / _LN10),
                    ],
                    ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = (
        "key string, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    rows = ready.mapInArrow(run, schema)
    return rows.select(
        F.col("key").cast(key_type).alias(id_col),
        "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )
