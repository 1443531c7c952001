"""Quality, language, toxicity, language model: held-out accuracy and brute force."""

from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.llm import hidden_markov, language_id, quality, toxicity
from courtside.llm.ngrams import HashedNgrams

DOCS = "doc_id bigint, text string, lang string, score string, held_out string, label string, _id string"
ENDINGS = {"en": ["ing", "tion", "the"], "de": ["ung", "keit", "der"], "fr": ["eaux", "ment", "les"]}


def made(n=240, seed=3):
    """Texts of invented words in three languages; every fourth one is shouted junk, every
    fifth one has a toxic word, sometimes disguised."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        lang = sorted(ENDINGS)[i % 3]
        words = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(2)) + rng.choice(ENDINGS[lang])
                 for _ in range(rng.randint(20, 60))]
        junk, toxic = i % 4 == 0, i % 5 == 0
        if toxic:
            word = rng.choice(["loser", "vermin"])
            disguise = rng.choice([word, word, word, word.replace("e", "3"), word[0] + word[1] * 4 + word[2:]])
            words[rng.randrange(len(words))] = disguise
        if junk:
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words), lang, "x", "x", "x", "x"))
        labels.append((i, 0 if junk else 1, int(toxic)))
    odd = [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "12 34 !!"), (n + 4, "a" * 300_000), (None, "so ist dieung")]
    docs += [(i, t, None, "x", "x", "x", "x") for i, t in odd]
    docs.append(docs[7])  # a repeated row
    labels += [(n, 1, 0), (None, 1, 1), (999_999, 0, 1), (3, None, None), (6, 1, 0)]
    return docs, labels


@pytest.fixture(scope="module")
def corpus(spark):
    docs, labels = made()
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality(corpus):
    docs, labels = corpus
    found = quality.classify(docs, quality.fit(docs, labels))
    assert found.count() == docs.count()
    got = by_id(found)
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in range(240) if got[i]["held_out"]} == set(held)
    assert sum(got[i]["predicted"] == (i % 4 != 0) for i in held) >= 0.95 * len(held)
    assert all(got[i]["score"] == 0 for i in (240, 241, 242))
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_quality_without_labels_or_documents(spark, corpus):
    docs, labels = corpus
    model = quality.fit(docs, labels.limit(0))
    assert by_id(quality.classify(docs, model))[1]["score"] == 0.5
    assert quality.classify(docs.limit(0), model).collect() == []


def test_ngrams_do_not_depend_on_slices(monkeypatch):
    words = [b"aa", b"aa", b"bcd", b"e", b"efghij", b"efghij", b"x"] * 3
    def all_of():
        parts = list(HashedNgrams((2, 3, 4), 12, True).of_words(words))
        return sorted(np.concatenate([p for p, _ in parts])), sum(r for _, r in parts)
    whole = all_of()
    monkeypatch.setattr("courtside.llm.ngrams._SLICE", 8)
    assert all_of() == whole
    assert whole[1] == 6


def test_languages(corpus):
    docs, _ = corpus
    model = language_id.fit(docs)
    assert np.count_nonzero(model.weight) < model.weight.size / 4  # sparse
    found = language_id.identify(docs, model)
    assert found.count() == docs.count()
    got = by_id(found)
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i in range(240) if got[i]["held_out"]} == set(held)
    assert sum(got[i]["lang_pred"] == sorted(ENDINGS)[i % 3] for i in held) >= 0.97 * len(held)
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0) for i in (240, 241, 242, 243))
    assert got[244]["lang_pred"] != "und" and got[None]["lang_pred"] == "de"


def test_languages_without_documents(corpus):
    docs, _ = corpus
    model = language_id.fit(docs.where("lang IS NULL"))
    assert {r["lang_pred"] for r in language_id.identify(docs, model).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).collect() == []


def test_document_frequencies_equal_a_count(corpus):
    docs, _ = corpus
    few = docs.where("doc_id < 40")
    df, n = language_id.document_frequencies(few, "text")
    hashed, want = HashedNgrams(language_id.ORDERS, language_id.BITS, False), np.zeros(1 << language_id.BITS)
    texts = [r["text"] for r in few.collect()]
    for text in texts:
        want += language_id._counts(hashed, text) > 0
    assert n == len(texts) and (df == want).all()


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3)) * 2
    p = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    labels = [rng.choice(3, p=row) for row in p]
    assert abs(language_id.temperature(list(logits * 3), labels) - 3) < 0.3


def test_toxicity(corpus):
    docs, labels = corpus
    found = toxicity.classify(docs, toxicity.fit(docs, labels))
    assert found.count() == docs.count()
    got = by_id(found)
    held = [i for i in range(240) if got[i]["held_out"]]
    assert set(held) == {i for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(got[i]["predicted"] == (i % 5 == 0) for i in held) >= 0.97 * len(held)
    assert all(got[i]["predicted"] == 0 for i in (240, 241, 242, 243, 244))


def test_toxicity_without_labels(corpus):
    docs, labels = corpus
    model = toxicity.fit(docs, labels.limit(0))
    assert {r["predicted"] for r in toxicity.classify(docs, model).collect()} == {0}
    assert toxicity.classify(docs.limit(0), model).collect() == []


LETTERS = toxicity.LetterModel(
    Counter(g for w in "the loser is an idiot and the moron is a pathetic clown of trash not worth it stupid".split() * 9
            for g in [f"  {w} "[i : i + 3] for i in range(len(w) + 1)])
)


@pytest.mark.parametrize("disguised, word", [
    ("l0s3r", "loser"), ("m.o.r.o.n", "moron"), ("cl0wn!!", "clown"), ("traaaash", "trash"), ("p@thetic", "pathetic"),
    ("$tupid", "stupid"), ("loser", "loser"), ("123", ""), ("!!", ""),
])
def test_restoration(disguised, word):
    assert toxicity.restore(disguised, LETTERS) == word


def test_spelled_out_words_are_read():
    found = toxicity.restored_words("you l o s e r and 1 d 1 0 t", {}, LETTERS)
    assert {"loser", "idiot"} <= found


@pytest.mark.parametrize("text", [
    "you are a s t u p i d", "t h e s t u p i d l o s e r", "a.s.t.u.p.i.d", "t-h-e-s-t-u-p-1-d", "the=stupid", "t h e l o s e r i s " * 5 + "s t u p i d",
    "t.h.e.l.o.s.e.r.i.s." * 5 + "s.t.u.p.i.d",
])
def test_words_end_inside_runs(text):
    assert "stupid" in toxicity.restored_words(text, {}, LETTERS)


def test_a_sign_before_a_word_may_be_a_bracket():
    assert toxicity.restore("(the", LETTERS) == "the" and toxicity.restore("!diot", LETTERS) == "idiot"


def test_runs_are_read_in_linear_time():
    found = toxicity.restored_words("t h e l o s e r " * 3_000, {}, LETTERS)
    assert {"the", "loser"} <= found


def test_all_trigrams_of_the_sample_count_once(spark):
    signs = [chr(0x4E00 + i) for i in range(20_000)]
    words = ["".join(signs[i : i + 3]) for i in range(0, 19_998, 1)]
    docs = spark.createDataFrame([(1, " ".join(words), *"xxxxx"), (2, "ab ab", *"xxxxx"), (2, "ab ab", *"xxxxx")], DOCS)
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id int, toxic int")
    found = toxicity.fit(docs, labels, held_out=9).trigrams
    want = Counter(f"  {w} "[i : i + 3] for w in [*words, "ab", "ab"] for i in range(len(w) + 1))
    assert len(want) > 50_000 and found == want


def _brute_forward(seq, model):
    """The probability of a class sequence, summed over all state paths."""
    states = range(len(model.start))
    total = {s: model.start[s] * model.emit[s][seq[0]] for s in states}
    for c in seq[1:]:
        total = {s: sum(total[r] * model.step[r][s] for r in states) * model.emit[s][c] for s in states}
    return math.log(sum(total.values()))


def test_forward_equals_the_sum_over_paths():
    model, rng = hidden_markov.first_model(3, 6), np.random.default_rng(0)
    seqs = sorted((rng.integers(0, 6, n).astype(np.int32) for n in (1, 2, 7, 40, 3, 7)), key=len, reverse=True)
    want = [_brute_forward(s, model) for s in seqs]
    assert np.allclose(hidden_markov.forward(seqs, model), want)
    sums = hidden_markov.Hidden(np.zeros(3), np.zeros((3, 3)), np.zeros((3, 6)))
    assert math.isclose(hidden_markov.expected(seqs, model, sums), sum(want))
    assert np.isclose(sums.start.sum(), len(seqs)) and np.isclose(sums.emit.sum(), sum(map(len, seqs)))
    assert np.isclose(sums.step.sum(), sum(len(s) - 1 for s in seqs))
    assert np.allclose(sums.emit.sum(axis=0), np.bincount(np.concatenate(seqs), minlength=6))


def test_lanes_hold_every_sequence_once_in_few_steps():
    """A step serves all lanes: no more steps than the longest text or the number of lanes demands."""
    rng = np.random.default_rng(2)
    for longest in (400, 4000):
        seqs = [rng.integers(0, 6, n).astype(np.int32) for n in (3, longest, *rng.integers(1, 200, 2000))]
        lanes = hidden_markov._lanes(seqs, 6)
        assert len(lanes.grid) < 1.1 * max(longest, sum(map(len, seqs)) / hidden_markov.LANES)
        assert (lanes.grid != 6).sum() == sum(map(len, seqs)) and lanes.begin.shape == lanes.end.shape == (3, len(seqs))
        ends = {j: (t, lane) for t, lane, j in lanes.end.T.tolist()}
        for t, lane, j in lanes.begin.T.tolist():
            assert ends[j][1] == lane and (lanes.grid[t : ends[j][0] + 1, lane] == seqs[j]).all()


@pytest.mark.parametrize("width, tile", [(1, 5), (3, 30), (512, 1 << 14)])
def test_recursions_do_not_depend_on_lanes_and_tiles(monkeypatch, width, tile):
    monkeypatch.setattr(hidden_markov, "LANES", width)
    monkeypatch.setattr(hidden_markov, "TILE", tile)
    rng, model = np.random.default_rng(3), hidden_markov.first_model(3, 6)
    seqs = [rng.integers(0, 6, n).astype(np.int32) for n in (1, 8, 30, 7, 9, 1, 16, 64, 2, 1, 17)]
    want = [_brute_forward(s, model) for s in seqs]
    assert np.allclose(hidden_markov.forward(seqs, model), want, rtol=1e-12)
    sums, alone = (hidden_markov.Hidden(np.zeros(3), np.zeros((3, 3)), np.zeros((3, 6))) for _ in range(2))
    assert math.isclose(hidden_markov.expected(seqs, model, sums), sum(want), rel_tol=1e-12)
    for s in seqs:  # expected counts by definition: probabilities of states given the whole text
        ahead, behind = [model.start * model.emit[:, s[0]]], [np.ones(3)]
        for c in s[1:]:
            ahead.append(ahead[-1] @ model.step * model.emit[:, c])
        for c in s[:0:-1]:
            behind.append(model.step @ (model.emit[:, c] * behind[-1]))
        behind, total = behind[::-1], ahead[-1].sum()
        alone.start += ahead[0] * behind[0] / total
        for t, c in enumerate(s):
            alone.emit[:, c] += ahead[t] * behind[t] / total
            if t:
                alone.step += np.outer(ahead[t - 1], model.emit[:, c] * behind[t]) * model.step / total
    for got, by_definition in zip(vars(sums).values(), vars(alone).values()):
        assert np.allclose(got, by_definition, rtol=1e-10)


def test_unlikely_classes_in_a_row_do_not_underflow():
    """Emissions of 1e-25 a symbol, as in a corpus far beyond any size, between two scalings."""
    model = hidden_markov.Hidden(np.full(2, 0.5), np.array([[0.9, 0.1], [0.2, 0.8]]), np.array([[1.0, 1e-25], [1.0, 1e-25]]))
    seqs, sums = [np.ones(500, np.int32)], hidden_markov.Hidden(np.zeros(2), np.zeros((2, 2)), np.zeros((2, 2)))
    assert math.isclose(hidden_markov.expected(seqs, model, sums), 500 * math.log(1e-25))
    assert math.isclose(sums.emit.sum(), 500) and math.isclose(sums.step.sum(), 499)


def test_a_long_text_takes_little_memory(monkeypatch):
    """States of one tile of steps are held, not those of the whole text."""
    monkeypatch.setattr(hidden_markov, "TILE", 1024, raising=False)
    seq, model = np.arange(30_000, dtype=np.int32) % 60, hidden_markov.first_model(8, 60)
    sums = hidden_markov.Hidden(np.zeros(8), np.zeros((8, 8)), np.zeros((8, 60)))
    tracemalloc.start()
    hidden_markov.expected([seq], model, sums)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert math.isclose(sums.emit.sum(), len(seq))
    assert peak < 2 * 8 * 8 * len(seq) / 2  # half of all forward and backward states


def test_tokens_are_cut_at_ascii_white_space_only(spark):
    token = re.compile(rb"[^\x20\x09-\x0D]+")
    text = "".join(f"{chr(c)}A" for c in range(256)) + "\u2003B\u00a0c  \u0085 d\x1ce \x0b\x0c"
    rows = spark.createDataFrame([("1", text, False)], "key string, text string, held boolean")
    row = hidden_markov.chunk_texts(rows, 64, 10).collect()[0]
    got = [bytes(row["words"][i]) for i in hidden_markov.unpack(row["ids"])]
    assert got == [*token.findall(text.encode().lower()), b""]


def test_training_makes_the_texts_likelier():
    rng = np.random.default_rng(4)
    seqs = [np.concatenate([rng.integers(0, 4, 30), [8]]) if i % 2 else np.concatenate([rng.integers(4, 8, 30), [8]]) for i in range(40)]
    model, logs = hidden_markov.first_model(2, 9), []
    for _ in range(15):
        sums = hidden_markov.Hidden(np.zeros(2), np.zeros((2, 2)), np.zeros((2, 9)))
        logs.append(hidden_markov.expected(seqs, model, sums))
        model = hidden_markov._normal(sums)
    assert logs[-1] > logs[0] and all(b > a - 1 for a, b in zip(logs, logs[1:]))
    assert logs[-1] / (31 * 40) > -1.6  # log 4 within a language, log 8 across


@pytest.mark.parametrize("chunk_tokens", [1_000_000, 50])
def test_language_model_scores(spark, corpus, chunk_tokens):
    docs, _ = corpus
    few = docs.where("doc_id < 60 OR doc_id BETWEEN 240 AND 243 OR doc_id IS NULL")
    texts = [(r["doc_id"], r["text"]) for r in few.collect()]
    token = re.compile(rb"[^\x20\x09-\x0D]+")
    tokens = {i: [*token.findall((t or "").encode().lower()), b""] for i, t in texts}
    counts = Counter()
    for i, t in texts:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            counts.update(tokens[i])
    total, distinct = sum(counts.values()), len(counts)
    got = hidden_markov.score_texts(few, states=3, classes=64, chunk_tokens=chunk_tokens).collect()
    assert len(got) == len(texts)
    for r in got:
        mine = tokens[r["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in mine)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(mine), sum(counts[w] > 0 for w in mine), total)
        assert math.isclose(r["base_score"], base) and r["score"] < 0
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_language_model_does_not_depend_on_partitions(spark, corpus):
    docs, _ = corpus
    few = docs.where("doc_id < 60")
    scored = [
        by_id(hidden_markov.score_texts(few.repartition(n), states=3, classes=64, chunk_tokens=tokens))
        for n, tokens in ((1, 1_000_000), (30, 1_000_000), (2, 1))
    ]
    for other in scored[1:]:
        assert all(math.isclose(r["score"], other[i]["score"], rel_tol=1e-9) for i, r in scored[0].items())


def test_every_round_sees_all_training_texts(spark, corpus):
    docs, _ = corpus
    some = docs.where("doc_id < 60").selectExpr("string(doc_id) AS key", "text", "doc_id % 7 = 2 AS held").coalesce(2)
    chunks = hidden_markov.chunk_texts(some, 64, 200).cache()
    seqs = []
    for r in chunks.collect():
        flat = hidden_markov.unpack(r["classes"])[hidden_markov.unpack(r["ids"])]
        parts = np.split(flat, np.cumsum(np.frombuffer(r["lengths"], np.int64))[:-1])
        seqs += [p for p, held in zip(parts, np.frombuffer(r["held"], np.int8)) if not held]
    seqs.sort(key=len, reverse=True)
    model = hidden_markov.first_model(3, 64)
    for _ in range(4):
        sums = hidden_markov.Hidden(np.zeros(3), np.zeros((3, 3)), np.zeros((3, 64)))
        hidden_markov.expected(seqs, model, sums)
        model = hidden_markov._normal(sums)
    got = hidden_markov.baum_welch(chunks, 3, 64, rounds=4)
    assert np.allclose(got.emit, model.emit) and np.allclose(got.step, model.step)


def test_probabilities_of_words_sum_to_one():
    """One token after another: known words and one unknown word per class."""
    known = [b"the", b"other", b"", b"a"]
    classes, counts = 16, {w: n for w, n in zip(known, (5, 1, 3, 2))}
    mass = np.zeros(classes)
    for w, c in counts.items():
        mass[hidden_markov.word_class(w, classes)] += c + 1
    mass += 1
    within = Counter()
    for w, c in counts.items():
        within[hidden_markov.word_class(w, classes)] += (c + 1) / mass[hidden_markov.word_class(w, classes)]
    assert all(math.isclose(within[k] + 1 / mass[k], 1) for k in range(classes))


def test_packed_numbers_come_back():
    numbers = np.array([0, 1, 255, 256, 70_000, 2**31 - 1], np.int32)
    assert (hidden_markov.unpack(hidden_markov.pack(numbers)) == numbers).all()
    assert len(hidden_markov.unpack(hidden_markov.pack(numbers[:0]))) == 0


def test_language_model_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert hidden_markov.score_texts(none).collect() == []
    held = spark.createDataFrame([(5, "a b", *"xxxxx")], DOCS)
    fold = zlib.crc32(b"5") % 7
    row = hidden_markov.score_texts(held, held_out=fold).collect()[0]
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["held_out"]) == (3, 0, 0, True)


def test_folds_are_crc32_of_the_text_of_the_id(spark):
    from courtside.llm.staging import fold

    got = spark.range(50).select("id", fold(F.col("id"), 5).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)


@pytest.mark.parametrize("text", ["½ ² ①", "Ⅷ", "12 _ 3"])
def test_numerals_are_no_letters(text):
    assert language_id._letters(text) == [] and language_id._letters(text + " Äb") == ["äb".encode()]


def test_samples_do_not_depend_on_the_layout_of_repeated_ids(spark):
    from courtside.llm.staging import sample_rows

    rows = [(i % 5, f"text {i}", "x") for i in range(40)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "_id bigint, _text string, _lang string").repartition(3)
        got = sorted(map(tuple, sample_rows(df, "_id", 10).collect()))
        assert got == [(k, min(t for i, t, _ in rows if i == k), "x") for k in range(5)]
