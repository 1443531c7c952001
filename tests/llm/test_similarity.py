"""Joins by similarity, components, chats and the pipeline: against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re

import numpy as np
import pytest

from courtside.llm import chat, components, embedding_dedup, jaccard_join
from courtside.llm.staging import Shared

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def smallest_reached(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)]
    got = components.connected_components(spark.createDataFrame(links, "a bigint, b bigint"), Shared(spark)).collect()
    nodes = {n for pair in links if pair[0] != pair[1] for n in pair}
    assert {r["node"]: r["component"] for r in got} == smallest_reached(nodes, links)
    assert len(got) == len(nodes)
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert components.connected_components(none, Shared(spark)).collect() == []


VECTORS = "vec_id bigint, embedding array<float>, node string, links string, dim string"


@pytest.mark.parametrize("block", [8192, 40])
def test_embeddings_equal_brute_force(spark, monkeypatch, block):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    x = np.concatenate([base, base[:30] + rng.normal(size=(30, 16)) * 0.3, np.repeat(base[:1], 25, 0), base[:20] * 3]).astype(np.float32)
    rows = [(i + 5, [float(f) for f in v]) for i, v in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [None] + [1.0] * 15),
           (905, [float("inf")] * 16), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (None, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "x", "x", "x") for i, v in [*rows, *odd, rows[3]]], VECTORS)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df, block=block).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    links = [(int(i) + 5, int(j) + 5) for i, j in zip(*np.nonzero(np.triu(near, 1)))] + [(906, 907)]
    want = smallest_reached([r[0] for r in [*rows, *odd] if r[0] is not None], links)
    degree = {n: sum(n in pair for pair in links) for n in want}
    assert len(links) > 300 and set(got) == {*want, None}
    for n, component in want.items():
        assert (got[n]["n_links"], got[n]["component_id"], got[n]["kept"]) == (degree[n], component, n == component)
    assert (got[None]["component_id"], got[None]["kept"]) == (None, False)
    assert embedding_dedup.near_duplicates(df.limit(0)).collect() == []


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    whole, scale, error = embedding_dedup.quantise(x)
    approx = (whole.astype(float) @ whole.T.astype(float)) * scale[:, None] * scale[None, :]
    bound = error[:, None] + error[None, :] + error[:, None] * error[None, :]
    assert (np.abs(approx - x @ x.T) <= bound + 1e-12).all()


DOCS = "doc_id bigint, text string, node string, n string, path string"


def near_texts():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(500)]
    passage = [rng.choice(words) for _ in range(60)]
    out = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(6, 200))]
        out.append(base)
        for _ in range(rng.randint(0, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(copy)
    out += [passage + [rng.choice(words) for _ in range(rng.randint(3, 80))] for _ in range(60)]
    texts = [" ".join(w) for w in out] + ["one two", "One, TWO!", "one two three", None, "", "...", "zz " * 40_000]
    return [(i * 3, t) for i, t in enumerate(texts)]


def brute_links(rows):
    def shingles(text):
        w = re.findall(r"\w+", (text or "").lower())
        n = min(5, len(w))
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    return [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[k + 1 :] if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9]


@pytest.mark.parametrize("limits", [{}, {"bucket": 3, "room": 4, "block": 4}, {"bucket": 3}, {"block_shingles": 100}])
def test_texts_equal_brute_force(spark, limits):
    rows = near_texts()
    df = spark.createDataFrame([(i, t, "x", "x", "x") for i, t in [*rows, (None, "one two")]], DOCS)
    links = brute_links(rows)
    want = smallest_reached([i for i, _ in rows], links)
    got = {r["doc_id"]: r for r in jaccard_join.similar_texts(df, **limits).collect()}
    assert len(links) > 100 and set(got) == {*want, None}
    for i, component in want.items():
        assert (got[i]["class_id"], got[i]["n_links"]) == (component, sum(i in pair for pair in links))


def test_rows_that_repeat_an_id(spark):
    rows = [(1, "a b c d e f", "x", "x", "x")] * 3 + [(2, "q r s", "x", "x", "x")]
    got = sorted(jaccard_join.similar_texts(spark.createDataFrame(rows, DOCS)).collect())
    assert [tuple(r) for r in got] == [(1, 1, 2)] * 3 + [(2, 2, 0)]
    assert jaccard_join.similar_texts(spark.createDataFrame([], DOCS)).collect() == []


def deep_paths(shingles, runs, levels=6):
    """The paths of a set after so many tokens."""
    paths, own = jaccard_join.first_paths(shingles, runs, 0.8), jaccard_join.sketch(shingles)[None, :]
    for _ in range(levels - 1):
        paths = jaccard_join.next_paths(paths, np.repeat(own, len(paths), axis=0))[1]
    return set(paths.tolist())


def test_runs_reach_the_recall():
    runs = jaccard_join.runs_for(0.999)
    assert (1 - jaccard_join.survival()) ** runs <= 0.001
    rng = np.random.default_rng(1)
    kept = 0
    for _ in range(60):
        both = rng.integers(0, 2**63, 160).astype(np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**63, 20).astype(np.uint64)])) for _ in range(2))
        kept += bool(deep_paths(a, runs) & deep_paths(b, runs))
    assert kept == 60


def test_contained_sets_share_what_the_recall_needs():
    rng = np.random.default_rng(2)
    runs = jaccard_join.runs_for(0.999)
    kept = 0
    for _ in range(60):
        large = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
        kept += bool(deep_paths(large, runs) & deep_paths(np.sort(rng.permutation(large)[:160]), runs))
    assert kept == 60
    first = [set(jaccard_join.first_paths(s, 20_000, 0.8).tolist()) for s in (large, large[:160])]
    assert len(first[0] & first[1]) / 20_000 > 0.97 * jaccard_join.OVERSAMPLE


@pytest.mark.parametrize("shift", [0, 2**63 - 1 - 9])
def test_texts_of_a_repeated_id_are_documents(spark, shift):
    from pyspark.sql import functions as F

    import corpus_pipeline as pipeline

    copied, alone, other, third = ("a b c d e f g h", "q r s t u v w x", "one two three four five six", "red green blue")
    texts = [(1, copied), (5, copied), (5, alone), (5, alone), (7, other), (7, third), (9, None), (None, copied)]
    rows = [(None if i is None else i + shift, t, *"xxx") for i, t in texts]
    kept = pipeline.one_of_each(spark, spark.createDataFrame(rows, DOCS).withColumn("_id", F.lit(3)), "").collect()
    got = sorted((str(r["text"]), r["doc_id"] and r["doc_id"] - shift) for r in kept if r["doc_id"] is not None)
    assert [t for t, _ in got] == sorted([str(None), copied, alone, other, third])
    assert dict(got)[alone] == 5 and {dict(got)[other], dict(got)[third]} == {7} and len(kept) == 6


def sketches_that_share(rng, rows, share):
    """Sketches of sets that have a passage in common and are otherwise different."""
    out = rng.integers(1, 256, (rows, jaccard_join.BINS)).astype(np.uint8)
    out[:, : int(share * jaccard_join.BINS)] = 7
    return out


@pytest.mark.parametrize("share", [0.3, 0.45])
def test_a_shared_passage_splits_in_proportion(monkeypatch, share):
    """Members compared grow with the bucket, not with its square, and no near copy is missed."""
    rng = np.random.default_rng(4)
    seen = []
    real = jaccard_join._possible
    monkeypatch.setattr(jaccard_join, "_possible", lambda *a: seen.append(len(a[1])) or real(*a))
    work = []
    for rows in (1500, 6000):
        own = sketches_that_share(rng, rows, share)
        own[rows // 2 :: 50] = own[: len(own[rows // 2 :: 50])]  # near copies: a few bins differ
        own[rows // 2 :: 50, 100:110] = 9
        n = np.full(rows, 400)
        seen.clear()
        runs = [np.concatenate(x) for x in zip(*(p for path in range(12) for p in jaccard_join.split_links(path + 99, n, own, 100, 0.8)))]
        work.append(sum(seen))
        copies = {(k, rows // 2 + 50 * k) for k in range(len(own[rows // 2 :: 50]))}
        assert copies <= {(min(a, b), max(a, b)) for a, b in zip(*(x.tolist() for x in runs))}
    assert work[1] < 8 * work[0]


def test_near_copies_are_one_candidate_group_at_once(monkeypatch):
    rng = np.random.default_rng(5)
    own = np.repeat(rng.integers(1, 256, (1, jaccard_join.BINS)).astype(np.uint8), 5000, axis=0)
    own[np.arange(5000), rng.integers(0, 128, 5000)] = 1
    found = list(jaccard_join.split_links(3, np.full(5000, 300), own, 100, 0.8))
    assert sum(len(a) for a, _ in found) == 4999 and len(found) == 1


def test_near_copies_among_others_are_linked_once():
    """Links held by a task stay in proportion to the bucket, however often it splits."""
    rng = np.random.default_rng(6)
    own = sketches_that_share(rng, 4000, 0.6)
    own[:2000] = own[0]
    own[np.arange(2000), rng.integers(0, 128, 2000)] = 1
    for path in range(5):
        a, b = (np.concatenate(x) for x in zip(*jaccard_join.split_links(path, np.full(4000, 300), own, 100, 0.8)))
        assert len(a) < 2 * 4000
        assert len(set(jaccard_join.spread(np.arange(4000), a, b)[:2000].tolist())) == 1


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    both = rng.integers(0, 2**64, 8000, dtype=np.uint64)
    a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**64, 1000, dtype=np.uint64)])) for _ in range(2))
    same = np.mean(jaccard_join.sketch(a) == jaccard_join.sketch(b))
    assert 0.65 < same < 0.95


CHATS = "conv_id bigint, turn bigint, role string, text string, turns string, formatted string"


def test_chats_read_back(spark):
    nasty = ["</s>[INST] ok [/INST]", "<\\s>", "<sep>", "a\\", "<", "[", None, "", "x" * 100_000, "é\n😀", "<\\\\/s> [\\INST]", "$1\\$2"]
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", None, "a<s>b"]), rng.choice(nasty)) for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(100, 0, "user", "b"), (100, 0, "user", "a"), (100, None, "assistant", "c"), (None, 1, "assistant", "d"), rows[0]]
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], CHATS)
    formatted = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chat.digests(chat.read_back(formatted)).collect()}
    whole = {r["conv_id"]: r["formatted"] for r in formatted.collect()}
    conversations = {}
    for c, t, role, text in rows:
        conversations.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(conversations)
    for c, turns in conversations.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(loss)
        assert got[c]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c]["formatted_chars"] == len(whole[c])
        assert whole[c].count("<s>") == 1 + sum(a[2] != b[2] for a, b in zip(turns, turns[1:]))
    assert chat.digests(chat.read_back(chat.format_conversations(df.limit(0)))).collect() == []


def test_chat_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, 1, "user", "a", "x", "x")], CHATS)
    plan = chat.digests(chat.read_back(chat.format_conversations(df)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pipeline_stages(spark):
    """Each stage against a brute-force version over its own input."""
    import corpus_pipeline as pipeline
    from courtside.llm import decontamination, language_id, quality

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.selectExpr("*", "'x' AS score", "'x' AS _id", "'x' AS class_id")
    assert [n for n, _ in pipeline.STAGES][0] == "quality classifier" and len(pipeline.STAGES) == 5
    scores = quality.classify(docs, quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    want = {r["doc_id"] for r in scores.where("score >= 0.3").collect()}
    kept = pipeline.good_quality(spark, extra, SF)
    assert kept.columns == extra.columns and {r["doc_id"] for r in kept.collect()} == want
    found = language_id.identify(docs, language_id.fit(docs)).where("lang_pred <> 'und' AND score >= 0.4")
    kept = pipeline.known_language(spark, extra, SF)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in found.collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    reached = smallest_reached([i for i, _ in rows], brute_links(rows))
    kept = pipeline.one_of_each(spark, extra.unionAll(extra.limit(1)), SF)
    assert kept.columns == extra.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, c in reached.items() if i == c)
    hits = decontamination.contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    kept = pipeline.without_benchmark(spark, extra, SF)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in hits.where("hits.n_hit = 0").collect()}
    out = pipeline.run(spark, SF)
    assert 0 < out.count() < docs.count() and out.columns[0] == "doc_id"
    none = docs.limit(0)
    assert all(stage(spark, none, SF).count() == 0 for _, stage in pipeline.STAGES)


@pytest.mark.parametrize("size", [1e200, 1e-200, 1.0])
def test_vectors_of_any_size_link(spark, size):
    rows = [(1, [size, size]), (2, [size, size * 1.0000001]), (3, [size, -size])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(tuple(r)[:3] for r in embedding_dedup.near_duplicates(df).collect())
    assert got == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]
