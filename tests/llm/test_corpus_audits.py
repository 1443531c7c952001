"""Importance resampling, source divergence and secret scans: against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("regex")
pytest.importorskip("xxhash")

from courtside.llm import divergence, importance, secret_scan  # noqa: E402

ODD = "doc_id bigint, text string, lang string, source string, key string, packed string, digest string, n string, base string"


def docs(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], ODD)


def words(text, letters=False):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+" if letters else r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def odd_texts(seed, n, longest=40):
    rng = random.Random(seed)
    some = ["Cat", "dog", "éTÉ", "中文", "x1", "a", "THE", "of", "42", "naïve", "İx", "Straße"]
    gaps = [" ", " ", "  ", "\n", ", ", "-", "\x00", "\x7f", "{"]
    made = ["".join(rng.choice(some) + rng.choice(gaps) for _ in range(rng.randint(0, longest))) for _ in range(n)]
    return [None, "", " ", "---", "word", " the cat ", *made]


# importance resampling


def brute_resample(rows, target, longest, buckets, percent, least):
    def grams(text):
        w = words(text)
        return [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]

    def hashed(text):
        return [zlib.crc32(g.encode()) % buckets for g in grams(text)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(hashed(text))
    for text in target:
        t.update(hashed(text))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
        for b in range(buckets)
    ]
    out = []
    for key, text in rows:
        found = [gain[b] for b in hashed(text)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words(text))))
    pool = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = [(*r[:4], k if k <= percent * len(pool) // 100 else None) for k, r in enumerate(pool, 1)]
    return drawn + [(*r[:4], None) for r in out if r[4] < least]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_equals_brute_force(spark, longest):
    rows = list(enumerate(odd_texts(longest, 300)))
    rows += [(7, "the cat of 42 " * 9)] * 5 + [(None, "dog the of cat a x1")] * 3 + [(9, "other text of nine words or so, is it")]
    target = odd_texts(8, 30)
    items = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(docs(spark, [(k, t, "x", "x") for k, t in rows]), items, longest=longest, buckets=500, percent=30, least_words=5)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert in_order(got.collect()) == in_order(brute_resample(rows, target, longest, 500, 30, 5))


def test_rank_does_not_depend_on_layout(spark):
    rows = [(i % 70, t, "x", "x") for i, t in enumerate(odd_texts(3, 200))]
    items = spark.createDataFrame([("the cat",)], "text string")
    one = importance.resample(docs(spark, rows).coalesce(1), items, percent=50, least_words=3)
    many = importance.resample(docs(spark, rows[::-1]).repartition(13), items, percent=50, least_words=3)
    assert in_order(one.collect()) == in_order(many.collect())


def test_resampling_of_empty_tables(spark):
    none = docs(spark, [])
    items = none.select("text")
    assert importance.resample(none, items).count() == 0
    got = importance.resample(docs(spark, [(1, "some text of words", "x", "x")]), items, least_words=1, percent=100)
    assert [r["rank"] for r in got.collect()] == [1]
    assert importance.drawn_rows(docs(spark, [(1, "a", "x", "x"), (2, "b", "x", "x")]), got).count() == 1


def test_long_texts_are_scanned_in_slices():
    rng = random.Random(4)
    text = " ".join(rng.choice(["ab", "Cé", "x", "dog's"]) for _ in range(30_000)) + " " + "y" * 100
    scan = importance.OverlappedNgrams(3)
    whole = Counter(s for _, sums in scan.scan(text.encode()) for s in sums)
    cut = Counter()
    from courtside.llm import slices as module

    pieces = list(module.slices(text.lower().encode(), importance._GAPS, 1000))
    assert b"".join(pieces) == text.lower().encode() and len(pieces) > 20
    real = importance.slices
    importance.slices = lambda t, gap: real(t, gap, 1000)
    try:
        parts = list(scan.scan(text.encode()))
    finally:
        importance.slices = real
    for _, sums in parts:
        cut.update(sums)
    assert cut == whole and sum(n for n, _ in parts) == len(words(text))


# source divergence


def brute_audit(rows, least, best):
    count, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = words(text, letters=True)
        count[lang, source].update(found)
        seen[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in seen[lang].items() if n >= least)
        sources = sorted(s for g, s in groups if g == lang)
        v = len(kept)

        def shares(times):
            total = sum(times[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (times[t] + 2) // (total + 2 * v) for t in kept}

        whole = Counter()
        for s in sources:
            whole.update(count[lang, s])
        own, q = {s: shares(count[lang, s]) for s in sources}, shares(whole)

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(o, sum(f(own[s][t], own[o][t]) for t in kept)) for o in sources if o != s]
            pairs.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, s, "pair", o, value, k) for k, (o, value) in enumerate(pairs, 1)]
            terms = [(t, f(own[s][t], q[t])) for t in kept if count[lang, s][t] > 0 and own[s][t] > q[t]]
            terms.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, s, "term", t, value, k) for k, (t, value) in enumerate(terms[:best], 1)]
    return out


def audit_rows():
    rng = random.Random(11)
    names = [None, "", "s1", "s2", "ß", "z"]
    rows = [(i, t, rng.choice([None, "", "en", "fr"]), rng.choice(names)) for i, t in enumerate(odd_texts(5, 300))]
    rows += [(i, "cat dog cat", "en", "s1") for i in range(100)]  # a group of copies
    rows += [(1, None, "empty", "a"), (2, "", "empty", "b"), (3, "one two", "single", "a"), (4, "rare", "few", "a"), (5, "other", "few", "b")]
    return rows


@pytest.mark.parametrize("bits", [64, 6, 2])
def test_audit_equals_brute_force(spark, bits):
    rows = audit_rows()
    frame = docs(spark, rows).repartition(5)
    got = divergence.audit(frame, least_docs=4, best=3, bits=bits, held_terms=20, shard_rows=10)
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    want = brute_audit([r[1:] for r in rows], 4, 3)
    assert sum(r[2] == "term" for r in want) > 10
    assert in_order(got.collect()) == in_order(want)


def test_audit_with_large_counts(spark):
    """Products beyond 64 bits stay exact."""
    from pyspark.sql import functions as F

    n = 20_000_000_000
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(3 * n), F.lit(7)).alias("p")).first()["p"]
    assert got == 1 + 1_000_000_000 * (n + 2) // (3 * n + 14)


def test_audit_of_an_empty_table(spark):
    assert divergence.audit(docs(spark, [])).count() == 0


def test_audit_drops_no_term_of_a_long_text(spark):
    text = "alpha beta " * 600_000
    got = divergence.audit(docs(spark, [(1, text, "en", "a"), (2, "beta", "en", "b")]), least_docs=1, best=5)
    assert in_order(got.collect()) == in_order(brute_audit([(text, "en", "a"), ("beta", "en", "b")], 1, 5))


# secret scans


def brute_patterns(text):
    """Spans of the fixed patterns, found sign by sign."""
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    upper_digits, low_hex = set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), set("0123456789abcdef")

    def run(at, allowed):
        while at < len(text) and text[at] in allowed:
            at += 1
        return at

    def assign(at):
        def word(w):
            got = text[at : at + len(w)]
            return len(got) == len(w) and got.isascii() and got.lower() == w

        def value_from(p):
            end = run(p, value)
            return (p, end) if end > p else None

        for w in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if not word(w):
                continue
            p = at + len(w)
            for first in ((1, 0) if text[p : p + 1] in ('"', "'") and p < len(text) else (0,)):
                q = run(p + first, {" "})
                if text[q : q + 1] not in (":", "=") or q >= len(text):
                    continue
                q = run(q + 1, {" "})
                if q < len(text) and text[q] in "\"'":
                    got = value_from(q + 1)
                else:
                    got = value_from(q)
                if got:
                    return got
        return None

    out, at = [], 0
    while at < len(text):
        got = assign(at)
        if got:
            if got[1] - got[0] >= 6:
                out.append(("assign", at, got[1]))
            at = got[1]
        else:
            at += 1
    at = 0
    while at < len(text):
        end = run(at + 4, upper_digits) if text.startswith("AKIA", at) else at
        if end > at + 4:
            if end - at >= 20:
                out.append(("access", at, end))
            at = end
        else:
            at += 1
    at = 0
    while at < len(text):
        end = run(at, low_hex)
        if end - at >= 24:
            out.append(("hex", at, end))
        at = max(end, at + 1)
    order = ["assign", "access", "hex"]
    return sorted(out, key=lambda s: (s[1], order.index(s[0])))


def test_patterns_equal_brute_force():
    rng = random.Random(9)
    parts = ["password", "PassWd", "token", "toKen", "ſecret", "secret", "api_key", "APIKEY", "apı", '"', "'", " ", "  ", ":", "=", "\t",
             "AKIA", "AKIAAKIA", "Z9" * 4, "0123456789abcdef", "deadbeef", "abcdef", "é", "中", "/+-_.", "xyz", "\n"]
    hits = Counter()
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        want = brute_patterns(text)
        assert secret_scan.patterns(text) == want, text
        hits.update(k for k, _, _ in want)
    assert min(hits[k] for k in ("assign", "access", "hex")) > 20


@pytest.mark.parametrize("name", list(secret_scan.ALPHABETS))
@pytest.mark.parametrize("length", [16, 40, 500])
def test_chances_of_random_tokens_are_uniform(name, length):
    rng = np.random.default_rng(length)
    size = len(secret_scan.ALPHABETS[name])
    got = secret_scan.battery(rng.integers(0, size, (4000, length)).astype(np.uint8), size)
    for level in (0.5, 0.1, 0.01):
        assert abs((got <= level).mean() - level) < (0.03 if length == 16 else 0.02) + 0.1 * level


def test_battery_does_not_depend_on_its_slices():
    rng = np.random.default_rng(2)
    row = rng.integers(0, 64, (1, 2_500_001)).astype(np.uint8)
    many = np.repeat(row[:, :5000], 3, axis=0)
    assert np.allclose(secret_scan.battery(many, 64), secret_scan.battery(many[:1], 64)[0])
    x = row[0].astype(float)
    r = ((x[1:] - 31.5) * (x[:-1] - 31.5)).sum()
    serial = math.erfc(abs(r / (math.sqrt(len(x) - 1) * 4095 / 12)) / math.sqrt(2))
    assert 0 < secret_scan.battery(row, 64)[0] <= 1 and serial > 0


def test_encodings():
    assert secret_scan.encoding_of("0" * 20) is None and secret_scan.encoding_of("ab/cd-ef" * 3) is None
    for name, alphabet in secret_scan.ALPHABETS.items():
        token = alphabet * 2
        assert secret_scan.encoding_of(token) == name


def prose(rng, n):
    return " ".join("".join(rng.choice(["er", "ti", "on", "an", "the", "re", "wh", "in"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def planted(kind, number, length):
    rng = random.Random(length)
    rows, keys = [], {}
    for i in range(number):
        key = "".join(rng.choice(secret_scan.ALPHABETS[kind]) for _ in range(length))
        first = prose(rng, rng.randint(20, 60)).capitalize() + " 12 "
        name = "".join(w.capitalize() for w in prose(rng, 14).split())[:length]
        rows.append((i, f"{first}{key} {name} {prose(rng, 40)}", "x", "x"))
        keys[i] = len(first), len(first) + length
    return rows, keys


def test_random_tokens_are_reported_and_words_are_not(spark):
    rows, keys = planted("letters digits", 120, 40)
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan(docs(spark, rows)).collect()}
    found = {i: [(s["start"], s["end"]) for s in spans if s["kind"] == "random"] for i, spans in got.items()}
    caught = sum(keys[i] in spans for i, spans in found.items())
    wrong = sum(len(set(spans) - {keys[i]}) for i, spans in found.items())
    assert caught >= 0.9 * len(rows) and wrong <= 0.1 * caught


def test_classes_without_evidence_report_nothing():
    assert secret_scan.cuts({(5, 0): 3}, {}, 0.05) == {}
    assert secret_scan.cuts({(5, 0): 100}, {(5, 0): 2000}, 0.05) == {}
    assert secret_scan.cuts({(5, 0): 10}, {(5, 9): 200}, 0.05) == {5: 8}
    # (decoys + 1) / 20 per token, for one token
    assert secret_scan.cuts({(5, 3): 1}, {(5, 30): 20}, 0.05) == {5: 29}


def test_scan_keeps_rows_and_pattern_spans(spark):
    texts = [None, "", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "é password: hunter22 x", "AKIA" + "Q7" * 9, "secret=abc", "token=xyzxyz"]
    rows = [(i, t, "x", "x") for i, t in enumerate(texts)] + [(1, "secret=abcdef", "x", "x")] * 2
    got = secret_scan.digests(secret_scan.scan(docs(spark, rows)))
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    want = []
    for key, text, *_ in rows:
        base = brute_patterns(text or "")
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        kinds = Counter(k for k, _, _ in base)
        want.append((key, kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(line.encode()).hexdigest(), line))
    assert in_order(got.collect()) == in_order(want)
    assert secret_scan.scan(docs(spark, [])).count() == 0
