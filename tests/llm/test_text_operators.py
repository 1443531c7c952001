"""Token counts, byte-level BPE, decontamination: against the libraries and brute force."""

from __future__ import annotations

import base64
import hashlib
import random
import re

import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from courtside.llm import byte_bpe, decontamination, token_counts  # noqa: E402

COUNTS = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id bigint, text string, n_tokens string, hits string, _id string, score string"


def odd_texts() -> list[str | None]:
    rng = random.Random(5)
    signs = list("abcdeéñßçaaa") + [" "] * 5 + ["\n", "\t", "  ", " ", " ", "'s", "'", "1", "٣", "!", "中", "😀", "\x1c", "\x85"]
    made = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    return [None, "", " ", "   ", "\n\n", " a", "a ", "a  b", "a \n b", "x" * 5000, "the cat " * 3000,
            "one <|endoftext|> two<|endoftext|>", "<|endoftext|>", *made]


def rows(spark, texts):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in enumerate(texts)], SCHEMA)


def test_token_counts_equal_the_library(spark):
    texts = odd_texts()
    encoder = tokenizers.Tokenizer.from_file(COUNTS)
    got = {r["doc_id"]: r for r in token_counts.count_tokens(rows(spark, texts), COUNTS).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = len(encoder.encode(text or "", add_special_tokens=False))
        assert got[i]["n_tokens"] == want, repr(text)
        assert got[i]["n_bytes"] == len((text or "").encode())
        assert got[i]["over_limit"] == (want > 1024)


@pytest.mark.parametrize("limits", [{"window": 16}, {"cache": 3}, {"batch_bytes": 10}])
def test_token_counts_do_not_depend_on_limits(limits):
    texts = [t or "" for t in odd_texts()]
    whole = token_counts.TokenCounter(COUNTS)
    assert token_counts.TokenCounter(COUNTS, **limits).count(texts) == whole.count(texts)


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = tokenizers.Tokenizer.from_file(path)
    texts = [t or "" for t in odd_texts()[:60]]
    want = [len(encoder.encode(t, add_special_tokens=False)) for t in texts]
    assert token_counts.TokenCounter(path).count(texts) == want


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_library_and_decode_to_the_text(spark, library):
    texts = odd_texts()
    done = byte_bpe.round_trip_digests(rows(spark, texts), RANKS, public_tokenizers.PATTERN, with_ids=True)
    got = {r["doc_id"]: r for r in done.collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = library.encode_ordinary(text or "")
        assert got[i]["ids"] == want, repr(text)
        assert got[i]["n_tokens"] == len(want)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("limits", [{"window": 8}, {"cache": 1}])
def test_ids_do_not_depend_on_limits(library, limits):
    codec = byte_bpe.BytePairCodec(RANKS, public_tokenizers.PATTERN, **limits)
    for text in odd_texts():
        assert codec.encode(text or "").tolist() == library.encode_ordinary(text or "")


def test_encode_then_decode_columns(spark):
    df = rows(spark, ["déjà vu", None])
    ids = byte_bpe.encode(df["text"], RANKS, public_tokenizers.PATTERN)
    back = df.select(byte_bpe.decode(ids, RANKS, public_tokenizers.PATTERN).alias("b")).collect()
    assert [bytes(r["b"]).decode() for r in back] == ["déjà vu", ""]


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def brute_hits(text, items, size=10):
    doc, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(doc) - n + 1):
                if doc[j : j + n] == w[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add(str(item))
    return len(doc), len(hit), sorted(found)


ITEMS = [
    (1, "a b c d e f g h i j k l"), (2, "A, b. c! d"), (3, "é"), (4, None), (5, "..."), (6, "x x x x x x x x x x x"),
    (7, "b c d e f g h i j k"), (11, "a b c d e f g h i j q"), (11, "m n"),
]


def hit_documents():
    rng = random.Random(2)
    made = [" ".join(rng.choice("abcdefghijklxmnqé") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    whole = "a b c d e f g h i j k l"
    return [None, "", "!!", whole, f"z {whole} z {whole}", "x " * 50, "z" + whole, "É a B c D", *made]


@pytest.mark.parametrize("block_bytes", [1 << 24, 25])
def test_hits_equal_brute_force(spark, block_bytes):
    texts = hit_documents()
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontamination.contamination(rows(spark, texts), items, block_bytes=block_bytes)
    got = {r["doc_id"]: r["hits"] for r in found.collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == brute_hits(text, ITEMS), text
    clean = {r["doc_id"] for r in decontamination.clean(rows(spark, texts), items, block_bytes=block_bytes).collect()}
    assert clean == {i for i, text in enumerate(texts) if not brute_hits(text, ITEMS)[1]}


def test_long_texts_are_searched_across_slices(monkeypatch):
    monkeypatch.setattr(decontamination, "_SLICE", 16)
    search = decontamination.WindowSearch([(str(i), (t or "").encode()) for i, t in ITEMS], 10)
    for text in hit_documents():
        n, spans, items = search.scan((text or "").encode())
        assert (n, sum(b - a for a, b in spans), sorted(items)) == brute_hits(text, ITEMS)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert token_counts.count_tokens(none, COUNTS).collect() == []
    assert byte_bpe.round_trip_digests(none, RANKS, public_tokenizers.PATTERN).collect() == []
    assert decontamination.contamination(none, items).collect() == []
    clean = decontamination.contamination(rows(spark, ["a b"]), items).collect()
    assert (clean[0]["hits"]["n_words"], clean[0]["hits"]["n_hit"]) == (2, 0)
