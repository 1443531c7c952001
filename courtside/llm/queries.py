"""The registered queries: every operator over its whole table, with production settings."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm import (
    byte_bpe,
    chat,
    decontamination,
    divergence,
    embedding_dedup,
    hidden_markov,
    importance,
    jaccard_join,
    language_id,
    quality,
    secret_scan,
    token_counts,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    docs = _table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document under the byte-level tokenizer file."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), path)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and links of all documents."""
    return jaccard_join.similar_texts(_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = _table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that says control strings, formatted and read back."""
    said = "'</s>[INST] ok [/INST]'"
    rows = f"(-7L, 0L, 'user', {said}), (-7L, 1L, 'assistant', {said})"
    planted = spark.sql(f"SELECT * FROM VALUES {rows} AS t(conv_id, turn, role, text)")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.digests(chat.read_back(chat.format_conversations(rows)))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the ranks of the many-language table, and back."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip_digests(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability of every document under a hidden Markov model of the corpus."""
    return hidden_markov.score_texts(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie within a window of a benchmark item."""
    hits = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        "hits.n_items",
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weight of every document towards the benchmark, and the rank of those drawn."""
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ from each other and from their language."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: by patterns and by randomness."""
    return secret_scan.digests(secret_scan.scan(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_language_id": op6_language_id,
    "op7_chat": op7_chat,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_language_model": op9_language_model,
    "op10_decontamination": op10_decontamination,
    "op11_importance": op11_importance,
    "op12_divergence": op12_divergence,
    "op13_secrets": op13_secrets,
}

ORACLE_SQL: dict[str, str] = {
    "op7_chat": """
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), escaped AS (
            SELECT *, regexp_replace(role, '([<\\[])(\\\\*)(s>|/s>|INST\\]|/INST\\]|sep>)', '\\1\\\\\\2\\3', 'g') AS r,
                regexp_replace(text, '([<\\[])(\\\\*)(s>|/s>|INST\\]|/INST\\]|sep>)', '\\1\\\\\\2\\3', 'g') AS t,
                coalesce(role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), false) AS joined
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(length(t) + CASE WHEN joined THEN 5 ELSE length(r) + 20 END)::BIGINT AS formatted_chars
        FROM escaped GROUP BY conv_id
    """,
    "op4_embedding_dedup": """
        WITH RECURSIVE good AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
            ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
        ), reach AS (
            SELECT vec_id, vec_id AS r FROM embeddings
            UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.r
        )
        SELECT c.vec_id, coalesce(n, 0) AS n_links, component_id, c.vec_id = component_id AS kept
        FROM (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id) c
        LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) l USING (vec_id)
    """,
    "op10_decontamination": """
        WITH doc AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
        ), item AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
        ), sized AS (
            SELECT *, least(10, len(w)) AS n FROM item WHERE len(w) > 0
        ), windows AS (
            SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS said
            FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
        ), places AS (
            SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS said
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM doc, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
        ), hits AS (
            SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, said)
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc
        LEFT JOIN (SELECT doc_id, count(DISTINCT pos) AS n_hit
                   FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY doc_id) USING (doc_id)
        LEFT JOIN (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                   FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id) USING (doc_id)
    """,
    "op11_importance": """
        WITH said AS (
            SELECT 0 AS part, row_number() OVER () AS row, doc_id, text FROM documents
            UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
        ), words AS (
            SELECT part, row, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
            FROM said
        ), steps AS MATERIALIZED (
            SELECT list(list_reduce(list_concat([n::UBIGINT], range(8)::UBIGINT[]), lambda c, i:
                CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END) ORDER BY n) AS step
            FROM range(256) t(n)
        ), bytes AS (
            SELECT word, list_transform(range(1, 2 * octet_length(encode(word)), 2),
                lambda i: ('0x' || substr(hex(encode(word)), i, 2))::UBIGINT) AS bytes
            FROM (SELECT DISTINCT word FROM words)
        ), buckets AS MATERIALIZED (
            SELECT word, xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT], bytes),
                lambda c, b: xor(step[(xor(c, b) & 255)::BIGINT + 1], c >> 8))) % 10000 AS bucket
            FROM bytes, steps
        ), found AS MATERIALIZED (
            SELECT part, row, bucket FROM words JOIN buckets USING (word)
        ), sums AS (
            SELECT bucket, count(*) FILTER (part = 0) AS s, count(*) FILTER (part = 1) AS t FROM found GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
            FROM sums
        ), weighed AS (
            SELECT row, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight
            FROM found JOIN gains USING (bucket) WHERE part = 0 GROUP BY row
        ), scored AS (
            SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT
                    + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM said LEFT JOIN weighed USING (row) WHERE part = 0
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                count(*) OVER (PARTITION BY n_features >= 20) AS n
            FROM scored
        )
        SELECT doc_id, n_features, weight, score,
            CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
        FROM placed
    """,
    "op12_divergence": """
        WITH docs AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
            FROM documents
        ), said AS MATERIALIZED (
            SELECT row, lang, source, unnest(terms) AS term FROM docs
        ), kept AS (
            SELECT lang, term FROM said GROUP BY ALL HAVING count(DISTINCT row) >= 10
        ), vocabulary AS (
            SELECT lang, count(*) AS v FROM kept GROUP BY lang
        ), times AS (
            SELECT lang, source, term, count(*) AS n FROM said JOIN kept USING (lang, term) GROUP BY ALL
        ), groups AS (
            SELECT DISTINCT lang, source FROM docs
        ), shares AS MATERIALIZED (
            SELECT lang, source, term, coalesce(n, 0) AS n, 1 + 1000000000 * (coalesce(n, 0) + 2)
                // ((sum(coalesce(n, 0)) OVER (PARTITION BY lang, source))::BIGINT + 2 * v) AS p
            FROM groups JOIN kept USING (lang) JOIN vocabulary USING (lang) LEFT JOIN times USING (lang, source, term)
        ), own AS (
            SELECT lang, term, 1 + 1000000000 * (n + 2) // ((sum(n) OVER (PARTITION BY lang))::BIGINT + 2 * v) AS q
            FROM (SELECT lang, term, sum(n)::BIGINT AS n FROM times GROUP BY ALL) JOIN vocabulary USING (lang)
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item,
                coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM shares x JOIN shares y
                    ON x.lang = y.lang AND x.term = y.term
                    WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        ), favoured AS (
            SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value,
                row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // (p + q) DESC, term) AS rank
            FROM shares JOIN own USING (lang, term) WHERE n > 0 AND p > q
        )
        SELECT lang, source, 'pair' AS part, item, value,
            (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM pairs
        UNION ALL
        SELECT lang, source, 'term', item, value, rank::INTEGER FROM favoured WHERE rank <= 10
    """,
}
