"""The corpus pipeline: five stages over documents, each an operator of ``courtside.llm``.

Every stage works on all that its predecessor kept, and its decisions take effect: rejected
documents go. All but the last return the columns of ``documents``; the last returns the
tokens of what is left. Extra columns of the input, whatever their names, stay with their
rows, since stages only filter by the id or by an expression over the text.

SQL cannot express the trained and hashed stages, so there is no SQL for the whole; tests
compare each stage with a brute-force version.

Defined results: null and empty texts are rejected by the quality stage; a document without
an id stays in the filters by text and is never a duplicate; of rows that repeat an id and a
text, one stays; different texts of an id are documents of their own.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm import byte_bpe, decontamination, jaccard_join, language_id, quality
from courtside.llm.staging import Shared, shared_folder

#: A document stays if its quality is at least this, and if the certainty of its language is.
LEAST_QUALITY, LEAST_CERTAINTY = 0.3, 0.4


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is high enough. Labels of the held-out fold are not used."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.score(F.col("text"), model) >= LEAST_QUALITY)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognisable language: with letters, and not too uncertain."""
    predicted = language_id.predict(F.col("text"), language_id.fit(docs))
    return docs.where((predicted["lang_pred"] != "und") & (predicted["score"] >= LEAST_CERTAINTY))


def keyed(spark: SparkSession, docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with a number of each different id and text: the id, or for further texts of an
    id a number beyond all ids."""
    shared = Shared(spark)
    ids = docs.where("doc_id IS NOT NULL")
    repeated = ids.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    repeated = shared.table(repeated.select(F.col("doc_id").alias("_id")))
    digest = F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit(""))
    texts = ids.select("doc_id", digest.alias("digest"))
    texts = texts.join(repeated, F.col("doc_id") == F.col("_id"), "left_semi").distinct()
    first = texts.groupBy("doc_id").agg(F.min("digest").alias("first"))
    further = texts.join(first, "doc_id").where("digest <> first")
    further = shared.table(further.select("doc_id", "digest", F.monotonically_increasing_id().alias("n")))
    low, high = ids.agg(F.min("doc_id"), F.max("doc_id")).first()
    span = further.agg(F.max("n")).first()[0]
    if span is None:
        return docs.withColumn(key, F.col("doc_id").cast("long"))
    if high + span + 1 < 2**63:
        number = F.lit(high + 1).cast("long") + F.col("n")
    elif low - span - 1 >= -(2**63):
        number = F.lit(low - 1).cast("long") - F.col("n")
    else:
        raise ValueError("ids leave no numbers for the texts that repeat an id")
    marked = docs.withColumn(f"{key}_digest", digest)
    named = further.select(F.col("doc_id").alias(f"{key}_id"), F.col("digest").alias(f"{key}_text"), number.alias(f"{key}_new"))
    same = (marked["doc_id"] == named[f"{key}_id"]) & (marked[f"{key}_digest"] == named[f"{key}_text"])
    found = marked.join(named, same, "left").withColumn(key, F.coalesce(F.col(f"{key}_new"), marked["doc_id"].cast("long")))
    return found.drop(*[f"{key}_{x}" for x in ("id", "text", "new", "digest")])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class of similar texts."""
    key = f"key_{uuid.uuid4().hex}"
    numbered = keyed(spark, docs, key)
    classes = jaccard_join.similar_texts(numbered.select(F.col(key).alias("doc_id"), "text"))
    first = classes.where(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias("_id")).distinct()
    kept = numbered.join(first, numbered[key] == first["_id"], "left_semi").dropDuplicates([key]).drop(key)
    return kept.unionByName(docs.where("doc_id IS NULL"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean(docs, benchmark)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The byte-level token ids of each document, their number and digest, and the digest of
    what they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip_digests(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality classifier", good_quality),
    ("language id", known_language),
    ("near duplicates", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("byte-level tokens", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES, 1):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
