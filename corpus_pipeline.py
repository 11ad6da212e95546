"""A cleaning pipeline over ``documents``: five stages, each applying one operator to all that the one before kept.

Null, empty and repeated rows, ties and extra columns are treated as each operator's module
states; an empty table passes through every stage as an empty table.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm import bpe, decontaminate, jaccard, language, secrets
from tablekit.storage import shared_root

#: The least cosine in a language where labelled texts give no level of their own: that of texts turned away from every language.
MIN_SCORE = 0.01
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of ``lang``; texts without a letter or less like it than its labelled texts go."""
    prototypes, levels = language.learn_with_levels(docs)
    return language.accepted(docs, prototypes, MIN_SCORE, levels=levels)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similarity 0.8 over five-word shingles hold together: that with the smallest id.

    Rows without id stay, as do documents without words. Of rows that repeat an id the one
    whose text is first in order stays, and of those the first by the other columns.
    """
    joined = jaccard.join(docs, n=5, num=80, den=100)
    gone = joined.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    single = docs.join(gone.union(repeated), "doc_id", "left_anti").select(*docs.columns)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    several = docs.join(repeated, "doc_id", "left_semi").join(gone, "doc_id", "left_anti")
    firsts = several.groupBy("doc_id").agg(F.min(F.struct("text", *others)).alias("row")).select("doc_id", "row.*")
    return single.union(firsts.select(*docs.columns))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that benchmark items share; documents that are mostly such words go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _with_length(decontaminate.remove(docs, items))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by a mark."""
    return _with_length(secrets.redact(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens`` and the SHA-256 of the ids and of the bytes decoded from them."""
    return bpe.digests(docs, VOCABULARY, keep=("lang", "source"))


STAGES = [
    ("language_id", keep_languages),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", remove_benchmark),
    ("secret_scans", redact_secrets),
    ("byte_level_bpe", encode),
]

#: SQL cannot express the first and the last stage; tests compare the rows with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
