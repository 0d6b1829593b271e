"""The training-data pipeline over ``documents``: five stages, each written and read again.

Language ID and decontamination filter, the near-duplicate stage keeps one row of each class, that
with the smallest id, the mixture repeats and drops documents as its flow says, and the last stage writes the
token store and returns its index.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import chosen_path, decontaminate, language, mixture, token_store
from newsloom.session import broadcast_if_small, shared_dir, spread, stage

MIN_COSINE = 0.1  # a document long enough to tell is rejected where no language's prototype is nearer


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and text are not in ``gone`` (``id, text_key``); a null id is an id."""
    gone = gone.select(F.col("id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    gone = broadcast_if_small(stage(gone, "dropped-documents"))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_key"]), "left_anti")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that the labelled ones teach; those without letters or clearly like none go."""
    model = language.learn(docs, MIN_COSINE)
    return language.keep_identified(docs, model.prototypes, MIN_COSINE, bounds=model.bounds, letters=model.letters)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates, that with the smallest id."""
    return chosen_path.one_of_each_class(docs)


def keep_clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word of a benchmark window."""
    hits, _ = decontaminate.find_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, hits)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    key = F.xxhash64("text").alias("text_key")
    sized = docs.select("doc_id", F.array("source").alias("members"), mixture.word_count("text").alias("size"), key)
    mixed = mixture.mix(sized, mixture.source_weights(docs), told_by=["text_key"]).where("copies > 0")
    # the mixture's columns come in one struct, beside the documents' own in another
    mixed = mixed.groupBy("doc_id", "text_key").agg(F.max("copies").alias("copies")).select(
        F.struct("doc_id", "text_key", "copies").alias("mixed"))
    joined = docs.select(F.struct("*").alias("doc"), key).join(
        mixed, F.col("doc.doc_id").eqNullSafe(F.col("mixed.doc_id")) & (F.col("text_key") == F.col("mixed.text_key")))
    return joined.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mixed.copies"))).alias("copy")).select("doc.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token store of all documents that are left, repeats included."""
    files, dictionary = token_store.write_store(
        docs, public_tokenizers.path("word_bpe_49k.json"), shared_dir(spark, "token-store"))
    return token_store.read_store(files, dictionary)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("near_duplicates", keep_one_of_each_class),
    ("decontamination", keep_clean_of_benchmark),
    ("mixture", mix_to_weights),
    ("token_store", write_tokens),
]

ORACLE_SQL: str | None = None  # signatures, prototypes and tokenizers are not for SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each hands on lies in the shared folder."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")
    for name, apply in STAGES[:-1]:
        path = shared_dir(spark, name)
        apply(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
