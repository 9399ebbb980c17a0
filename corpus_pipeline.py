"""A corpus made ready for training, one operator of ``factloom.llm`` per stage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import decontaminate, language, packing, secret_scan, simhash
from factloom.llm.queries import BYTE_BPE
from factloom.llm.text import in_fold
from factloom.session import configure, shared_folder


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the others (NULL text or no letter) go."""
    models = language.learn_languages(docs.filter(~in_fold("doc_id", 4, 2)))
    return language.identify(docs, models).filter("lang_pred <> 'und'").select("doc.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the least doc_id, NULLs last, then the first row."""
    return simhash.one_per_component(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; decided by text, so rows without an id are no exception."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts = docs.select(F.xxhash64(docs["text"]).alias("doc_id"), docs["text"])
    held = decontaminate.contaminated(texts, bench).select(F.col("doc_id").alias("held")).distinct()
    return docs.join(held, F.xxhash64(docs["text"]) == held["held"], "left_anti")


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with confirmed secrets masked where they stand and n_chars counted anew."""
    masked = secret_scan.without_secrets(docs, "source" if "source" in docs.columns else None)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their windows."""
    return packing.pack(docs, BYTE_BPE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_copies", without_copies),
    ("benchmark", without_benchmark),
    ("secrets", secrets_masked),
    ("packing", packed),
]

#: Fingerprints, cross-parsing and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again by the next."""
    configure(spark)
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
