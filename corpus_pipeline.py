"""A corpus pipeline: five stages, each a table of documents in and out, the last one packed sequences.

Each stage works on all documents that its predecessor kept; what it decides
takes effect. All but the last return the columns of ``documents``. Stages are
written as Parquet and read again, so a stage that fails starts from its
predecessor's table. The mixing stage writes documents in training order; packing
takes their places in that table, and its sequences come out in that order, each with
the mean place of its pieces as ``position``.

Defined cases. Null and empty texts: never toxic by themselves, all equal to each
other, near copies of nothing; packed as the end token alone. Null ids and sources:
kept, null sources are one source. Repeated rows: exact copies of each other. Ties
fall to the smaller doc_id. Empty tables give empty tables. Very long texts are read
whole. Further columns pass through under any name.
"""

from __future__ import annotations

from clickloom.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from clickloom.llm.common import free_name, stored_order
from clickloom.llm.production import TOKENIZER, TOXIC, toxicity_model
from clickloom.session import fresh_folder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold (4)."""
    held = free_name("score__", docs)
    score = toxicity.toxicity("text", *toxicity_model(spark, sf_dir))
    return docs.withColumn(held, score).where(F.col(held) < TOXIC).drop(held)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts (10)."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8 (2)."""
    return near_dedup.drop_near_duplicates(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks, in training order (9)."""
    held = free_name("mix__", docs)
    mixed = mixing.mix(docs, mixing.plan_mix(docs), column=held)
    return mixing.in_training_order(mixed, held).drop(held)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in the order of the stored documents (3)."""
    return packing.pack(docs, **TOKENIZER, position=stored_order(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A trained classifier, hashed signatures and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
