"""From raw documents to packed training sequences, by the operators of the llm package.

Each stage's rows are written as Parquet in the session's shared folder and read
again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logwarden.llm import mixing, near_dedup, packing, quality
from logwarden.session import stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's threshold."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates over five-word shingles."""
    return near_dedup.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source as often as its target weight asks for."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("near dedup", drop_near_duplicates),
    ("mix sources", mix_sources),
    ("pack sequences", pack_sequences),
]

#: The stages train a model and run a tokenizer, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
