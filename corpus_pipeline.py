"""A training corpus made of the documents: identified, deduplicated, decontaminated and packed.

Each stage works on all that the one before it kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mapledger.llm import decontamination, language_crf, minhash, packing
from mapledger.llm.queries import tokenizer_path
from mapledger.session import stage

# five-word shingles of this Jaccard similarity make near duplicates
SIMILARITY_PERCENT = 80


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those without a text or a letter go.

    Null ids and repeated rows stay as they are; no documents give no rows.
    """
    return language_crf.with_language(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id.

    Ids that are null come last; of repeated rows one stays. Documents without
    words are in no group.
    """
    return minhash.one_of_each(docs, SIMILARITY_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, packed into sequences."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify),
    ("MinHash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

# no SQL expresses the field, the sketches or the tokenizer
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, apply) in enumerate(STAGES):
        docs = stage(apply(spark, docs, sf_dir), f"stage-{number}")
    return docs
