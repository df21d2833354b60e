"""A training corpus from raw documents: quality rules, exact and near deduplication, surrogates, packing.

Every stage takes the documents that its predecessor kept, as a table read from files, and returns
their columns; the last returns token sequences. ``run`` writes each stage's result to the shared folder
and goes on from there, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.exact_dedup import drop_exact_duplicates
from tidemark.llm.jaccard_join import drop_near_duplicates
from tidemark.llm.packing import pack_powers
from tidemark.llm.quality import keep_good
from tidemark.llm.queries import SURROGATE_KEY, table, tokenizer_path
from tidemark.llm.surrogates import with_surrogates
from tidemark.session import settle

ORACLE_SQL = None  # tokens, proven cutoffs and keyed surrogates have no SQL form


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs proven on the labels."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest identifier."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingles at a similarity of 0.8."""
    return drop_near_duplicates(docs, width=5, num=80, den=100)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced; the length follows the text."""
    replaced = with_surrogates(docs, SURROGATE_KEY)
    length = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return replaced if length is None else replaced.withColumn("n_chars", length)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token sequences, each a power of two long and of one document."""
    return pack_powers(docs, tokenizer_path("byte_bpe_50k.json")).drop("uid")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("PII surrogates", surrogates),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = settle(docs)
    return docs
