"""The corpus pipeline: quality rules, line dedup, near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and reads the whole table that the one before
kept.  All but the last return the columns of ``documents``; a text that a stage changes
has its ``n_chars`` counted anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatt.llm import jaccard, line_dedup, packing, quality, substring_dedup
from fleetwatt.session import configure, shared_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines too frequent in their host go from the others."""
    return _documents(quality.keep_good(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier one repeats go; a document may be left empty."""
    return _documents(line_dedup.drop_repeated_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Candidates are texts whose SimHash fingerprints differ in three bits or less, and those
    of MinHash bands that three bits do not reach; near are those of similarity 0.8 (five-word
    shingles).
    """
    return jaccard.one_of_each(docs).select(*COLUMNS)


def dedup_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 20-word passages that start earlier in the corpus go."""
    kept = substring_dedup.remove_repeats(docs, layout=True, carry=("lang", "source"))
    return _documents(kept.withColumnRenamed("kept_text", "text"))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences, as pieces of documents with their ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", dedup_substrings),
    ("packing", pack_tokens),
]

#: Fingerprints and tokens are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
