"""A pipeline over ``documents``: quality rules, line dedup, near duplicates, substring dedup, packing.

Every stage works on all that the one before kept; its result is written to the
shared folder and read again. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylens.llm import jaccard, lines, packing, quality, substrings
from staylens.session import shared_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the quality rules."""
    return quality.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines."""
    return lines.drop_repeated(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    return jaccard.one_of_each(docs, shingle=5, percent=80)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of 20-word windows."""
    return substrings.drop_repeated(docs, window=20)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 2048."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_stage),
    ("substrings", substring_stage),
    ("packing", packing_stage),
]

#: The stages need tokenizers and byte comparisons that SQL can't express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = shared_path(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
