"""Sampling and splits (SRT-5, ML-3): hash-based, so results do not depend on
partitioning, task retries or executor loss (a re-run task draws the same rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def hash_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Fixed-size sample: bottom-n rows by a seeded hash of the id.

    Planned as TakeOrderedAndProject: every partition keeps its n smallest,
    one task merges at most n rows per partition, so the sample size bounds
    the work of the final task regardless of table size.
    """
    return df.orderBy(hash_key(id_col, seed), F.col(id_col)).limit(n)


def split_bucket(id_col: str) -> Column:
    """0..99 from the first 8 hex digits of md5(id): the same value in SQL engines."""
    return F.pmod(F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("long"), F.lit(100))


def train_test_split(df: DataFrame, id_col: str, test_pct: int = 20) -> tuple[DataFrame, DataFrame]:
    """ML-3: deterministic 80/20 split by id hash (a partition of the rows)."""
    b = split_bucket(id_col)
    return df.where(b >= test_pct), df.where(b < test_pct)
