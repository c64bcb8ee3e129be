"""Incremental keep-first (WIN-3, JOB-4): the kept row of every key, maintained over landings.

The kept rows are a snapshot table in buckets by key hash. A landing is first
reduced to its own first rows (map-side combine, so a hot key leaves a task once).
Of the buckets it falls into, only keys and order values are read to see which of
its rows are new or come before the kept one; only buckets with such rows are
read whole, merged and replaced, in one commit. A landing that brings nothing new
commits nothing. Landings can come in any order and again: the result is that of
one keep-first over all of them (rows that tie on key and order fall to the
smallest by the other columns, in column order, as in ``windows.keep_first``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.operators.windows import keep_first
from staylens.sources import snapshots

BUCKET = "__bucket"


def _first_of(df: DataFrame, keys: list[str], order_col: str, buckets: int) -> DataFrame:
    return keep_first(df, keys, order_col).withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _values(df: DataFrame) -> list[str]:
    """The buckets that rows fall into (at most as many as there are buckets)."""
    return [str(r[BUCKET]) for r in df.select(BUCKET).distinct().collect()]


def land(landing: DataFrame, table: str, keys: list[str], order_col: str = "id", buckets: int = 64) -> snapshots.Snapshot | None:
    """Merge a landing into the kept rows at ``table``; the newest version (None while there is none).

    ``buckets`` counts for the first landing; later ones keep the table's own.
    """
    spark = landing.sparkSession
    base = snapshots.current(spark, table)
    if base is not None:
        buckets = base.meta["buckets"]
    meta = {"buckets": buckets, "keys": keys}
    new = _first_of(landing, keys, order_col, buckets)
    if base is None:
        return snapshots.replace_parts(new, table, BUCKET, meta) if not new.isEmpty() else None
    touched = _values(new)
    if not touched:
        return base
    kept = snapshots.read(spark, table, base, touched)
    others = [c for c in landing.columns if c not in keys]
    rank = F.struct(F.col(order_col).isNull(), F.col(order_col), *[F.col(c) for c in others if c != order_col])
    left = new.select(*keys, BUCKET, rank.alias("__new")).alias("n")
    right = kept.select(*keys, BUCKET, rank.alias("__kept")).alias("k")
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in keys]
    better = left.join(right, [F.col(f"n.{BUCKET}") == F.col(f"k.{BUCKET}"), *same], "left").where(
        F.col("__kept").isNull() | (F.col("__new") < F.col("__kept"))).select(F.col(f"n.{BUCKET}").alias(BUCKET))
    changed = _values(better)
    if not changed:
        return base
    old = snapshots.read(spark, table, base, changed).drop(BUCKET)
    ours = new.where(F.col(BUCKET).isin([int(v) for v in changed])).drop(BUCKET)
    return snapshots.replace_parts(_first_of(old.unionByName(ours), keys, order_col, buckets), table, BUCKET, meta)


def kept_rows(spark, table: str) -> DataFrame:
    """The kept rows of the newest version."""
    return snapshots.read(spark, table).drop(BUCKET)
