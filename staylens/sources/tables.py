"""Parquet table sources (SRC-5): named tables under one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


_PLANS: dict[tuple, DataFrame] = {}


def session_key(spark: SparkSession) -> tuple:
    """Identity of a live session: object id plus application id (a new context
    that happens to reuse an object id never sees another session's plans)."""
    return (id(spark), spark.sparkContext.applicationId)


def version(spark: SparkSession, path: str) -> tuple[int, int]:
    """Modification time and size of a file or folder: changes when its content is replaced."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    status = p.getFileSystem(conf).getFileStatus(p)
    return status.getModificationTime(), status.getLen()


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Vectorized Parquet scan; callers select columns so the scan is pruned.

    The lazy scan plan is memoized per session, path and version of the table, so
    the file listing and footer schema are resolved once, not on every query (no
    data is cached), and a replaced table is read anew.
    """
    path = table_path(base, name)
    key = (*session_key(spark), path, version(spark, path))
    df = _PLANS.get(key)
    if df is None:
        df = spark.read.parquet(table_path(base, name))
        _PLANS[key] = df
    return df


def memo_plan(spark: SparkSession, key: tuple, build) -> DataFrame:
    """Memoize a lazily built DataFrame (a plan, not data) per session."""
    k = (*session_key(spark), *key)
    df = _PLANS.get(k)
    if df is None:
        df = build()
        _PLANS[k] = df
    return df


def register_views(spark: SparkSession, base: str, names: dict[str, str]) -> dict[str, DataFrame]:
    """SRC-5 / SNK-3: expose tables of a folder as temp views (view name: table folder)."""
    out = {}
    for view, table in names.items():
        out[view] = spark.read.parquet(f"{base.rstrip('/')}/{table}")
        out[view].createOrReplaceTempView(view)
    return out


def union_all(frames: list[DataFrame]) -> DataFrame:
    """SET-1: concatenate chunks / files / cities by column name; a column missing
    in one input is null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan over all cores when it has fewer splits than the cluster's
    parallelism (e.g. an unsplittable single-row-group file); otherwise unchanged,
    so at scale (many splits) it adds no shuffle.

    Apply it to a plain scan (+ projection): its split count comes from the file
    listing without running a job. (On a plan with exchanges, asking for the
    partition count would make adaptive execution run those stages.)"""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
