"""Window-style operators (WIN-1 .. WIN-7).

Skew notes: keep-first dedup and latest-per-key are written as aggregations of
a struct (``min`` / ``max_by``), which Spark aggregates partially map-side, so a
key holding a third of all rows is reduced before the shuffle instead of being
sorted inside one window task. Top-n uses ``row_number() <= n``, for which
Spark inserts a partial WindowGroupLimit before the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order_col: str = "id") -> DataFrame:
    """WIN-3: one row per key (nulls equal), the one with the smallest ``order_col``.

    Rows with a null order value lose to any non-null one.
    """
    others = [c for c in df.columns if c not in keys]
    pick = F.struct(
        F.col(order_col).isNull().alias("__null_order"),
        *[F.col(c) for c in ([order_col] if order_col in others else [])],
        *[F.col(c) for c in others if c != order_col],
    )
    agg = df.groupBy(*keys).agg(F.min(pick).alias("__first"))
    return agg.select(*keys, *[F.col(f"__first.{c}").alias(c) for c in others]).select(*df.columns)


def duplicates_removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows removed by a dedup: one union of two counts, no join."""
    tagged = before.select(F.lit(1).alias("d")).unionByName(after.select(F.lit(-1).alias("d")))
    return tagged.agg(F.sum("d").cast("long").alias("removed"))


def share_of_total(agg: DataFrame, count_col: str = "count", out: str = "pct") -> DataFrame:
    """WIN-1/2 on an already aggregated (small) frame: count / sum(count) * 100."""
    total = F.sum(F.col(count_col)).over(Window.partitionBy())
    return agg.withColumn(out, F.col(count_col).cast("double") / total * 100)


def mix_insight(shares: DataFrame, label_col: str, count_col: str = "count", pct_col: str = "pct") -> DataFrame:
    """WIN-1 summary: top label and share; combined share of the two smallest groups
    (the second smallest counts as 0 unless there are more than two groups)."""
    ordered = shares.select(
        F.col(label_col), F.col(count_col), F.col(pct_col),
        F.row_number().over(Window.orderBy(F.col(count_col).desc(), F.col(label_col).asc_nulls_last())).alias("r_desc"),
        F.row_number().over(Window.orderBy(F.col(count_col).asc(), F.col(label_col).desc_nulls_first())).alias("r_asc"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("n"),
    )
    return ordered.agg(
        F.max_by(F.col(label_col), -F.col("r_desc")).alias("top_label"),
        F.max(F.when(F.col("r_desc") == 1, F.col(pct_col))).alias("top_pct"),
        (
            F.coalesce(F.max(F.when(F.col("r_asc") == 1, F.col(pct_col))), F.lit(0.0))
            + F.coalesce(F.max(F.when((F.col("r_asc") == 2) & (F.col("n") > 2), F.col(pct_col))), F.lit(0.0))
        ).alias("smallest_two_pct"),
    )


def rank_within(df: DataFrame, group: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """WIN-4: 1-based position inside each group (deterministic order expected)."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """WIN-5/6: the first ``n`` rows of each group."""
    ranked = rank_within(df, group, order, rank_col)
    return ranked.where(F.col(rank_col) <= n)


def latest_per_key(df: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """WIN-7: the latest event per key (partial aggregation, no window sort)."""
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]), F.col(ts_col)).alias("__last"))
    return agg.select(*keys, *[F.col(f"__last.{c}").alias(c) for c in others])
