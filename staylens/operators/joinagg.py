"""Aggregates over a join without emitting the join's pairs.

``fact JOIN dim ON key`` followed by an aggregate multiplies rows: a key held
by m fact rows and k dim rows yields m*k pairs (a commercial host with a
third of all listings and several host rows; a listing id copied many
times). Every aggregate used here (counts, sums, means, second moments) is a
sum over pairs, so it can be computed from ONE partial aggregate per key and
side: each side is reduced per (key, group columns) with map-side partial
aggregation, the reduced sides are joined (one row per key and group), and
each side's sums are weighted by the other side's row count. The result is
exactly the aggregate over all pairs, but no pair is materialized and a hot
key never reaches one task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _side(df: DataFrame, key: str, groups: list[str], values: dict[str, Column], tag: str) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias(f"__n{tag}")]
    for name, v in values.items():
        aggs += [
            F.count(v).alias(f"__c{tag}_{name}"),
            F.sum(v.cast("double")).alias(f"__s{tag}_{name}"),
            F.sum(v.cast("double") * v.cast("double")).alias(f"__q{tag}_{name}"),
        ]
    return df.groupBy(key, *groups).agg(*aggs)


def weighted_pairs(fact: DataFrame, dim: DataFrame, key: str, fact_groups: list[str], dim_groups: list[str],
                   fact_values: dict[str, Column] | None = None, dim_values: dict[str, Column] | None = None) -> DataFrame:
    """One row per (key, fact groups, dim groups) with per-side counts/sums; the
    pair count of the row is ``__nf * __nd``."""
    f = _side(fact, key, fact_groups, fact_values or {}, "f")
    d = _side(dim, key, dim_groups, dim_values or {}, "d")
    return f.join(d, key)


def count_and_means(fact: DataFrame, dim: DataFrame, key: str, groups_fact: list[str], groups_dim: list[str],
                    means: dict[str, Column], count_name: str = "listing_count") -> DataFrame:
    """``count(*)`` and ``avg(v)`` over the join pairs, grouped by dim and fact columns."""
    j = weighted_pairs(fact, dim, key, groups_fact, groups_dim, means)
    aggs = [F.sum(F.col("__nf") * F.col("__nd")).cast("long").alias(count_name)]
    for n in means:
        aggs.append(F.try_divide(F.sum(F.col(f"__sf_{n}") * F.col("__nd")),
                                 F.sum(F.col(f"__cf_{n}") * F.col("__nd")).cast("double")).alias(n))
    return j.groupBy(*groups_dim, *groups_fact).agg(*aggs)


def pair_counts(fact: DataFrame, dim: DataFrame, key: str, groups_dim: list[str], count_name: str = "count") -> DataFrame:
    """``count(*)`` of the join pairs per dim group."""
    j = weighted_pairs(fact, dim, key, [], groups_dim)
    return j.groupBy(*groups_dim).agg(F.sum(F.col("__nf") * F.col("__nd")).cast("long").alias(count_name))


def pair_moments(fact: DataFrame, dim: DataFrame, key: str, ys: dict[str, Column], x: Column,
                 groups_dim: list[str] | None = None) -> DataFrame:
    """Centred moments of (x from dim, each y from fact) over the join pairs with both
    values present, one row per target (and dim group): target, n, mean_x, mean_y,
    sxx, syy, sxy, where the last three are sums of products of deviations.

    Sums of squares cancel when values are large against their spread, so nothing
    here is ever squared before it is centred: each key brings its count, mean and
    sum of squared deviations, and these are merged around the group's own means
    (the merge of Chan, Golub and LeVeque). The group means are a small table.
    """
    groups_dim = groups_dim or []
    aggs = []
    for t, y in ys.items():
        v = y.cast("double")
        aggs += [F.count(v).alias(f"__c_{t}"), F.avg(v).alias(f"__m_{t}"), (F.var_pop(v) * F.count(v)).alias(f"__q_{t}")]
    f = fact.groupBy(key).agg(*aggs)
    d = dim.where(x.isNotNull()).groupBy(key, *groups_dim, x.cast("double").alias("__x")).agg(F.count(F.lit(1)).alias("__k"))
    entries = F.explode(F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(f"__c_{t}").alias("c"), F.col(f"__m_{t}").alias("m"), F.col(f"__q_{t}").alias("q")) for t in ys
    ]))
    j = f.join(d, key).select(*groups_dim, "__x", "__k", entries.alias("e")).select(*groups_dim, "__x", "__k", "e.*").where(F.col("c") > 0)
    w = (F.col("__k") * F.col("c")).cast("double")
    by = ["target", *groups_dim]
    means = j.groupBy(*by).agg((F.sum(w * F.col("__x")) / F.sum(w)).alias("mean_x"), (F.sum(w * F.col("m")) / F.sum(w)).alias("mean_y"))
    # one map value for all groups (few: targets times dim groups): no second join of the keys
    label = F.to_json(F.struct(*by))
    lookup = means.agg(F.map_from_entries(F.collect_list(F.struct(label.alias("k"), F.struct("mean_x", "mean_y").alias("v"))))).scalar()
    j = j.withColumn("__g", F.element_at(lookup, label))
    j = j.withColumns({"mean_x": F.col("__g.mean_x"), "mean_y": F.col("__g.mean_y")})
    dx, dy = F.col("__x") - F.col("mean_x"), F.col("m") - F.col("mean_y")
    return j.groupBy(*by, "mean_x", "mean_y").agg(
        F.sum(F.col("__k") * F.col("c")).cast("long").alias("n"),
        F.sum(w * dx * dx).alias("sxx"),
        F.sum(F.col("__k") * F.col("q") + w * dy * dy).alias("syy"),
        F.sum(w * dx * dy).alias("sxy"),
    )
