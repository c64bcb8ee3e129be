"""Aggregations (AGG-1 .. AGG-14).

All grouped statistics are declarative aggregates (count, avg, sum, count_if,
min/max_by), which Spark computes partially map-side, so a hot group (one
area holding a third of the listings) is reduced to one partial row per map
task before the shuffle. Report-sized outputs only; nothing is collected.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """AGG-1: rows per table plus a grand total row (one union, no joins)."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    total = counts.agg(F.sum("row_count").cast("long").alias("row_count")).select(F.lit("total").alias("table_name"), "row_count")
    return counts.unionByName(total)


def kpis(listings: DataFrame, price: str = "price", reviews: str = "number_of_reviews", cutoff: float = 5000) -> DataFrame:
    """AGG-2 (+JOIN-5 as one scan): total rows; averages over rows under the price cut-off."""
    under = F.col(price) < cutoff
    return listings.agg(
        F.count(F.lit(1)).cast("long").alias("total_listings"),
        F.avg(F.when(under, F.col(price))).alias("avg_price"),
        F.avg(F.when(under, F.col(reviews))).alias("avg_reviews"),
    )


def group_stats(df: DataFrame, keys: list[str], value: str = "price", count_name: str = "listing_count",
                avg_name: str = "avg_price") -> DataFrame:
    """AGG-3 / AGG-5 / AGG-9: count and mean per group (null keys form a group)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias(count_name), F.avg(value).alias(avg_name))


def count_by(df: DataFrame, key: str, out: str = "count") -> DataFrame:
    """AGG-4: rows per value of a nullable key (null is its own group)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).cast("long").alias(out))


def conditional_means(df: DataFrame, flags: dict[str, str], value: str = "price") -> DataFrame:
    """AGG-6: mean of ``value`` with / without each flag in one scan, plus the premium.

    A null flag counts in neither side.
    """
    aggs = []
    for label, flag in flags.items():
        aggs.append(F.avg(F.when(F.col(flag), F.col(value))).alias(f"with_{label}"))
        aggs.append(F.avg(F.when(~F.col(flag), F.col(value))).alias(f"without_{label}"))
    out = df.agg(*aggs)
    return out.withColumns({f"{label}_premium": F.col(f"with_{label}") - F.col(f"without_{label}") for label in flags})


def occupancy_by_area(calendar: DataFrame, geography: DataFrame, area: str = "neighbourhood",
                      key: str = "listing_id", available: str = "available") -> DataFrame:
    """AGG-8: occupancy = not-available days / all days, and listings, per area.

    The calendar (the largest table) is first reduced to one row per listing
    (partial aggregation before its shuffle); only those per-listing partials
    meet the geography, so the full calendar is never shuffled for the join.
    A null ``available`` counts in the denominator only.
    """
    per_listing = calendar.groupBy(key).agg(
        F.count(F.lit(1)).alias("__days"), F.count_if(~F.col(available)).alias("__booked")
    )
    joined = per_listing.join(geography.select(key, area), key)
    return joined.groupBy(area).agg(
        (F.sum("__booked").cast("double") / F.sum("__days").cast("double")).alias("occupancy_rate"),
        F.count_distinct(key).cast("long").alias("listing_count"),
    )


def category_list(df: DataFrame, column: str) -> DataFrame:
    """AGG-11: sorted distinct non-null values."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def extremes(grouped: DataFrame, label: str, value: str) -> DataFrame:
    """AGG-12: highest / lowest group by value and the spread (ties -> smallest label)."""
    g = grouped.where(F.col(value).isNotNull())
    return g.agg(
        F.min_by(F.col(label), F.struct(-F.col(value), F.col(label))).alias("highest_label"),
        F.max(value).alias("highest_value"),
        F.min_by(F.col(label), F.struct(F.col(value), F.col(label))).alias("lowest_label"),
        F.min(value).alias("lowest_value"),
    ).withColumn("spread", F.col("highest_value") - F.col("lowest_value"))


def histogram(df: DataFrame, value: str, bins: int = 50, upper_cut: float | None = None,
              weight: str | None = None) -> DataFrame:
    """AGG-13: equal-width bins between min and max, the last edge inclusive.

    One pass for (min, max), one grouped count. The max falls into bin n+1 of
    the plain formula, so it is clipped to n; when min == max every value is
    bin 1. ``weight`` counts a row that many times (rows of a join that was
    aggregated instead of materialized).
    """
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    src = df.select(F.col(value).alias("v"), w.alias("w")).where(F.col("v").isNotNull() & (F.col("w") > 0))
    if upper_cut is not None:
        src = src.where(F.col("v") < upper_cut)
    # the rows are first counted per value, with map-side combine: bounds and bins both come
    # from that, so whatever stands below (a join) is planned and run once
    src = src.groupBy("v").agg(F.sum("w").alias("w"))
    bounds = src.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    withb = src.withColumns({"lo": bounds.getField("lo"), "hi": bounds.getField("hi")})
    # bin = floor((v - lo) / (hi - lo) * n) + 1, the max clipped into the last bin.
    b = F.when(F.col("hi") == F.col("lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1, F.lit(bins))
    )
    counted = withb.groupBy(b.cast("int").alias("bin"), "lo", "hi").agg(F.sum("w").cast("long").alias("count"))
    width = (F.col("hi") - F.col("lo")) / bins
    return counted.select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_start"),
        F.when(F.col("bin") == bins, F.col("hi")).otherwise(F.col("lo") + F.col("bin") * width).alias("bin_end"),
        "count",
    )


def profile(df: DataFrame, columns: list[str] | None = None, quantiles: bool = True) -> DataFrame:
    """AGG-14: per-column profile, unpivoted to (column_name, metric, value).

    count, nulls, distinct, min, max, mean, std, zeros and quantiles p05, p25, p50,
    p75, p95 for numeric columns; count, nulls, distinct for others. Everything but
    the distinct counts is one scan with map-side aggregates; quantiles come from
    mergeable sketches (``percentile_approx``, relative rank error 1 / 100,000, about
    a megabyte a column).
    Exact distinct counts come from ``value_counts``, so no row is copied once per column.
    """
    cols = columns or df.columns
    types = dict(df.dtypes)
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    aggs: list[Column] = []
    metrics: list[tuple[str, str, str]] = []
    sketches: dict[str, Column] = {}

    def add(colname: str, metric: str, expr: Column):
        alias = f"__m{len(aggs)}"
        aggs.append(expr.cast("double").alias(alias))
        metrics.append((colname, metric, alias))

    for c in cols:
        x = F.col(c)
        add(c, "count", F.count(x))
        add(c, "nulls", F.count_if(x.isNull()))
        if types.get(c) in numeric:
            add(c, "min", F.min(x))
            add(c, "max", F.max(x))
            add(c, "mean", F.avg(x))
            add(c, "std", F.stddev_samp(x))
            add(c, "zeros", F.count_if(x == 0))
            if quantiles:
                sketches[c] = F.percentile_approx(x, [q / 100 for q in QUANTILES], 100_000).alias(f"__q{len(sketches)}")
    one = df.agg(*aggs, *sketches.values())
    values = [(c, m, F.col(a)) for c, m, a in metrics]
    values += [(c, f"p{q:02d}", F.get(f"__q{i}", F.lit(j)).cast("double")) for i, c in enumerate(sketches) for j, q in enumerate(QUANTILES)]
    entries = [F.struct(F.lit(c).alias("column_name"), F.lit(m).alias("metric"), v.alias("value")) for c, m, v in values]
    rows = one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    # a column's row without a value stands for the column itself, so one that is all null counts 0
    distinct = value_counts(df, cols).groupBy("column_name").agg(F.count("value").cast("double").alias("value"))
    return rows.unionByName(distinct.select("column_name", F.lit("distinct").alias("metric"), "value"))


#: Per cent.
QUANTILES = (5, 25, 50, 75, 95)


class _Dictionary:
    """Counts of a column's distinct values over the batches of a task."""

    def __init__(self, name: str) -> None:
        self.name, self.parts, self.held, self.base = name, [], 0, 0

    def add(self, column: pa.Array) -> None:
        counts = pc.value_counts(column.drop_null())
        self.parts.append(pa.table({"value": counts.field("values"), "count": counts.field("counts")}))
        self.held += len(counts)

    def combine(self) -> None:
        if len(self.parts) > 1:
            one = pa.concat_tables(self.parts).group_by("value").aggregate([("count", "sum")])
            self.parts = [pa.table({"value": one.column("value"), "count": one.column("count_sum")})]
            self.held = one.num_rows
        self.base = self.held

    def rows(self) -> pa.Table | None:
        """What is held, as (column_name, value, count), and nothing held after."""
        self.combine()
        if not self.parts:
            return None
        one, self.parts, self.held, self.base = self.parts[0], [], 0, 0
        return pa.table({"column_name": pa.array([self.name] * one.num_rows, pa.string()), "value": one.column("value"), "count": one.column("count")})


def _dictionaries(names: list[str], most: int):
    """Batches of text columns to (column_name, value, count): each value once a task, as long as its dictionary
    fits; a column with more than ``most`` values in a task (an id, a free text) is handed on in parts."""

    def run(batches):
        columns = [_Dictionary(n) for n in names]
        yield pa.RecordBatch.from_pydict({"column_name": names, "value": pa.array([None] * len(names), pa.string()), "count": pa.array([0] * len(names), pa.int64())})
        for batch in batches:
            for d, column in zip(columns, batch.columns):
                d.add(column)
                if d.held > 2 * d.base + most // 4:
                    d.combine()
                if d.held > most:
                    yield from d.rows().to_batches(max_chunksize=10_000)
        for d in columns:
            if (rest := d.rows()) is not None:
                yield from rest.to_batches(max_chunksize=10_000)

    return run


def value_counts(df: DataFrame, columns: list[str], most: int = 50_000) -> DataFrame:
    """(column_name, value, count) of every column's distinct values as text, and (column_name, null, 0) for every column.

    One scan: each task counts all columns in dictionaries over its column batches
    (Arrow, no row is made), so a value held by a third of all rows leaves a task
    once; the partial counts are then added up by column and value.
    """
    texts = df.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)])
    partial = texts.mapInArrow(_dictionaries(columns, most), "column_name string, value string, count long")
    return partial.groupBy("column_name", "value").agg(F.sum("count").cast("long").alias("count"))


def top_values(df: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """AGG-14 top values: the ``k`` most frequent non-null values of each column
    (ties by value), as (column_name, value, count, rank).

    From ``value_counts``, so the rows are read once; the top ``k`` per column then
    use a partial WindowGroupLimit.
    """
    from pyspark.sql import Window

    counts = value_counts(df, columns).where(F.col("value").isNotNull())
    w = Window.partitionBy("column_name").orderBy(F.col("count").desc(), F.col("value").asc())
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
