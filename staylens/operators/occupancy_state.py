"""Maintained occupancy (AGG-8): mergeable days and booked days of every listing and month.

The state is a snapshot table with one partition a month. A landing is summed up
by listing and month (map-side first, so a hot listing or month is combined
before it moves), added to the state of the months it touches, and only these
partitions are replaced, in one commit. Rates come from the state, which has a
row a listing and month instead of a row a day.

A null ``available`` counts as a day that is not booked. Rows without a date have
a month of their own (null), rows without a listing id are dropped (they join nothing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.sources import snapshots

KEYS = ["listing_id", "year", "month"]


def summarize(calendar: DataFrame) -> DataFrame:
    """listing_id, year, month, days, booked of calendar days."""
    return calendar.where("listing_id is not null").groupBy(*KEYS).agg(
        F.count(F.lit(1)).cast("long").alias("days"), F.count_if(~F.col("available")).cast("long").alias("booked"))


def merged(*states: DataFrame) -> DataFrame:
    """The sum of states."""
    one = states[0]
    for s in states[1:]:
        one = one.unionByName(s)
    return one.groupBy(*KEYS).agg(F.sum("days").cast("long").alias("days"), F.sum("booked").cast("long").alias("booked"))


def _month() -> F.Column:
    return F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0"))


def land(calendar: DataFrame, table: str) -> snapshots.Snapshot:
    """Add the days of a landing to the state at ``table``; months it has no day of are neither read nor written."""
    spark = calendar.sparkSession
    new = summarize(calendar)
    base = snapshots.current(spark, table)
    if base is None:
        return snapshots.replace_parts(new.withColumn("period", _month()), table, "period")
    touched = [r["period"] or snapshots.NULL_PART for r in calendar.where("listing_id is not null").select(_month().alias("period")).distinct().collect()]  # months, not rows
    if not touched:
        return base
    old = snapshots.read(spark, table, base, touched)
    every = old.select(*KEYS, "days", "booked").unionByName(new.select(*KEYS, "days", "booked"))
    return snapshots.replace_parts(_dealt(every), table, "period", dealt=True)


#: Tasks that may share a month.
SLICES = 16


def _dealt(states: DataFrame) -> DataFrame:
    """The sum of states, dealt once by month and slice of listings: summed and written from where the rows then are.

    A row moves once, not once for the sum and once for its month's files; a hot month is spread over its slices.
    """
    sliced = states.withColumns({"period": _month(), "slice": F.pmod(F.xxhash64("listing_id"), F.lit(SLICES)).cast("int")})
    summed = sliced.repartition("period", "slice").groupBy(*KEYS, "period", "slice").agg(
        F.sum("days").cast("long").alias("days"), F.sum("booked").cast("long").alias("booked"))
    return summed.select(*KEYS, "days", "booked", "period")


def occupancy(state: DataFrame, geography: DataFrame, area: str = "neighbourhood", key: str = "listing_id") -> DataFrame:
    """AGG-8: booked days by all days, and listings, per area. With both tables bucketed by ``key`` nothing is exchanged below the join."""
    per_listing = state.groupBy(key).agg(F.sum("days").alias("__days"), F.sum("booked").alias("__booked"))
    joined = per_listing.join(geography.select(key, area), key)
    return joined.groupBy(area).agg(
        (F.sum("__booked").cast("double") / F.sum("__days").cast("double")).alias("occupancy_rate"),
        F.count_distinct(key).cast("long").alias("listing_count"))
