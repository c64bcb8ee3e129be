"""Data-quality rules (DQ-1 .. DQ-13) as data.

Each rule is a predicate with a null policy. ``apply_flags`` adds one boolean
``flag_*`` column per flag rule (two-valued: a null comparison is resolved by
the policy, never left null) plus ``is_valid``; ``rule_report`` computes every
rule's failure count in ONE aggregation pass (partial aggregation map-side, a
single-row final merge), then unpivots to (rule, description, failed,
pct_failed). Rules whose column is missing are skipped, as in the source.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.derive import as_of_date, round2
from staylens.functions.values import (
    AVAILABILITY_RANGE,
    CALENDAR_RULE_TEXT,
    LISTING_RULE_TEXT,
    MIN_NIGHTS_RANGE,
    RATING_RANGE,
)

FLAG_PREFIX = "flag_valid"


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    description: str
    predicate: Callable[[Column], Column]
    null_passes: bool
    flag: str | None  # None: report-only rule (no flag, no effect on is_valid)
    kind: str = "row"  # "row" or "unique"

    def passes(self) -> Column:
        c = F.col(self.column)
        return F.coalesce(self.predicate(c), F.lit(self.null_passes))


def listing_rules(bounds: dict, as_of: str | None = None, id_col: str = "id") -> list[Rule]:
    lo_n, hi_n = MIN_NIGHTS_RANGE
    lo_a, hi_a = AVAILABILITY_RANGE
    lo_r, hi_r = RATING_RANGE
    la0, la1, lo0, lo1 = bounds["lat_min"], bounds["lat_max"], bounds["lon_min"], bounds["lon_max"]
    text = {k: v.format(**bounds) for k, v in LISTING_RULE_TEXT.items()}
    return [
        Rule("valid_price", "price", text["valid_price"], lambda c: c > 0, False, "flag_valid_price"),
        Rule("valid_latitude", "latitude", text["valid_latitude"], lambda c: c.between(la0, la1), False, "flag_valid_lat"),
        Rule("valid_longitude", "longitude", text["valid_longitude"], lambda c: c.between(lo0, lo1), False,
             "flag_valid_lon"),
        Rule("valid_minimum_nights", "minimum_nights", text["valid_minimum_nights"],
             lambda c: c.between(lo_n, hi_n), False, "flag_valid_min_nights"),
        Rule("valid_availability", "availability_365", text["valid_availability"],
             lambda c: c.between(lo_a, hi_a), False, "flag_valid_availability"),
        Rule("valid_review_rating", "review_scores_rating", text["valid_review_rating"],
             lambda c: c.between(lo_r, hi_r), True, "flag_valid_rating"),
        Rule("valid_listing_id", id_col, text["valid_listing_id"], lambda c: c.isNotNull(), False, "flag_valid_id"),
        Rule("unique_listing_id", id_col, text["unique_listing_id"], lambda c: F.lit(True), True, None, kind="unique"),
        Rule("valid_host_since", "host_since", text["valid_host_since"],
             lambda c: c <= as_of_date(as_of), True, "flag_valid_host_since"),
    ]


def calendar_rules() -> list[Rule]:
    t = CALENDAR_RULE_TEXT
    return [
        Rule("valid_price", "price", t["valid_price"], lambda c: c > 0, True, "flag_valid_price"),
        Rule("valid_available", "available", t["valid_available"], lambda c: c.isNotNull(), False, "flag_valid_available"),
    ]


def active_rules(df: DataFrame, rules: list[Rule]) -> list[Rule]:
    return [r for r in rules if r.column in df.columns]


def apply_flags(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add the flag columns and ``is_valid`` (AND of every ``flag_valid*`` column)."""
    rules = active_rules(df, rules)
    flagged = df.withColumns({r.flag: r.passes() for r in rules if r.flag})
    flag_cols = [c for c in flagged.columns if c.startswith(FLAG_PREFIX)]
    if not flag_cols:
        return flagged
    return flagged.withColumn("is_valid", functools.reduce(lambda a, b: a & b, [F.col(c) for c in flag_cols]))


def _failed_expr(r: Rule) -> Column:
    if r.kind == "unique":
        # pandas ``duplicated``: every repeat counts, and all nulls are one value.
        c = F.col(r.column)
        return F.count(F.lit(1)) - F.count_distinct(c) - F.max(F.when(c.isNull(), 1).otherwise(0))
    if r.flag:
        return F.count_if(~F.col(r.flag))
    return F.count_if(~r.passes())


def rule_report(flagged: DataFrame, rules: list[Rule], include_summary: bool = True) -> DataFrame:
    """One pass: (rule, description, failed, pct_failed); pct is null on empty input."""
    rules = active_rules(flagged, rules)
    aggs = [F.count(F.lit(1)).alias("__total")]
    aggs += [_failed_expr(r).cast("long").alias(f"__f{i}") for i, r in enumerate(rules)]
    has_valid = include_summary and "is_valid" in flagged.columns
    if has_valid:
        aggs.append(F.count_if(~F.col("is_valid")).cast("long").alias("__invalid"))
    one = flagged.agg(*aggs)
    entries = [
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.description).alias("description"), F.col(f"__f{i}").alias("failed"))
        for i, r in enumerate(rules)
    ]
    if has_valid:
        entries.append(
            F.struct(F.lit("is_valid").alias("rule"), F.lit("all flag rules pass").alias("description"),
                     F.col("__invalid").alias("failed"))
        )
    long = one.select("__total", F.explode(F.array(*entries)).alias("e"))
    return long.select(
        F.col("e.rule").alias("rule"),
        F.col("e.description").alias("description"),
        F.coalesce(F.col("e.failed"), F.lit(0)).cast("long").alias("failed"),
        round2(F.try_divide(F.col("e.failed").cast("double"), F.col("__total").cast("double")) * 100).alias("pct_failed"),
        F.col("__total").cast("long").alias("total_records"),
    )


def validity_summary(flagged: DataFrame) -> DataFrame:
    """DQ-10 totals: total, valid, invalid, pct_valid (one row)."""
    one = flagged.agg(F.count(F.lit(1)).alias("total_records"), F.count_if(F.col("is_valid")).alias("total_valid"))
    return one.select(
        F.col("total_records").cast("long"),
        F.col("total_valid").cast("long"),
        (F.col("total_records") - F.col("total_valid")).cast("long").alias("total_invalid"),
        round2(F.try_divide(F.col("total_valid").cast("double"), F.col("total_records").cast("double")) * 100).alias("pct_valid"),
    )


def valid_subset(flagged: DataFrame) -> DataFrame:
    """FLT-3: keep valid rows (all rows when there is no ``is_valid`` column)."""
    return flagged.filter(F.col("is_valid")) if "is_valid" in flagged.columns else flagged
