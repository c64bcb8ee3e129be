"""Amenity count and flags (SCL-7, SCL-8)."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.text import col
from staylens.functions.values import AMENITY_FLAGS


def amenity_count(arr: Column | str) -> Column:
    return F.size(F.coalesce(col(arr), F.array().cast("array<string>")))


def lowered_items(arr: Column | str) -> Column:
    """Lower-case once, drop null items (they never match and must not raise)."""
    return F.filter(F.transform(col(arr), lambda x: F.lower(x)), lambda x: x.isNotNull())


def amenity_flag(lowered: Column, names: list[str]) -> Column:
    """Case-insensitive exact match of any of ``names``; false when nothing matches."""
    found = [F.array_contains(lowered, n.lower()) for n in names]
    return F.coalesce(functools.reduce(lambda a, b: a | b, found), F.lit(False))


def with_amenity_flags(df: DataFrame, list_col: str = "amenities_list", flags: dict | None = None) -> DataFrame:
    """All flags in one projection; the lowered array is computed once."""
    if list_col not in df.columns:
        return df
    flags = AMENITY_FLAGS if flags is None else flags
    tmp = "__amenities_lower"
    out = df.withColumn(tmp, lowered_items(list_col))
    out = out.withColumns({name: amenity_flag(F.col(tmp), names) for name, names in flags.items()})
    return out.drop(tmp)
