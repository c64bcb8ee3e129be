"""Category normalization (SCL-3, SCL-4, SCL-5, PRJ-7) as map-literal lookups.

The lookup tables are tiny literals, so ``element_at(map, key)`` stays inside
whole-stage codegen; no join or UDF is needed.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.text import col, strip_ws, title_case
from staylens.functions.values import (
    PROPERTY_TYPE_GROUPS,
    PROPERTY_TYPE_OTHER,
    ROOM_TYPE_LABELS,
    SUPERHOST_LABELS,
)


def _map_literal(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def _lookup_key(c: Column) -> Column:
    return strip_ws(F.lower(c))


def room_type_lookup(c: Column | str) -> Column:
    """Canonical label or null when the text is not a known room type."""
    return F.element_at(_map_literal(ROOM_TYPE_LABELS), _lookup_key(col(c)))


def normalize_room_type(c: Column | str) -> Column:
    """SCL-3: known -> canonical label; unknown -> title case of the raw text; null stays null."""
    return F.coalesce(room_type_lookup(c), title_case(col(c)))


def unknown_room_types(df: DataFrame, column: str = "room_type", limit: int = 5) -> DataFrame:
    """SCL-4: a few distinct raw values that are not known room types (for the log)."""
    raw = F.col(column)
    unknown = df.where(raw.isNotNull() & room_type_lookup(raw).isNull()).select(raw.alias(column)).distinct()
    return unknown.orderBy(column).limit(limit)


def normalize_property_type(c: Column | str) -> Column:
    """SCL-5: 25 source variants -> 12 groups; unmatched and null -> ``Other``."""
    return F.coalesce(F.element_at(_map_literal(PROPERTY_TYPE_GROUPS), _lookup_key(col(c))), F.lit(PROPERTY_TYPE_OTHER))


def superhost_label(c: Column | str) -> Column:
    """PRJ-7: true / false / null -> display label."""
    yes, no, unknown = SUPERHOST_LABELS
    c = col(c)
    return F.when(c, F.lit(yes)).when(~c, F.lit(no)).otherwise(F.lit(unknown))
