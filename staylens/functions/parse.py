"""Parsing of landed text into typed values (SCL-1, SCL-2, SCL-6, PRJ-3, PRJ-4).

Spark 4 runs with ANSI mode on, so every coercion is a ``try_*`` call guarded by
a regular expression: ``try_cast`` alone would accept ``'1.5d'`` or ``'NaN'``,
which the source rejects or which would let NaN into a column. Text in the common
shape is converted as it stands; only other text is stripped first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylens.functions.text import col, strip_ws
from staylens.functions.values import CALENDAR_FALSE, CALENDAR_TRUE, LISTING_FALSE, LISTING_TRUE

DECIMAL_RE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_RE = r"^([+-]?[0-9]+)(?:\.0*)?$"
ISO_DATE_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _finite(t: Column) -> Column:
    """Decimal text -> double; text beyond the range of doubles (``1e400``) -> null."""
    return F.when(t.rlike(DECIMAL_RE), _below_infinity(t))


def _below_infinity(t: Column) -> Column:
    x = t.try_cast("double")
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def safe_double(c: Column | str) -> Column:
    """PRJ-3: numeric text -> double, anything else -> null (never NaN/inf)."""
    t = col(c).cast("string")
    return F.when(t.rlike(DECIMAL_RE), _below_infinity(t)).otherwise(_finite(strip_ws(t)))


def safe_long(c: Column | str) -> Column:
    """PRJ-3 for ids: integer text (``12`` or ``12.0``) -> bigint, exact to the last digit.

    Ids never pass through double, which has 53 bits; text that is no integer or
    lies beyond 64 bits becomes null.
    """
    raw = col(c).cast("string")
    t, x = strip_ws(raw), raw.try_cast("bigint")
    other = F.when(t.rlike(INTEGER_RE), F.regexp_extract(t, INTEGER_RE, 1).try_cast("bigint"))
    return F.when(x.cast("string") == raw, x).otherwise(other)  # the plain form of a number is that number


def parse_price(c: Column | str) -> Column:
    """SCL-1: strip ``$``, ``,`` and whitespace; decimal text -> double; negatives kept."""
    raw = col(c).cast("string")
    plain = F.when(raw.startswith("$"), F.substring(raw, 2, 1 << 30)).otherwise(raw)
    return F.when(plain.rlike(DECIMAL_RE), _below_infinity(plain)).otherwise(_finite(F.translate(raw, "$, \t\n\x0b\f\r", "")))


def parse_date(c: Column | str) -> Column:
    """SCL-2: ``yyyy-MM-dd`` text -> date; other shapes and impossible dates -> null."""
    raw = col(c).cast("string")
    t = strip_ws(raw)
    other = F.when(t.rlike(ISO_DATE_RE), F.try_to_date(t, "yyyy-MM-dd"))
    # the year 0000 is left to the pattern
    return F.when(raw.rlike(ISO_DATE_RE) & ~raw.startswith("0000"), raw.try_cast("date")).otherwise(other)


def decode_bool(c: Column | str, true_codes=None, false_codes=None) -> Column:
    """PRJ-4: listing booleans (``t``/``True`` and ``f``/``False``); other text -> null."""
    t = col(c).cast("string")
    tc = LISTING_TRUE if true_codes is None else true_codes
    fc = LISTING_FALSE if false_codes is None else false_codes
    return F.when(t.isin(*tc), F.lit(True)).when(t.isin(*fc), F.lit(False)).otherwise(F.lit(None).cast("boolean"))


def decode_calendar_bool(c: Column | str) -> Column:
    """Calendar ``available`` accepts only ``t`` / ``f``."""
    return decode_bool(c, CALENDAR_TRUE, CALENDAR_FALSE)


def parse_amenities(c: Column | str) -> Column:
    """SCL-6: amenity text -> array<string>.

    ``[...]`` is parsed as a JSON array (malformed -> empty); otherwise the
    ``{a,"b"}`` form: strip braces, split on commas, drop blank items, trim
    each item and strip double quotes. Missing / empty -> empty array.
    """
    t = strip_ws(col(c).cast("string"))
    as_json = F.from_json(t, "array<string>")
    body = F.regexp_replace(t, r"^[{}]+|[{}]+$", "")
    items = F.filter(F.split(body, ","), lambda x: strip_ws(x) != "")
    braces = F.transform(items, lambda x: F.regexp_replace(strip_ws(x), r'^"+|"+$', ""))
    empty = F.array().cast("array<string>")
    parsed = F.when(t.startswith("["), F.coalesce(as_json, empty)).otherwise(braces)
    return F.when(col(c).isNull() | (t == ""), empty).otherwise(parsed)
