"""Derived values and math (SCL-11..16, PRJ-5, PRJ-6, ML-10, ML-11)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.text import col
from staylens.functions.values import DAYS_PER_YEAR, OCCUPANCY_PCT_RANGE


def round2(x: Column | str) -> Column:
    """Two-decimal rounding of row values the way pandas does it: ``rint(x*100)/100``.

    (``round(x, 2)`` / ``bround(x, 2)`` round the decimal form of the double and
    disagree on values such as 2.675.)
    """
    return F.rint(col(x) * 100) / 100


def round_to(x: Column | str, digits: int) -> Column:
    """Rounding for aggregate outputs (half-even on the scaled double)."""
    scale = float(10 ** digits)
    return F.rint(col(x) * scale) / scale


def as_of_date(as_of: str | _dt.date | None) -> Column:
    """T15: the evaluation date is a parameter (default: today)."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def tenure_years(since: Column | str, as_of: str | None = None) -> Column:
    """SCL-11: whole days from ``since`` to the as-of date / 365.25, two decimals."""
    return round2(F.datediff(as_of_date(as_of), col(since)) / F.lit(DAYS_PER_YEAR))


def days_since(d: Column | str, as_of: str | None = None) -> Column:
    return F.datediff(as_of_date(as_of), col(d))


def price_per_bedroom(price: Column | str, bedrooms: Column | str) -> Column:
    """SCL-12: divisor clipped below at 1 (null stays null), two decimals."""
    b = col(bedrooms)
    return round2(col(price) / F.when(b < 1, F.lit(1.0)).otherwise(b))


def commercial_host(listing_count: Column | str) -> Column:
    """SCL-13: more than one listing; unknown -> false."""
    return F.coalesce(col(listing_count) > 1, F.lit(False))


def weekend(d: Column | str) -> Column:
    return F.coalesce(F.weekday(col(d)) >= 5, F.lit(False))


DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def calendar_parts(d: Column | str) -> dict[str, Column]:
    """SCL-14: is_weekend, full day name, month, year."""
    d = col(d)
    return {
        "is_weekend": weekend(d),
        "day_of_week": F.get(F.array(*[F.lit(n) for n in DAY_NAMES]), F.weekday(d)),
        "month": F.month(d).cast("int"),
        "year": F.year(d).cast("int"),
    }


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """SCL-15: division that yields null on a zero or null divisor (ANSI-safe)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def clamp(x: Column | str, lo, hi) -> Column:
    return F.least(F.greatest(col(x), F.lit(lo)), F.lit(hi))


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """PRJ-5: fill nulls of existing columns only."""
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.fillna(present) if present else df


def coalesce_defaults(defaults: dict[str, object]) -> dict[str, Column]:
    """PRJ-6: query-time ``COALESCE(col, default)`` for each column."""
    return {k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items()}


def occupancy_default_pct(occ: Column | str) -> Column:
    """ML-11: rate rounded to whole percent, clamped to the scenario range."""
    lo, hi = OCCUPANCY_PCT_RANGE
    return clamp(F.rint(col(occ) * 100).cast("int"), lo, hi)


def revenue_columns(price: Column | str, occupancy: Column | str, nights: int = 30) -> dict[str, Column]:
    """ML-10: booked nights, monthly and annual revenue."""
    booked = F.lit(float(nights)) * col(occupancy)
    monthly = col(price) * booked
    return {"booked_nights": booked, "monthly_revenue": monthly, "annual_revenue": monthly * 12}
