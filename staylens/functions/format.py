"""Presentation columns (PRJ-8): currency, one-decimal, percent, thousands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylens.functions.text import col


def money0(x: Column | str, symbol: str = "£") -> Column:
    """``£1,235`` (no decimals, thousands separators); null stays null."""
    return F.when(col(x).isNotNull(), F.concat(F.lit(symbol), F.format_number(F.rint(col(x)), 0)))


def one_decimal_or_na(x: Column | str) -> Column:
    """``4.5`` or ``N/A`` (``format_string`` would print a null as ``n``)."""
    return F.when(col(x).isNotNull(), F.format_string("%.1f", col(x))).otherwise(F.lit("N/A"))


def percent1(x: Column | str) -> Column:
    """Fraction -> ``45.0%``."""
    return F.when(col(x).isNotNull(), F.format_string("%.1f%%", col(x) * 100))
