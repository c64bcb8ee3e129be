"""Text expressions (pure Column -> Column, JVM-side, codegen friendly)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.values import NA_TOKENS

_WS_EDGES = r"^\s+|\s+$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: First and last characters of a text that ``_WS_EDGES`` may change (its ``$`` also stands before a last line end).
_WS = [9, 10, 11, 12, 13, 32]
_LAST = [*_WS, 0x85, 0x2028, 0x2029]


def strip_ws(c: Column | str) -> Column:
    """Strip all whitespace at both ends (``trim`` only removes spaces); most texts have none and skip the expression."""
    c = col(c)
    edges = F.ascii(c).isin(*_WS) | F.ascii(F.substring(c, -1, 1)).isin(*_LAST)
    return F.when(edges, F.regexp_replace(c, _WS_EDGES, "")).otherwise(c)


def na_to_null(c: Column | str, tokens: list[str] | None = None) -> Column:
    """T1: the CSV reader's missing-value tokens become null (exact match, no trim)."""
    c = col(c)
    toks = NA_TOKENS if tokens is None else tokens
    return F.when(c.isin(*toks), F.lit(None).cast("string")).otherwise(c)


def null_na_tokens(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One projection that nulls NA tokens in every (string) column."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({n: na_to_null(n) for n in names})


def title_case(c: Column | str) -> Column:
    """Python ``str.title``: upper-case the first letter of every letter run.

    ``initcap`` only starts words after spaces; here any non-letter starts a
    new word ("entire home/apt" -> "Entire Home/Apt", "bed's" -> "Bed'S").
    """
    parts = F.regexp_extract_all(F.lower(col(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    cap = F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30)))
    return F.when(col(c).isNull(), F.lit(None).cast("string")).otherwise(F.array_join(cap, ""))


def standard_column_name(name: str) -> str:
    """PRJ-2: lower, strip, spaces to underscores."""
    return name.lower().strip().replace(" ", "_")


def standardize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[standard_column_name(n) for n in df.columns])


def clean_comment(c: Column | str) -> Column:
    """SCL-9: trimmed text; the literal words ``nan`` / ``None`` are missing."""
    t = strip_ws(col(c))
    return F.when(col(c).isNull() | t.isin("nan", "None"), F.lit(None).cast("string")).otherwise(t)


def text_length(c: Column | str) -> Column:
    """SCL-10: character length, missing -> 0."""
    return F.coalesce(F.length(col(c)), F.lit(0))


def snake(label: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", label.lower()).strip("_")
