"""Rows that every operator must take: nulls, empty and very long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import SparkSession
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Columns whose names the operators use inside.
CLASH = [("n_words", "7"), ("key", "x"), ("rank", "3"), ("text_2", "t"), ("ids", "i"), ("word", "w"), ("start", "0"), ("length", "9"), ("row", "r"), ("hash", "h")]


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    syllables = ["er", "th", "on", "an", "re", "he", "in", "ed", "nd", "ha", "ou", "ü", "é"]
    words = ["".join(r.choice(syllables) for _ in range(1 + i % 4)) for i in range(vocabulary)]
    out = [r.choice(words) + r.choice(["", "", "", "", ",", ".\n"]) for _ in range(n)]
    return " ".join(out)


def documents(seed: int = 1, n: int = 60) -> list[tuple]:
    """Prose with copies, near copies and shared passages, and every edge case."""
    r = random.Random(seed)
    texts = [prose(seed * 1000 + i, r.choice([5, 40, 120, 300]), 2000) for i in range(n)]
    passage = prose(77, 60, 500)
    for i in range(0, n, 7):
        texts[i] = texts[i] + "\n" + passage
    for i in range(3, n, 10):
        texts[i] = texts[i - 1]
    for i in range(4, n, 10):
        w = texts[i - 2].split(" ")
        w[len(w) // 2] = "changed"
        texts[i] = " ".join(w)
    texts += ["", None, "   \n\t ", "one", "two words", "a b c", "A B C", "x " * 30, "x " * 30, "Ünï çödé — 漢字 漢字 " * 12, prose(5, 6000, 3000), "z" * 5000,
              "line one is here\nline two is here\nline one is here\n\n" * 4, "#$%& <tag> | * " * 10, "a\x0bb\x0cc\rd\te", "\x1cfs\x85nel\xa0nbsp em"]
    langs = ["en", "de", "fr", "es", None]
    rows = [(i, t, langs[i % 5], f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [(None, "a text without an id, " + prose(9, 30), "en", "s1", None), rows[0], rows[5]]  # no id; repeated rows


def frame(spark: SparkSession, rows: list[tuple], clash: bool = False, parts: int = 3):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS).repartition(parts)
    return df.withColumns({n: F.lit(v) for n, v in CLASH}) if clash else df


def answers(df, *columns: str) -> list[tuple]:
    """Sorted rows of these columns."""
    key = lambda row: tuple((x is not None, x) for x in row)
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=key)


def by_key(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((x is not None, x) for x in row))
