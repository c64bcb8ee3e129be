"""Line dedup by content-defined chunks of lines.

A text's lines are hashed, a hash rolls over every ``span`` of consecutive line
hashes, and a chunk ends where the rolled hash is divisible by ``average``.
Borders so depend on nearby lines only: after an insertion they fall into step
again, and a repeated passage is cut alike wherever it stands.

A chunk of two or more lines with words that occurs in more than one place is
kept where it stands first (smallest doc_id, then line) and removed elsewhere.
Chunks are the same only if their bytes are: they are grouped by hash and text.
Places are then matched by hash alone, except for hashes that turned out to
stand for several texts, which are matched by text.

Null text stays null; empty texts have one empty line. Rows that repeat a
doc_id count as the same document: their chunks at one line are one place, not
copies of each other. A null doc_id comes before all others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm import words
from staylens.session import shared_path

SPAN = 2
AVERAGE = 3
MOST_LINES = 64
_BLANK = b" \t\n\x0b\x0c\r"
_CHUNK = "doc_id long, row long, start long, n long, hash long"


def borders(line_hashes: np.ndarray, span: int = SPAN, average: int = AVERAGE, most: int = MOST_LINES) -> list[int]:
    """Ends of the chunks over these line hashes (the last one always)."""
    n = len(line_hashes)
    rolled = words.windows(line_hashes, min(span, n))
    cut = set((np.flatnonzero(rolled % words.U(average) == 0) + min(span, n)).tolist())
    out, last = [], 0
    for end in range(1, n + 1):
        if end == n or (end - last >= 2 and (end in cut or end - last >= most)):
            out.append(end)
            last = end
    return out


def chunks(text: bytes, span: int = SPAN, average: int = AVERAGE) -> list[tuple[int, int, bytes]]:
    """(first line, lines, bytes) of a text's chunks that have two lines with words or more."""
    lines = text.split(b"\n")
    if len(lines) < 2:
        return []
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines))
    out, a = [], 0
    for b in borders(h, span, average):
        if sum(bool(x.strip(_BLANK)) for x in lines[a:b]) >= 2:
            out.append((a, b - a, b"\n".join(lines[a:b])))
        a = b
    return out


def _chunk_rows(with_text: bool, span: int, average: int):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_text

    def run(batches):
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for texts in words.slices(batch.column(2)):
                out = [[] for _ in kinds]
                for i in range(len(texts)):
                    at = texts.rows.start + i
                    for start, n, text in chunks(texts.bytes_of(i), span, average):
                        h = xxhash.xxh3_64_intdigest(text)
                        for column, x in zip(out, (ids[at], rows[at], start, n, h - (1 << 64) if h >> 63 else h, text)):
                            column.append(x)
                names = ["doc_id", "row", "start", "n", "hash", "chunk"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names[: len(kinds)])

    return run


def _order() -> Column:
    """One number that sorts places by document (null first) and line."""
    doc = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(-(1 << 63) - 1)).cast("decimal(20,0)"))
    return (doc * F.lit(1 << 32).cast("decimal(11,0)") + F.col("start").cast("decimal(11,0)")).cast("decimal(32,0)")


def repeated(docs: DataFrame, span: int = SPAN, average: int = AVERAGE) -> DataFrame:
    """(doc_id, row, spans): lines to remove, where ``row`` is the hash of the text."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    full = rows.mapInArrow(words.tidy(_chunk_rows(True, span, average)), f"{_CHUNK}, chunk binary").withColumn("order", _order())
    light = rows.mapInArrow(words.tidy(_chunk_rows(False, span, average)), _CHUNK).withColumn("order", _order())
    # grouping by the bytes is the comparison; equal chunks of one task are merged before they travel
    texts = full.groupBy("hash", "chunk").agg(F.min("order").alias("first"), F.max("order").alias("last"))
    by_hash = texts.groupBy("hash").agg(F.count("*").alias("texts"), F.min("first").alias("first"), F.max("last").alias("last"))
    path = shared_path(spark, "chunks")
    by_hash.where((F.col("texts") > 1) | (F.col("first") != F.col("last"))).write.parquet(path)
    found = spark.read.schema("hash long, texts long, first decimal(32,0), last decimal(32,0)").parquet(path)
    gone = light.join(found.where(F.col("texts") == 1).select("hash", "first"), "hash").where(F.col("order") > F.col("first")).select("doc_id", "row", "start", "n")
    shared = found.where(F.col("texts") > 1).select("hash")
    if not shared.isEmpty():
        few = full.join(shared, "hash", "left_semi")
        first = few.groupBy("hash", "chunk").agg(F.min("order").alias("first"))
        gone = gone.unionByName(few.join(first, ["hash", "chunk"]).where(F.col("order") > F.col("first")).select("doc_id", "row", "start", "n"))
    return gone.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "n")).alias("spans"))


def _without(lines: Column, spans: Column) -> Column:
    """``lines`` without these spans (sorted, apart from each other): the slices between them."""

    def gaps(r: Column) -> Column:
        begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(r["spans"], lambda s: s["start"] + s["n"]))
        ends = F.concat(F.transform(r["spans"], lambda s: s["start"]), F.array(F.size(r["lines"]).cast("long")))
        return F.flatten(F.zip_with(begins, ends, lambda a, b: F.slice(r["lines"], (a + 1).cast("int"), (b - a).cast("int"))))

    # the one-element array splits the text once, not once a span
    return F.transform(F.array(F.struct(lines.alias("lines"), spans.alias("spans"))), gaps)[0]


def dedup_lines(docs: DataFrame, span: int = SPAN, average: int = AVERAGE) -> DataFrame:
    """(doc, kept, n_lines, n_removed): each row whole as a struct, and its text without repeated chunks."""
    gone = repeated(docs, span, average).select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "spans")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col("doc_id").cast("long").alias("_d"), F.xxhash64(F.col("text").cast("string")).alias("_r"))
    both = rows.join(gone, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_r") == F.col("_row")), "left")
    text = F.col("doc.text").cast("string")
    kept = _without(F.split(text, "\n", -1), F.array_sort("spans"))
    return both.select(
        "doc", F.when(F.col("spans").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("kept"),
        F.when(text.isNull(), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["n"]), F.lit(0)).cast("long").alias("n_removed"))


def drop_repeated(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated chunks taken out of ``text``, all columns as they were."""
    out = dedup_lines(docs)
    return out.select(*(F.col("kept").cast(docs.schema["text"].dataType).alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns))
