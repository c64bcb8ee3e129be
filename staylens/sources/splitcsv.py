"""Quoted multi-line CSV read by many tasks a file (SRC-1, SRC-2).

Spark reads a multi-line CSV file whole in one task, because a line end inside
quotes looks like the end of a record. Here a plain file is read in byte ranges
as lines. A range's quotes are counted first; a prefix over the ranges of a file
says whether each begins inside a quoted field (an odd number of quotes before
it). With that every task knows where its records begin: a line begins one if
the quotes before it are even. Records that cross a border are put together from
their pieces, the last one of a range and the first lines of the ranges after
it; only these few pieces are shuffled.

The bytes are read twice (to count quotes, then for the records), each time by
all tasks, instead of once by one. Quotes must stand in quoted fields only, with
a quote inside a field doubled (RFC 4180, and what Spark and pandas write);
a file with other quotes needs the whole-file reader. Line ends are ``\\n`` or
``\\r\\n``. Compressed files can't be split.

What every task must know, one row for each byte range of the scan, is broadcast:
the driver holds as many ranges when it plans the scan. Files are read in groups
of at most MOST_RANGES ranges, so a broadcast is bounded whatever there is to read.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PIECES = "file string, block long, kind int, text string"
#: Kinds of pieces: a whole record; a record's begin, which goes on in the next range; lines that go on, with the
#: record's end; a range that is all the middle of one record; the first record of a file.
WHOLE, BEGIN, END, MIDDLE, HEADER = range(5)
#: Byte ranges whose states are broadcast together (about 200 bytes each).
MOST_RANGES = 250_000


def _lines(spark: SparkSession, paths) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def open_ranges(lines: DataFrame, quote: str = '"') -> DataFrame:
    """(file, block, opens): whether each range of a file begins inside a quoted field. One row a range."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit(quote), F.lit("")))
    ranges = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).cast("int").alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("opens"))


class _Range:
    """The records of one byte range, line by line."""

    def __init__(self, file: str, block: int, opens: bool) -> None:
        self.file, self.block = file, block
        self.inside, self.head, self.held, self.first = opens, opens, [], block == 0

    def add(self, values: pa.Array, quote: str) -> list[tuple[int, str]]:
        """Pieces that are complete with these lines."""
        odd = pc.bit_wise_and(pc.count_substring(values, quote), 1).to_pylist()
        out, held, inside, head, first = [], self.held, self.inside, self.head, self.first
        for line, flips in zip(values.to_pylist(), odd):
            held.append(line)
            if flips:
                inside = not inside
            if not inside:
                out.append((HEADER if first else END if head else WHOLE, "\n".join(held)))
                held, head, first = [], False, False
        self.held, self.inside, self.head, self.first = held, inside, head, first
        return out

    def rest(self) -> list[tuple[int, str]]:
        """What the range ends with: a record that goes on."""
        return [(MIDDLE if self.head else BEGIN, "\n".join(self.held))] if self.held else []


def _assemble(quote: str):
    def batch(file: str, block: int, pieces: list[tuple[int, str]]) -> pa.RecordBatch:
        kinds, texts = zip(*pieces)
        n = len(pieces)
        return pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(kinds, pa.int32()), pa.array(texts, pa.string())],
                                          ["file", "block", "kind", "text"])

    def run(batches):
        now = None
        for part in batches:
            files, blocks = part.column(0), part.column(1)
            # lines of one range follow each other
            keys = list(zip(pc.run_end_encode(files).values.to_pylist(), pc.run_end_encode(files).run_ends.to_pylist()))
            at = 0
            for file, file_end in keys:
                inner = pc.run_end_encode(blocks.slice(at, file_end - at))
                begin = at
                for block, end in zip(inner.values.to_pylist(), inner.run_ends.to_pylist()):
                    if now is None or (now.file, now.block) != (file, block):
                        if now is not None and (pieces := now.rest()):
                            yield batch(now.file, now.block, pieces)
                        now = _Range(file, block, part.column(3)[at].as_py())
                    if pieces := now.add(part.column(2).slice(at, begin + end - at), quote):
                        yield batch(now.file, now.block, pieces)
                    at = begin + end
        if now is not None and (pieces := now.rest()):
            yield batch(now.file, now.block, pieces)

    return run


def records(spark: SparkSession, paths: list[str], quote: str = '"') -> DataFrame:
    """(file, block, text): every record of plain CSV files but the first of each (the header), line ends inside quotes kept.

    ``block`` is the byte at which the range begins in which the record does.
    """
    lines = _lines(spark, paths)
    opened = lines.join(F.broadcast(open_ranges(lines, quote)), ["file", "block"])  # lines stay where and as they are
    pieces = opened.select("file", "block", "value", "opens").mapInArrow(_assemble(quote), PIECES)
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "block", "text")
    # the pieces of a record that crosses a border: its begin, middles, its end; counting begins along a file numbers them
    order = Window.partitionBy("file").orderBy("block", (F.col("kind") == BEGIN).cast("int"))
    cut = pieces.where(F.col("kind").isin(BEGIN, END, MIDDLE)).withColumn("n", F.sum((F.col("kind") == BEGIN).cast("int")).over(order))
    listed = F.array_sort(F.collect_list(F.struct("block", (F.col("kind") == BEGIN).cast("int").alias("begins"), "text")))
    joined = cut.groupBy("file", "n").agg(F.min("block").alias("block"), F.array_join(F.transform(listed, lambda x: x["text"]), "\n").alias("text"))
    return whole.unionByName(joined.select("file", "block", "text"))


def groups(files: list[tuple[str, int]], range_bytes: int, most: int = MOST_RANGES) -> list[list[str]]:
    """Files (path, size) in groups of at most ``most`` byte ranges (a file more than that stands alone)."""
    out: list[list[str]] = []
    held = most
    for path, size in files:
        ranges = size // range_bytes + 1
        if held + ranges > most:
            out.append([])
            held = 0
        out[-1].append(path)
        held += ranges
    return out


def read_split_csv(spark: SparkSession, files: list[tuple[str, int]], schema: StructType, quote: str = '"') -> DataFrame:
    """Records of plain files (path, size) with one header, as columns of ``schema``."""
    conf = spark.conf.get("spark.sql.files.maxPartitionBytes")
    size = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf))
    frames = [records(spark, paths, quote) for paths in groups(files, size)]
    text = frames[0]
    for f in frames[1:]:
        text = text.unionByName(f)
    line = F.when(F.col("text").endswith("\r"), F.substring("text", F.lit(1), F.length("text") - 1)).otherwise(F.col("text"))
    options = {"quote": quote, "escape": quote, "mode": "PERMISSIVE", "multiLine": "true"}
    parsed = text.select(line.alias("text")).where(F.length("text") > 0).select(F.from_csv("text", _ddl(schema), options).alias("r"))
    return parsed.select("r.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
