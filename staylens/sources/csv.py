"""Landed CSV sources (SRC-1 .. SRC-4).

Text is read with an explicit all-string schema (types are set by the silver
step), quoted multi-line fields and doubled quotes, then the pandas NA tokens
are nulled in one projection (T1). Gzip files cannot be split, so one file is one
task; a ``repartition`` right after the read (``partitions``) spreads everything
downstream over the cluster. Plain multi-line files can be read by many tasks
each (``split``, see ``splitcsv``).
"""

from __future__ import annotations

import csv
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from staylens.functions.text import null_na_tokens
from staylens.sources import splitcsv
from staylens.sources.tables import union_all


def csv_files(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int]]:
    """(path, size) of the files behind a file, folder or pattern, by the file system's listing; markers and empty files left out."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for one in [path] if isinstance(path, str) else path:
        p = jvm.org.apache.hadoop.fs.Path(one)
        fs = p.getFileSystem(conf)
        found = list(fs.globStatus(p) or [])
        for status in [f for s in found for f in (fs.listStatus(s.getPath()) if s.isDirectory() else [s])]:
            name = status.getPath().getName()
            if status.isFile() and status.getLen() and not name.startswith(("_", ".")):
                out.append((status.getPath().toString(), status.getLen()))
    return sorted(out)


def first_lines(spark: SparkSession, paths: list[str], encoding: str = "UTF-8") -> list[str]:
    """The first line of each file (decompressed by its extension): the file's first buffer is all that is read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(path: str) -> str:
        p = jvm.org.apache.hadoop.fs.Path(path)
        stream = p.getFileSystem(conf).open(p)
        try:
            codec = codecs.getCodec(p)
            opened = codec.createInputStream(stream) if codec else stream
            return (jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(opened, encoding)).readLine() or "").rstrip()
        finally:
            stream.close()

    with ThreadPoolExecutor(max_workers=16) as pool:
        return list(pool.map(first, paths))


def header_schema(spark: SparkSession, path: str, encoding: str = "UTF-8", line: str | None = None) -> StructType:
    """All-string schema from the header line (no type inference pass)."""
    if line is None:
        line = next(iter(first_lines(spark, [f for f, _ in csv_files(spark, path)[:1]], encoding)), "")
    if not line:
        return StructType([])
    names = next(csv.reader([line]))
    seen = Counter(n.lower() for n in names)
    cols = [f"_c{i}" if not n else f"{n}{i}" if seen[n.lower()] > 1 else n for i, n in enumerate(names)]  # as Spark names them
    return StructType([StructField(c, StringType(), True) for c in cols])


def header_groups(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> dict[str, list[tuple[str, int]]]:
    """Files (path, size) by header line; one line a file is read."""
    files = csv_files(spark, path)
    out: dict[str, list[tuple[str, int]]] = {}
    for file, line in zip(files, first_lines(spark, [f for f, _ in files], encoding)):
        out.setdefault(line, []).append(file)
    return out


def _read(spark: SparkSession, path: str | list[str], schema: StructType, multiline: bool, encoding: str) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("multiLine", multiline)
    return reader.option("quote", '"').option("escape", '"').option("encoding", encoding).option("mode", "PERMISSIVE").csv(path)


def read_landed_csv(spark: SparkSession, path: str, schema: StructType | None = None, partitions: int | None = None,
                    multiline: bool = True, encoding: str = "UTF-8", split: bool = False) -> DataFrame:
    """SRC-1 / SRC-2 / SRC-3: headered CSV (gzip by extension) -> all-string frame, NA tokens nulled.

    Columns go by name: part files with other column orders are read by their own
    headers and joined by name (a column that a file lacks is null there). With an
    explicit ``schema`` every file must have these columns in this order; a
    different header is an error, never a silent shift. With ``split`` plain UTF-8
    files are read by many tasks each (quotes in quoted fields only).
    """
    if schema is not None:
        df = _read(spark, path, schema, multiline, encoding)
    else:
        frames = []
        found = header_groups(spark, path, encoding)
        for line, files in found.items():
            own = header_schema(spark, path, encoding, line)
            plain = [f for f in files if f[0].lower().endswith((".csv", ".txt"))] if split and multiline and encoding == "UTF-8" else []
            rest = [f for f, _ in files if (f, _) not in plain]
            if plain:
                frames.append(splitcsv.read_split_csv(spark, plain, own))
            if rest:
                frames.append(_read(spark, path if len(found) == 1 and not plain else rest, own, multiline, encoding))
        df = union_all(frames) if frames else _read(spark, path, header_schema(spark, path, encoding), multiline, encoding)
    df = null_na_tokens(df)
    if partitions:
        df = df.repartition(partitions)
    return df


def resolve_dataset(spark: SparkSession, folder: str, preferred: list[str], contains: str, suffix: str) -> str | None:
    """SRC-4: exact preferred names first (in order), else any file whose name
    contains ``contains`` and ends with ``suffix`` (first by name); None if absent.

    A folder of such a name, whose part files are the dataset, is a candidate like a
    file, so a large dataset need not be one file. The listing is the file system's
    own; no content is read.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return None
    found = {s.getPath().getName(): s.getPath().toString() for s in fs.listStatus(p)
             if not s.getPath().getName().startswith(("_", ".")) and (s.isFile() or csv_files(spark, s.getPath().toString()))}
    fitting = [*preferred, *sorted(n for n in found if contains in n and n.endswith(suffix))]
    return next((found[n] for n in fitting if n in found), None)
