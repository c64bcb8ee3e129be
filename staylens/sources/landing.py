"""Landed-file checks (SRC-7, SRC-8, SRC-9)."""

from __future__ import annotations

import datetime as dt
import fnmatch

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def landed_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(file_name, path, size_bytes, modified) for every file, empty ones too; content is never read.

    The listing is the file system's own (Spark's readers skip empty files), a
    driver-side metadata call like the listing before any scan. ``file_name`` is
    relative to the folder: "listings_listings.csv.gz" for a flat folder,
    "listings/part-00000.csv.gz" for a dataset subfolder.
    """
    return spark.createDataFrame(list_files(spark, folder, glob), "file_name string, path string, size_bytes long, modified timestamp")


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> list[tuple]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    base = fs.makeQualified(root).toString().rstrip("/")
    found, out = fs.listFiles(root, True), []
    while found.hasNext():
        f = found.next()
        path = f.getPath().toString()
        name = path[len(base) + 1 :]
        if fnmatch.fnmatchcase(path.rsplit("/", 1)[-1], glob) and not any(x.startswith(("_", ".")) for x in name.split("/")):
            out.append((name, path, f.getLen(), dt.datetime.fromtimestamp(f.getModificationTime() / 1000)))
    return sorted(out)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).create(p, False).close()


def check_files(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """SRC-7: every expected file exists and is non-empty (left join, no content read)."""
    j = manifest.join(landed.select("file_name", "path", "size_bytes"), "file_name", "left")
    return j.withColumn("is_ok", F.coalesce(F.col("size_bytes") > 0, F.lit(False)))


def file_record_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SRC-8: records per file (quoted newlines count once) in one job for all files."""
    if not paths:
        return spark.createDataFrame([], "path string, row_count long")
    # counting records needs no columns: a one-column schema skips header inference
    df = (spark.read.schema("c0 string").option("header", True).option("multiLine", True)
          .option("quote", '"').option("escape", '"').option("enforceSchema", True).csv(paths))
    # the metadata column is URL-encoded ("%20"), the listing is not
    path = F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B")))
    counts = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).cast("long").alias("row_count"))
    return counts.select(path.alias("path"), "row_count")  # decoded once a file, not once a record


def count_each(spark: SparkSession, paths: list[str]) -> tuple[dict[str, int], dict[str, str]]:
    """SRC-8 with bad files set apart: records by path, and the error of each file that can't be read.

    All files are counted in one job. Only if it fails are the halves tried, down
    to the files that are at fault, so one bad file costs a few jobs more and no
    other file its count. A file that has a header and no record counts 0.
    """
    if not paths:
        return {}, {}
    try:
        found = {r["path"]: r["row_count"] for r in file_record_counts(spark, paths).collect()}
        if unknown := set(found) - set(paths):
            raise ValueError(f"counted files that were not asked for: {sorted(unknown)[:3]}")
        return {p: found.get(p, 0) for p in paths}, {}
    except (PySparkException, Py4JJavaError) as e:
        if len(paths) == 1:
            return {}, {paths[0]: str(e)}
        half = len(paths) // 2
        good, bad = {}, {}
        for part in (paths[:half], paths[half:]):
            g, b = count_each(spark, part)
            good |= g
            bad |= b
        return good, bad


def rename_only_part(spark: SparkSession, folder: str, target: str) -> None:
    """Move the single part file of a written folder to a file name of its own (flat landing layouts)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    parts = [path for name, path, _, _ in list_files(spark, folder, "part-*")]
    if len(parts) != 1:
        raise ValueError(f"{folder} has {len(parts)} part files")
    to = jvm.org.apache.hadoop.fs.Path(target)
    fs = to.getFileSystem(conf)
    fs.mkdirs(to.getParent())
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(parts[0]), to):
        raise OSError(f"could not move {parts[0]} to {target}")


def preview(df: DataFrame, n: int = 1000) -> DataFrame:
    """SRC-9: bounded preview of a table (the limit is the feature)."""
    return df.limit(n)


def list_tables(spark: SparkSession) -> DataFrame:
    """SRC-9: catalog listing as a DataFrame."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "name string, table_type string, is_temporary boolean")
