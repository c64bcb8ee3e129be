"""Bucketed tables (JOIN-1 .. JOIN-3): marts that share a hash layout by key join without an exchange.

Rows are dealt by the key into as many partitions as there are buckets before they
are written, so a bucket is one sorted file (one for each write of a table that
grows). Use it for keys that few rows share: a bucket is read by one task, so a key
with a third of all rows belongs in a table that is aggregated by it first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of the largest table that one bucket should hold: its rows, a dozen times larger in memory, are sorted by one task.
BUCKET_BYTES = 32 << 20
FEWEST = 8


def folder_bytes(spark: SparkSession, path: str) -> int:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).getContentSummary(p).getLength()


def bucket_count(total_bytes: int) -> int:
    """A power of two, so that tables of another size still meet without a full exchange."""
    wanted = max(FEWEST, -(-total_bytes // BUCKET_BYTES))
    return 1 << (int(wanted) - 1).bit_length()


def save_bucketed(df: DataFrame, path: str, key: str, buckets: int, name: str | None = None) -> str:
    """Write ``df`` bucketed and sorted by ``key`` at ``path``; the name of its catalog table (of this session's catalog)."""
    name = name or f"staylens_{uuid.uuid4().hex[:12]}"
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return name
