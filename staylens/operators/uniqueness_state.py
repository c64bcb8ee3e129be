"""Incremental uniqueness (DQ-8): rows that repeat a key, maintained over landings.

Keys seen so far are a snapshot table with a part for every landing and key
bucket, and beside each part lies a Bloom filter of its keys. The distinct keys of
a landing are held against the filters of their buckets; only keys that a filter
may hold are looked up, and only in the parts whose filters said so. Keys that are
new become the landing's parts. Every row beyond a key's first counts as failed,
all null keys are one key, as in ``quality.rule_report``.

A filter takes ten bits a key, so about one key in a hundred is looked up for
nothing; that costs reading, never the count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.sources import snapshots

BITS, HASHES = 10, 7
FILTERS = "part string, bucket int, filter binary"


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """HASHES bit places of each key, from the two halves of its hash."""
    h = hashes.astype(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + high[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(size)).astype(np.int64)


def _build(keys: pa.Table) -> pa.Table:
    """The filter of one part."""
    size = max(64, BITS * keys.num_rows)
    bits = np.zeros(size, bool)
    bits[_places(keys.column("hash").to_numpy(), size).ravel()] = True
    raw = size.to_bytes(8, "little") + np.packbits(bits).tobytes()
    return pa.table({"part": keys.column("part").slice(0, 1), "bucket": keys.column("bucket").slice(0, 1), "filter": pa.array([raw], pa.binary())})


def _maybe(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """(hash, part): which parts may hold a key of this bucket."""
    h = keys.column("hash").to_numpy()
    found, parts = [np.zeros(0, np.int64)], []
    for part, raw in zip(filters.column("part").to_pylist(), filters.column("filter").to_pylist()):
        size = int.from_bytes(raw[:8], "little")
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, offset=8), count=size).astype(bool)
        hit = h[bits[_places(h, size)].all(axis=1)]
        found.append(hit)
        parts += [part] * len(hit)
    return pa.table({"hash": pa.array(np.concatenate(found)), "part": pa.array(parts, pa.string())})


def land(landing: DataFrame, table: str, key: str, buckets: int = 64) -> dict:
    """Add a landing to the state at ``table``; rows, distinct keys and failed rows of all landings so far.

    ``buckets`` counts for the first landing; later ones keep the table's own. (A key's part is its landing and bucket.)
    """
    spark = landing.sparkSession
    base, filters = snapshots.current(spark, f"{table}/keys"), snapshots.current(spark, f"{table}/filters")
    before = base.meta if base else {"landings": 0, "rows": 0, "distinct": 0, "buckets": buckets}
    buckets, number = before["buckets"], before["landings"]
    shaped = landing.select(F.col(key).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    hashed = shaped.withColumn("hash", F.xxhash64("key")).withColumn("bucket", F.pmod("hash", F.lit(buckets)).cast("int"))
    keys = hashed.withColumn("part", F.concat(F.lit(f"{number}-"), F.col("bucket").cast("string")))
    rows = shaped.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    new = keys.drop("n")
    if base is not None and filters is not None:
        held = snapshots.read(spark, f"{table}/filters", filters)
        maybe = new.select("hash", "bucket").groupBy("bucket").cogroup(held.groupBy("bucket")).applyInArrow(_maybe, "hash long, part string")
        parts = [r["part"] for r in maybe.select("part").distinct().collect()]  # parts, not keys
        if parts:
            old = snapshots.read(spark, f"{table}/keys", base, parts).select(F.col("key").alias("__key"), F.col("hash").alias("__hash"), "part")
            known = maybe.join(old, [maybe["hash"] == old["__hash"], maybe["part"] == old["part"]]).select("__key", "__hash").distinct()
            new = new.join(known, [F.col("hash") == F.col("__hash"), F.col("key").eqNullSafe(F.col("__key"))], "left_anti")
    path = f"{table}/new-{number}"
    new.write.mode("overwrite").parquet(path)  # counted and kept as one and the same
    new = spark.read.schema(new.schema).parquet(path)
    fresh = new.count()
    meta = {"landings": number + 1, "rows": before["rows"] + rows, "distinct": before["distinct"] + fresh, "buckets": buckets}
    # filters first: a filter without keys costs a look-up, keys without a filter would be missed
    snapshots.replace_parts(new.groupBy("part").applyInArrow(_build, FILTERS), f"{table}/filters", "part")
    snapshots.replace_parts(new, f"{table}/keys", "part", meta)
    return {"landing": number, "rows": meta["rows"], "distinct": meta["distinct"], "failed": meta["rows"] - meta["distinct"]}


def state(spark: SparkSession, table: str) -> dict:
    """What the newest landing left."""
    return snapshots.current(spark, f"{table}/keys").meta
