"""Exact top-k search by distributed histogram selection.

Every query is scored against every vector, several times over, and only
counts travel: a first global histogram of scores per query shows the bin that
holds the k-th highest score, the next pass splits that bin again, until a bin
is one integer wide and the k-th value is known exactly. A last pass keeps what
lies above that value and, of the ties at it, the smallest ids.

* Queries come in blocks of at most ``block_rows`` (hash blocks sized from a
  count, checked when fetched); a block is the only thing sent to all tasks, so
  memory does not grow with the table. The candidates are scanned where they
  lie, never shuffled.
* A task sends, per query, only bins that can still hold the k-th value (those
  down to where its own count reaches k): at most k counts and k rows a query.

Rows with a null id, a null vector, null or non-finite components, or a
component so large that scores could pass 62 bits take no part. Vectors of
another length than the query's are not scored against it. A vector never
meets rows of its own id; repeated equal rows are one query, but each of them
is a candidate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.session import shared_path

BINS = 512
CHUNK = 2048
_STATS = "dim int, norm2 double"
_QUERY = "id long, dim int, vec binary"
_COUNT = "q int, bin int, n long"
_HIT = "q int, id long, score long"


def _vectors(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, ids, integer vectors) of the rows that take part, in bounded chunks."""
    for batch in batches:
        ids, column = batch.column(0), batch.column(1)
        use = np.flatnonzero(~ids.is_null().to_numpy(False) & ~column.is_null().to_numpy(False))
        if not len(use):
            continue
        ids, column = ids.take(pa.array(use)), column.take(pa.array(use))
        lens = column.value_lengths().to_numpy(False)
        flat = column.flatten().cast(pa.float64())
        values = flat.to_numpy(zero_copy_only=False)  # null components become NaN
        at = np.concatenate([[0], np.cumsum(lens)])
        ids = ids.to_numpy(False)
        for dim in np.unique(lens[lens > 0]):
            own = np.flatnonzero(lens == dim)
            for i in range(0, len(own), CHUNK):
                rows = own[i : i + CHUNK]
                m = np.floor(values[at[rows][:, None] + np.arange(dim)] * scale)
                with np.errstate(invalid="ignore"):
                    good = (np.abs(m) <= math.sqrt(2.0**62 / dim)).all(axis=1)
                if good.any():
                    yield int(dim), ids[rows][good].astype(np.int64), m[good].astype(np.int64)


class _Block:
    """One block of queries, by vector length, ready for scoring."""

    def __init__(self, rows: list, norm: dict[int, float]) -> None:
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.parts = {}
        for dim in {r["dim"] for r in rows}:
            own = np.array([i for i, r in enumerate(rows) if r["dim"] == dim])
            m = np.stack([np.frombuffer(rows[i]["vec"], np.int64) for i in own])
            most = math.sqrt(float((m.astype(float) ** 2).sum(axis=1).max()) * norm.get(dim, 0.0))
            self.parts[dim] = (own, m, self.ids[own], most < 2.0**52)
        self.bound = np.zeros(len(rows), np.int64)
        for dim, (own, m, _, _) in self.parts.items():
            self.bound[own] = np.ceil(np.sqrt((m.astype(float) ** 2).sum(axis=1) * norm.get(dim, 0.0))).astype(np.int64) + 1

    def scores(self, dim: int, ids: np.ndarray, m: np.ndarray):
        """Query places, scores (query x candidate), and which pairs are a query and its own id."""
        if dim not in self.parts:
            return None
        own, q, qids, exact = self.parts[dim]
        s = (q.astype(np.float64) @ m.T.astype(np.float64)).astype(np.int64) if exact else q @ m.T
        same = qids[:, None] == ids[None, :] if np.isin(ids, qids).any() else None
        return own, s, same


def _counter(block, scale, lo, width, k):
    def run(batches):
        n = len(lo)
        counts = np.zeros(n * BINS, np.int64)
        for dim, ids, m in _vectors(batches, scale):
            if (got := block.value.scores(dim, ids, m)) is None:
                continue
            own, s, same = got
            bins = (s - lo[own][:, None]) // width[own][:, None]
            use = (bins >= 0) & (bins < BINS)
            if same is not None:
                use &= ~same
            counts += np.bincount((own[:, None] * BINS + np.clip(bins, 0, BINS - 1))[use], minlength=n * BINS)
        counts = counts.reshape(n, BINS)
        # from the top: a bin matters while the bins above it hold fewer than k
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (above < k))
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(counts[q, b])], ["q", "bin", "n"])

    return run


def _smallest(q, ids, score, k):
    """Of each query's hits the k best by (score down, id up)."""
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], ids[keep], score[keep]


def _keeper(block, scale, floor, k):
    def run(batches):
        held = [np.zeros(0, np.int64)] * 3
        for dim, ids, m in _vectors(batches, scale):
            if (got := block.value.scores(dim, ids, m)) is None:
                continue
            own, s, same = got
            use = s >= floor[own][:, None]
            if same is not None:
                use &= ~same
            a, b = np.nonzero(use)
            held = _smallest(*(np.concatenate(x) for x in zip(held, (own[a], ids[b], s[a, b]))), k)
        q, ids, score = held
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(ids), pa.array(score)], ["q", "id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding", block_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k highest integer inner products."""
    spark = vectors.sparkSession
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"))

    def stats(batches):
        for dim, _, m in _vectors(batches, scale):
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([float((m.astype(float) ** 2).sum(axis=1).max())])], ["dim", "norm2"])

    def parsed(batches):
        for dim, ids, m in _vectors(batches, scale):
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([dim] * len(ids), pa.int32()), pa.array([x.tobytes() for x in m], pa.binary())], ["id", "dim", "vec"])

    norm = {r["dim"]: r["norm2"] for r in base.mapInArrow(stats, _STATS).groupBy("dim").agg(F.max("norm2").alias("norm2")).collect()}
    queries = vectors.where(is_query).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"))
    queries = queries.mapInArrow(parsed, _QUERY).dropDuplicates()
    blocks = max(1, math.ceil(queries.count() / (0.75 * block_rows)))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)))
    path = shared_path(spark, "topk")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    empty.write.mode("append").parquet(path)
    for b in range(blocks):
        rows = sorted(queries.where(F.col("block") == b).limit(block_rows + 1).collect(), key=lambda r: (r["id"], r["vec"]))
        if len(rows) > block_rows:
            raise ValueError(f"more than {block_rows} queries in a block; ask for smaller blocks")
        if not rows:
            continue
        block = _Block(rows, norm)
        sent = spark.sparkContext.broadcast(block)
        floor = _kth(base, sent, block, scale, k)
        best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        names = F.broadcast(spark.createDataFrame([(i, int(x)) for i, x in enumerate(block.ids)], "q int, query_id long"))
        (base.mapInArrow(_keeper(sent, scale, floor, k), _HIT)
         .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
         .join(names, "q").select("query_id", "rank", F.col("id").alias("vec_id"), "score")
         .write.mode("append").parquet(path))
        sent.unpersist()
    return spark.read.schema(empty.schema).parquet(path)


def _kth(base: DataFrame, sent, block: _Block, scale: int, k: int) -> np.ndarray:
    """Each query's k-th highest score (its lowest possible one if it has fewer partners)."""
    n = len(block.ids)
    span, first = 2 * int(block.bound.max()) + 1, 1
    while first * BINS < span:
        first *= BINS  # so that a bin is split into whole bins, down to one integer each
    lo, width, need = -block.bound, np.full(n, first), np.full(n, k)
    few = np.zeros(n, bool)
    while True:
        got = base.mapInArrow(_counter(sent, scale, lo, width, k), _COUNT).groupBy("q", "bin").agg(F.sum("n").alias("n")).collect()
        counts = np.zeros((n, BINS), np.int64)
        for r in got:
            counts[r["q"], r["bin"]] = r["n"]
        down = np.cumsum(counts[:, ::-1], axis=1)
        few |= down[:, -1] < need  # only ever in the first pass
        place = np.argmax(down >= need[:, None], axis=1)
        before = np.where(place > 0, down[np.arange(n), np.maximum(place - 1, 0)], 0)
        lo = np.where(few, lo, lo + (BINS - 1 - place) * width)
        need = np.where(few, 1, need - before)
        if (width == 1).all():
            return np.where(few, -block.bound - 1, lo)
        width = width // BINS
