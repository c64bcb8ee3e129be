import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.llm import topk

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def brute(rows, k, every):
    use = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in {(i, tuple(v)) for i, v in use if i % every == 0}:
        hits = sorted((-sum(a * b for a, b in zip(q[1], v)), i) for i, v in use if i != q[0] and len(v) == len(q[1]))
        out += [(q[0], r + 1, i, -s) for r, (s, i) in enumerate(hits[:k])]
    return sorted(out)


def vectors():
    r = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in r.normal(size=8).astype(np.float32)], 0) for i in range(400)]
    hot = rows[20][1]
    rows += [(400 + i, hot, 1) for i in range(300)]  # one very common vector: ties
    rows += [(800, None, 0), (801, [1.0, None] + [0.0] * 6, 0), (802, [float("nan")] + [0.0] * 7, 0), (803, [float("inf")] + [0.0] * 7, 0), (804, [], 0), (None, hot, 0),
             (805, [1.0, 2.0], 0), (806, [0.0] * 8, 0), (850, [0.5, -1.0], 0), (807, [1e30] * 8, 0)]
    return rows + [rows[0], rows[50], rows[3]]


@pytest.mark.parametrize("block_rows", [4, 4096])
def test_exact(spark, block_rows):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "rank": F.lit(1), "score": F.lit(2), "vec": F.lit(3)}).repartition(4)
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, block_rows=block_rows * 4 if block_rows == 4 else block_rows).collect())
    want = brute([r for r in rows if r[0] != 807], 5, 50)
    assert got == want


def test_few_and_none(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [-1.0, 2.0], 0)]
    got = sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect())
    assert got == brute(rows, 5, 50)
    assert topk.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(spark.createDataFrame(rows[:1], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
