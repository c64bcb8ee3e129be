"""Packing token sequences by non-negative least squares on the length histogram.

1. Every document becomes token ids and one end id. It is cut into full windows
   and one rest of 1 to ``window - 1`` ids; full windows need no packing.
2. Only the histogram of rest lengths (at most ``window`` counts, whatever the
   size of the corpus) comes to the driver. Shallow combinations of up to three
   length classes that fill a window are enumerated; non-negative least squares
   finds how often to repeat each of them to use up the histogram; the counts
   are rounded and held to what is there. What is left over is packed greedily:
   rest after rest, cut where a window is full, so that no length, however
   common, leaves padding.
3. A rest's place in the plan follows from its rank among the rests of its
   length: its rank in its task (kept with the row) plus the counts of earlier
   tasks (a small table). Sequence and offset are then arithmetic, so no task
   ever sees the rests of one length together, however common that length is.

Null or empty text: the end id alone. Repeated rows: each is packed. The ids
are written once to the shared folder, so ranks and plan hold when executors
are lost.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm import encode, words
from staylens.session import shared_path

WINDOW = 2048
UNIT = 16
END_ID = 1
SLICE = 2 << 20
_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, task int, slot long"


def _cut(path: str, window: int, end_id: int):
    def run(batches):
        model, task = encode.kept(encode.WordBpe, path), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for texts in words.slices(batch.column(1), most=SLICE):
                ids, borders = model.encode(texts)
                out = [[] for _ in range(7)]
                for i in range(len(texts)):
                    own = np.append(ids[borders[i] : borders[i + 1]].astype("<u4"), np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(own), window):
                        piece = own[start : start + window]
                        n = len(piece)
                        for column, x in zip(out, (doc_ids[texts.rows.start + i], start, n, piece.tobytes(), len(own), task, seen[n])):
                            column.append(x)
                        seen[n] += 1
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "start", "length", "ids", "doc_tokens", "task", "slot"])

    return run


def combinations(units: int) -> np.ndarray:
    """All of one, two or three classes (0: none) that fill ``units`` exactly, in falling order."""
    a, b = np.meshgrid(np.arange(1, units + 1), np.arange(0, units + 1), indexing="ij")
    c = units - a - b
    use = (a >= b) & (b >= c) & (c >= 0)
    return np.stack([a[use], b[use], c[use]], axis=1)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Non-negative least squares by active sets, on the normal equations."""
    gram, target = a.T @ a, a.T @ b
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tol = 1e-10 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(rounds):
        slope = np.where(used, -np.inf, target - gram @ x)
        best = int(np.argmax(slope))
        if slope[best] <= tol:
            break
        used[best] = True
        while True:
            at = np.flatnonzero(used)
            s = np.linalg.lstsq(gram[np.ix_(at, at)], target[at], rcond=None)[0]
            if (s > 1e-12).all():
                x[:] = 0
                x[at] = s
                break
            bad = s <= 1e-12
            room = x[at][bad] / np.maximum(x[at][bad] - s[bad], 1e-300)
            x[at] += min(1.0, float(room.min(initial=1.0))) * (s - x[at])
            x[x < 1e-12] = 0
            used &= x > 0
            if not used.any():
                return x
    return x


def _take(left: np.ndarray, members: list[int], times: int) -> int:
    """Use a combination as often as asked for, or as often as there is enough left."""
    times = min([times, *(int(left[m]) // members.count(m) for m in set(members))])
    for m in members:
        left[m] -= times
    return times


def solved(have: np.ndarray) -> list[tuple[list[int], int]]:
    """Shallow combinations of classes (1 up) and their repeat counts, within ``have``."""
    total, left, out = int(have.sum()), have.copy(), []
    combos = combinations(len(have) - 1)
    present = np.concatenate([[True], have[1:] > 0])
    combos = combos[present[combos].all(axis=1)]
    if not total or not len(combos):
        return out
    a = np.zeros((len(have), len(combos)))
    for column in combos.T:
        np.add.at(a, (column, np.arange(len(combos))), 1.0)
    x = nnls(a[1:], left[1:] / total) * total
    for i in np.argsort(-x, kind="stable"):
        if x[i] >= 0.5:
            members = [int(m) for m in combos[i] if m]
            if times := _take(left, members, int(x[i] + 0.5)):
                out.append((members, times))
    return out


@dataclass
class Plan:
    """Where the n-th piece of a length goes; arrays of at most ``window`` or plan length."""

    window: int
    unit: int
    before: np.ndarray  # by length: rests shorter than it, and all rests at the end
    class_first: np.ndarray  # by class: rests of lower classes
    combos: np.ndarray  # combination x position: class, 0 where none
    slot_from: np.ndarray  # combination x position: the class's rank that the first repeat takes
    first_seq: np.ndarray  # by combination
    slots: list  # by class: (first ranks in order, combination, position)
    taken: np.ndarray  # by class: rests that the combinations use
    left_at: np.ndarray  # by length: where its first left-over rest starts

    def place(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Where these pieces start, in ids from the start of the first sequence."""
        out = rank * self.window  # full windows come first
        kind = np.where(length < self.window, -(-length // self.unit), 0)
        for c in np.unique(kind[kind > 0]):
            rows = np.flatnonzero(kind == c)
            r = self.before[length[rows]] - self.class_first[c] + rank[rows]
            over = r >= self.taken[c]
            lens = length[rows[over]]
            start = np.maximum(self.before[lens], self.class_first[c] + self.taken[c]) - self.class_first[c]
            out[rows[over]] = self.left_at[lens] + (r[over] - start) * lens
            rows, r = rows[~over], r[~over]
            if not len(rows):
                continue
            firsts, combo_of, position_of = self.slots[c]
            i = np.searchsorted(firsts, r, "right") - 1
            combo, position, turn = combo_of[i], position_of[i], r - firsts[i]
            at = (self.first_seq[combo] + turn) * self.window
            for j in range(int(position.max(initial=0))):
                earlier = np.flatnonzero(position > j)
                k = combo[earlier]
                whole = self.class_first[self.combos[k, j]] + self.slot_from[k, j] + turn[earlier]
                at[earlier] += np.searchsorted(self.before, whole, "right") - 1
            out[rows] = at
        return out


def make_plan(histogram: dict[int, int], window: int = WINDOW, unit: int = UNIT) -> Plan:
    """The plan for a histogram of piece lengths."""
    by_length = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        by_length[length] = n
    seq = int(by_length[window])
    by_length[window] = 0
    kind = -(-np.arange(window + 1) // unit)
    have = np.bincount(kind, by_length, minlength=kind[-1] + 1).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(by_length)])
    class_first = np.concatenate([[0], np.cumsum(have)])[:-1]
    plan = solved(have)
    taken = np.zeros(len(have), np.int64)
    combos, slot_from, first_seq = np.zeros((len(plan), 3), np.int64), np.zeros((len(plan), 3), np.int64), np.zeros(len(plan), np.int64)
    slots: list = [([], [], []) for _ in have]
    for i, (members, times) in enumerate(plan):
        first_seq[i] = seq
        seq += times
        for j, c in enumerate(members):
            combos[i, j], slot_from[i, j] = c, taken[c]
            for column, x in zip(slots[c], (int(taken[c]), i, j)):
                column.append(x)
            taken[c] += times
    # a class's rests are ranked by length; the combinations take the first of them
    left = np.minimum(by_length, np.maximum(before[1:] - (class_first + taken)[kind], 0))
    left_at = seq * window + np.concatenate([[0], np.cumsum(left * np.arange(window + 1))])[:-1]
    return Plan(window, unit, before, class_first, combos, slot_from, first_seq, [tuple(np.array(c, np.int64) for c in s) for s in slots], taken, left_at)


#: The starts table (one row for each task and length) is broadcast up to so many rows.
MOST_SENT = 500_000


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, end_id: int = END_ID, unit: int = UNIT) -> DataFrame:
    """Pieces of all documents (doc_id, text) with their sequence and offset.

    Columns: doc_id, start, length, doc_tokens, ids (little-endian unsigned
    32-bit), sequence_id, offset. Queries that don't use ids don't read them.
    """
    spark = docs.sparkSession
    path = tokenizer or encode.tokenizer_path("word_bpe_49k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = rows.mapInArrow(_cut(path, window, end_id), _PIECES)
    where = shared_path(spark, "pieces")
    cut.write.option("compression", "zstd").parquet(where)
    pieces = spark.read.schema(cut.schema).parquet(where)
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = per_task.groupBy("length").agg(F.sum("n").alias("n"), F.count("*").alias("tasks")).collect()
    plan = make_plan({r["length"]: r["n"] for r in counts}, window, unit)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("from"))
    if sum(r["tasks"] for r in counts) <= MOST_SENT:
        starts = F.broadcast(starts)

    @F.pandas_udf("long")
    def place(length: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(plan.place(length.to_numpy(), rank.to_numpy()))

    placed = pieces.join(starts, ["length", "task"]).withColumn("at", place("length", F.col("from") + F.col("slot")))
    placed = placed.withColumn("room", F.least("length", F.lit(window) - F.col("at") % window))
    whole = F.struct(F.lit(0).cast("long").alias("skip"), F.col("room").alias("length"))
    rest = F.struct(F.col("room").alias("skip"), (F.col("length") - F.col("room")).alias("length"))
    parts = F.explode(F.when(F.col("room") < F.col("length"), F.array(whole, rest)).otherwise(F.array(whole)))
    out = placed.select("doc_id", "start", "doc_tokens", "ids", "at", parts.alias("part"))
    return out.select(
        "doc_id", (F.col("start") + F.col("part.skip")).alias("start"), F.col("part.length").alias("length"), "doc_tokens",
        F.substring("ids", (F.col("part.skip") * 4 + 1).cast("int"), (F.col("part.length") * 4).cast("int")).alias("ids"),
        F.expr(f"(at + part.skip) div {int(window)}").alias("sequence_id"),
        ((F.col("at") + F.col("part.skip")) % window).alias("offset"))
