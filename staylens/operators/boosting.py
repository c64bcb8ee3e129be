"""Second-order boosted trees (ML-4) as barrier stages, scoring and leaf paths (ML-8, ML-9).

Trees grow level by level on binned features: a level's histograms hold the sums
of gradients and hessians by node and bin, a split's gain has the L2 term on
leaves, children must have a minimum hessian, and every tree sees its own sample
of columns and rows. Training rows stay in their tasks. A barrier stage grows a
run of trees: its tasks exchange only histograms (bounded by nodes x bins, not by
rows) with ``allGather``, add them up in the same order and so choose the same
splits. A stage starts from the rows, written once to the shared folder, and the
trees so far, so a lost executor repeats one stage, not the fit.

Rows are dealt to as few tasks as hold them (a small table trains in one task
without any exchange), never more than the cluster runs at a time, as a barrier
stage must run at once. The number of rows decides on tasks alone, never on the
trees: each grows on what all trees before it leave, over any table. An exchange
takes about a second whatever it carries (Spark polls it), so a fit over several
tasks takes at least a second for each level of each tree. A caller can ask for rounds (``at_once``), which give other
trees: those of a round grow side by side on the same gradients, a level of all of
them an exchange, at a rate such that a round goes as far as they would one after another.

Features of few bins share one code (its histogram is added up to theirs), and of two
sibling nodes the larger one's histogram is the parent's less the smaller one's.

Scoring walks all trees for whole column batches. ``leaf_paths`` turns trees into
rows of (feature, interval) conditions and a value, from which attributions are
exact.
"""

from __future__ import annotations

import base64
import math
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from staylens.session import shared_path

TREES = "tree int, feature array<int>, threshold array<double>, value array<double>"


@dataclass
class BoostParams:
    """The source's settings; ``l2``, ``columns`` (a tree) and ``min_child_weight`` as its library means them."""

    max_iter: int = 500
    max_depth: int = 6
    step_size: float = 0.05
    subsampling_rate: float = 0.8
    columns: float = 0.8
    min_child_weight: float = 5.0
    l2: float = 1.0
    max_bins: int = 256
    seed: int = 42
    trees_per_stage: int = 100
    rows_per_task: int = 250_000

    round_rows: int = 250_000
    at_once: int = 1

    def of_rows(self, n: int) -> BoostParams:
        """Settings in rounds for more than ``round_rows`` rows, of as many trees as together step half of the way, if trees see
        samples (they would be alike otherwise). Only for callers who want other trees over large tables: ``fit`` never asks."""
        sampled = self.subsampling_rate < 1 or self.columns < 1
        return replace(self, at_once=max(1, int(0.5 / self.step_size)) if sampled and n > self.round_rows else 1)

    @property
    def rate(self) -> float:
        """A tree's rate: a round takes off what its trees would one after another."""
        n = self.at_once
        return (1 - (1 - self.step_size) ** n) / n if n > 1 else self.step_size


@dataclass
class BoostedTrees:
    """Complete binary trees: inner node i has children 2i+1 (feature <= threshold) and 2i+2; a node that was not
    split sends all rows left."""

    base: float
    feature: np.ndarray  # trees x (2^depth - 1)
    threshold: np.ndarray
    value: np.ndarray  # trees x 2^depth

    @property
    def depth(self) -> int:
        return int(math.log2(self.value.shape[1])) if len(self.value) else 0

    def predict(self, x: np.ndarray, start: int = 0) -> np.ndarray:
        """The trees' sum from tree ``start`` on for the rows of ``x`` (without the base from later trees on)."""
        n = len(x)
        rows, flat = np.arange(n), np.ascontiguousarray(x.T).ravel()
        out = np.full(n, self.base if start == 0 else 0.0)
        inner = self.feature.shape[1]
        for f, t, v in zip(self.feature[start:] * n, self.threshold[start:], self.value[start:]):
            node = np.zeros(n, np.int64)
            for _ in range(self.depth):
                right = flat.take(f.take(node) + rows) > t.take(node)
                node = 2 * node + 1 + right
            out += v.take(node - inner)
        return out

    def head(self, n: int) -> BoostedTrees:
        """The first ``n`` trees."""
        return BoostedTrees(self.base, self.feature[:n], self.threshold[:n], self.value[:n])

    def rows(self) -> list[tuple]:
        """Trees as rows of TREES; row -1 holds the base."""
        base = [(-1, [0], [0.0], [self.base])]
        return base + [(i, f.tolist(), t.tolist(), v.tolist()) for i, (f, t, v) in enumerate(zip(self.feature, self.threshold, self.value))]

    @classmethod
    def of_rows(cls, rows) -> BoostedTrees:
        ordered = sorted(((r[0], r[1], r[2], r[3]) for r in rows), key=lambda r: r[0])
        trees = ordered[1:]
        width = len(trees[0][1]) if trees else 0
        return cls(float(ordered[0][3][0]), np.array([r[1] for r in trees], np.int64).reshape(len(trees), width),
                   np.array([r[2] for r in trees], float).reshape(len(trees), width), np.array([r[3] for r in trees], float).reshape(len(trees), width + 1 if trees else 0))


def _mix(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bundles(sizes: list[int], limit: int = 1024) -> list[list[int]]:
    """Features put together, small ones first, while their bins' product is within ``limit``."""
    out, product = [], 0
    for f in sorted(range(len(sizes)), key=lambda f: sizes[f]):
        if out and product * sizes[f] <= limit:
            out[-1].append(f)
            product *= sizes[f]
        else:
            out.append([f])
            product = sizes[f]
    return out


class _Grower:
    """Trees over the rows of one task; ``gather`` adds an array up over all tasks."""

    CHUNK = 1 << 16

    def __init__(self, cuts: list[list[float]], p: BoostParams, gather) -> None:
        self.p, self.gather, self.cuts = p, gather, cuts
        self.sizes = np.array([len(c) + 1 for c in cuts])
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.bins = int(self.sizes.sum())
        self.cut = np.concatenate([np.append(c, np.inf) for c in cuts]).astype(float)  # the last bin of a feature has no cut
        self.of_bin = np.repeat(np.arange(len(cuts)), self.sizes)
        self.bundles = _bundles(self.sizes.tolist())

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bins of the rows of ``x``: features x rows, and bundles x rows."""
        code = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(self.cuts)]).astype(np.min_scalar_type(int(self.sizes.max())))
        joint = np.zeros((len(self.bundles), len(x)), np.int32)
        for to, bundle in zip(joint, self.bundles):
            for f in bundle:
                to *= self.sizes[f]
                to += code[f]
        return code, joint

    def load(self, code: np.ndarray, joint: np.ndarray, y: np.ndarray, key: np.ndarray) -> None:
        self.code, self.joint, self.y, self.key = np.ascontiguousarray(code), joint, y, key

    def _histograms(self, node, drawn, g, small) -> np.ndarray:
        """Sums of gradients and hessians of the drawn rows by node and bin; of two siblings only ``small`` (by parent), if given."""
        nodes = 1 if small is None else len(small)
        width = [int(np.prod(self.sizes[b])) for b in self.bundles]
        sums = [np.zeros((2, nodes * w)) for w in width]
        for a in range(0, len(g), self.CHUNK):
            at = node[a : a + self.CHUNK].astype(np.int64)
            mine = drawn[a : a + self.CHUNK]
            if small is not None:
                mine = mine & ((at & 1) == small[at >> 1])
                at >>= 1
            r = np.flatnonzero(mine)
            if not len(r):
                continue
            at, weights = at[r], g[a : a + self.CHUNK][r]
            for out, w, joint in zip(sums, width, self.joint):
                index = at * w + joint[a : a + self.CHUNK][r]
                out[0] += np.bincount(index, weights=weights, minlength=nodes * w)
                out[1] += np.bincount(index, minlength=nodes * w)
        hist = np.zeros((2, nodes, self.bins))
        for out, bundle in zip(sums, self.bundles):
            cube = out.reshape(2, nodes, *self.sizes[bundle])
            for i, f in enumerate(bundle):
                others = tuple(2 + j for j in range(len(bundle)) if j != i)
                hist[:, :, self.begin[f] : self.begin[f] + self.sizes[f]] = cube.sum(axis=others)
        return hist

    def _splits(self, hist: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best cut (a bin) of every node, whether it gains anything, and the children's sums of gradients and hessians."""
        p, (g, h) = self.p, hist
        first = slice(self.begin[columns[0]], self.begin[columns[0]] + int((self.of_bin == columns[0]).sum()))
        all_g, all_h = g[:, first].sum(axis=1, keepdims=True), h[:, first].sum(axis=1, keepdims=True)
        sum_g, sum_h = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
        before = self.begin[self.of_bin] - 1
        left_g = sum_g - np.where(before >= 0, sum_g[:, before], 0.0)
        left_h = sum_h - np.where(before >= 0, sum_h[:, before], 0.0)
        right_g, right_h = all_g - left_g, all_h - left_h
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_g**2 / (left_h + p.l2) + right_g**2 / (right_h + p.l2) - all_g**2 / (all_h + p.l2)
        ok = np.isin(self.of_bin, columns) & np.isfinite(self.cut)
        gain[:, ~ok] = -np.inf
        gain[~((left_h >= p.min_child_weight) & (right_h >= p.min_child_weight) & (left_h > 0) & (right_h > 0)) | np.isnan(gain)] = -np.inf
        best = np.argmax(gain.astype(np.float32), axis=1)  # gains apart by rounding only are ties
        at = np.arange(len(best))
        gains = gain[at, best] > 1e-6
        # sums of the children: without a split all rows go left
        kept = np.stack([np.where(gains, left_g[at, best], all_g[:, 0]), np.where(gains, left_h[at, best], all_h[:, 0])])
        return best, gains, np.stack([kept, np.concatenate([all_g, all_h], axis=1).T - kept], axis=2).reshape(2, -1)

    def grow(self, numbers: list[int], held: np.ndarray, margin: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Trees of a round on the gradients at ``held``; ``margin`` is added to."""
        p, n = self.p, len(self.y)
        n_columns = max(1, round(p.columns * len(self.begin)))
        columns = [np.sort(np.random.default_rng([p.seed, i]).permutation(len(self.begin))[:n_columns]) for i in numbers]
        drawn = [_mix(self.key + np.uint64(i * 0x9E3779B97F4A7C15 % (1 << 64)) ^ np.uint64(p.seed)) >> np.uint64(11) < np.uint64(p.subsampling_rate * (1 << 53))
                 if p.subsampling_rate < 1 else np.ones(n, bool) for i in numbers]
        g = held - self.y  # squared error: the hessian of a row is 1
        inner = (1 << p.max_depth) - 1
        feature, threshold = np.zeros((len(numbers), inner), np.int64), np.full((len(numbers), inner), np.inf)
        node = np.zeros((len(numbers), n), np.min_scalar_type(2 * inner))
        hists, small, sums = [None] * len(numbers), [None] * len(numbers), [None] * len(numbers)
        flat = self.code.ravel()
        for level in range(p.max_depth):
            nodes = 1 << level
            found = self.gather(np.stack([self._histograms(*each) for each in zip(node, drawn, [g] * len(numbers), small)]))
            for i, part in enumerate(found):
                if small[i] is None:
                    hists[i] = part
                else:
                    whole, both = hists[i], np.empty((2, nodes, self.bins))
                    parent = np.arange(nodes >> 1)
                    both[:, 2 * parent + small[i]] = part
                    both[:, 2 * parent + 1 - small[i]] = whole - part
                    hists[i] = both
                best, gains, sums[i] = self._splits(hists[i], columns[i])
                at = slice(nodes - 1, 2 * nodes - 1)
                feature[i, at] = np.where(gains, self.of_bin[best], 0)
                threshold[i, at] = np.where(gains, self.cut[best], np.inf)
                small[i] = (sums[i][1][1::2] < sums[i][1][::2]).astype(np.int64)
                limit = np.where(gains, best - self.begin[feature[i, at]], self.bins)  # a code above its node's limit goes right
                begin = feature[i, at] * n
                for a in range(0, n, self.CHUNK):
                    now = node[i, a : a + self.CHUNK].astype(np.int64)
                    right = flat.take(begin.take(now) + np.arange(a, a + len(now))) > limit.take(now)
                    node[i, a : a + self.CHUNK] = 2 * now + right
        out = []
        for i in range(len(numbers)):
            value = np.where(sums[i][1] > 0, -p.rate * sums[i][0] / np.maximum(sums[i][1] + p.l2, 1e-300), 0.0)
            margin += value.take(node[i])
            out.append((feature[i], threshold[i], value))
        return out


#: What the tasks send each other at once through the driver.
EXCHANGE_BYTES = 32 << 20


def _stage(cuts, params: dict, so_far: BoostedTrees | None, number: int, tasks: int):
    """Batches of (features, label, key) to the stage's trees, from the first task."""

    def run(batches, number=number):
        p = BoostParams(**params)
        gather, rank = (lambda a: a), 0
        if tasks > 1:
            from pyspark import BarrierTaskContext

            context = BarrierTaskContext.get()
            rank = context.partitionId()
            piece = max(1, EXCHANGE_BYTES // (11 * tasks))  # a number is 11 characters

            def gather(a: np.ndarray) -> np.ndarray:
                flat, out = np.ascontiguousarray(a, dtype=float).ravel(), []
                for i in range(0, len(flat), piece):
                    sent = context.allGather(base64.b64encode(flat[i : i + piece].tobytes()).decode())
                    total = np.zeros(len(flat[i : i + piece]))
                    for s in sent:
                        total += np.frombuffer(base64.b64decode(s))
                    out.append(total)
                return np.concatenate(out).reshape(a.shape)

        grower = _Grower(cuts, p, gather)
        done = 0 if so_far is None else len(so_far.value)
        begun = done - done % p.at_once  # trees of a round that a stage before began keep its gradients
        codes, joints, ys, keys, helds, later = [], [], [np.zeros(0)], [np.zeros(0, np.uint64)], [np.zeros(0)], [np.zeros(0)]
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(cuts))
            code, joint = grower.codes(x)
            codes.append(code)
            joints.append(joint)
            ys.append(b.column(1).to_numpy(zero_copy_only=False))
            keys.append(b.column(2).to_numpy(zero_copy_only=False).astype(np.uint64))
            if so_far is not None:
                helds.append(so_far.head(begun).predict(x))
                later.append(so_far.predict(x, begun) if begun else so_far.predict(x) - so_far.base)
        if not codes:
            code, joint = grower.codes(np.zeros((0, len(cuts))))
            codes, joints = [code], [joint]
        y = np.concatenate(ys)
        grower.load(np.concatenate(codes, axis=1), np.concatenate(joints, axis=1), y, np.concatenate(keys))
        del codes, joints, ys, keys
        if so_far is None:
            total = gather(np.array([y.sum(), float(len(y))]))
            base = total[0] / total[1] if total[1] else 0.0
            held = np.full(len(y), base)
            margin = held.copy()
        else:
            base, held = so_far.base, np.concatenate(helds)
            margin = held + np.concatenate(later)
        del helds, later
        trees = [(-1, [0], [0.0], [base])] if so_far is None else []
        while number:
            now = min(number, p.at_once - done % p.at_once)
            trees += [(done + i, *(a.tolist() for a in t)) for i, t in enumerate(grower.grow(list(range(done, done + now)), held, margin))]
            done, number = done + now, number - now
            if done % p.at_once == 0:
                held = margin.copy()
        if rank == 0:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*trees), (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.float64())))],
                                             ["tree", "feature", "threshold", "value"])

    return run


def candidate_cuts(rows: DataFrame, n_features: int, max_bins: int) -> tuple[list[list[float]], int]:
    """Cut values of each feature (its quantiles; all of its values if they are few), and the number of rows."""
    at = [i / max_bins for i in range(max_bins + 1)]
    one = rows.agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(F.col("features")[i], at, 20 * max_bins).alias(f"q{i}") for i in range(n_features)]).first()
    return [sorted(set(one[f"q{i}"] or []))[:-1] for i in range(n_features)], one["n"]


def fit(train: DataFrame, features: list[str], label: str, key: str, params: BoostParams | None = None) -> BoostedTrees:
    """Fit on numeric columns; rows whose label is null are left out. A table without rows gives the base 0 and no splits."""
    spark, p = train.sparkSession, params or BoostParams()
    path = shared_path(spark, "training-rows")
    shaped = train.where(F.col(label).isNotNull()).select(
        F.array(*[F.col(c).cast("double") for c in features]).alias("features"), F.col(label).cast("double").alias("label"),
        F.shiftrightunsigned(F.xxhash64(key), 1).alias("key"))
    shaped.write.parquet(path)
    rows = spark.read.schema(shaped.schema).parquet(path)
    cuts, n = candidate_cuts(rows, len(features), p.max_bins)
    tasks = max(1, min(-(-n // p.rows_per_task), spark.sparkContext.defaultParallelism))
    dealt = rows.repartition(tasks, "key") if tasks > 1 else rows.coalesce(1)
    model: BoostedTrees | None = None
    for begin in range(0, p.max_iter, p.trees_per_stage):
        number = min(p.trees_per_stage, p.max_iter - begin)
        grown = dealt.mapInArrow(_stage(cuts, asdict(p), model, number, tasks), TREES, barrier=tasks > 1).collect()  # trees, bounded by the stage
        model = BoostedTrees.of_rows(grown if model is None else [*model.rows(), *grown])
    return model


def transform(model: BoostedTrees, df: DataFrame, features: list[str], output: str = "prediction") -> DataFrame:
    """``df`` with predictions (null where a feature is null), a column batch at a time."""
    schema = StructType([*df.schema.fields, StructField(output, DoubleType())])

    def run(batches):
        for b in batches:
            n = b.num_columns - 1
            x = b.column(n)
            null = x.is_null().to_numpy(zero_copy_only=False)
            flat = x.fill_null([0.0] * len(features)).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(features))
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(model.predict(flat), mask=null)], schema=None, names=[*b.schema.names[:n], output])

    array = F.array(*[F.col(c).cast("double") for c in features])
    whole = F.when(~F.exists(array, lambda v: v.isNull()), array)
    return df.withColumn("__features", whole).mapInArrow(run, schema)


# ---------------------------------------------------------------- leaf paths and attributions


@dataclass
class LeafPaths:
    """All leaves: their values, and up to ``depth`` conditions (feature, above, up to) each; unused ones always hold."""

    value: np.ndarray  # leaves
    feature: np.ndarray  # leaves x depth
    above: np.ndarray
    upto: np.ndarray
    used: np.ndarray  # bits of the conditions in use
    twig: np.ndarray  # number of the subtree of (up to) four leaves that a leaf belongs to

    def holds(self, x: np.ndarray) -> np.ndarray:
        """Bits of the conditions of every leaf that a row meets."""
        v = x[self.feature]
        return (((v > self.above) & (v <= self.upto)) << np.arange(self.feature.shape[1])).sum(axis=1).astype(np.uint8)


def leaf_paths(model: BoostedTrees) -> LeafPaths:
    """Leaves that rows can reach; conditions of one feature on a path are one interval."""
    depth, inner = model.depth, model.feature.shape[1] if len(model.value) else 0
    value, paths, twig = [], [], []
    for tree, (f, t, v) in enumerate(zip(model.feature.tolist(), model.threshold.tolist(), model.value.tolist())):
        todo = [(0, {})]
        while todo:
            node, held = todo.pop()
            if node >= inner:
                value.append(v[node - inner])
                twig.append((tree << depth) + (node - inner >> 2))
                paths.append([(k, a, b) for k, (a, b) in sorted(held.items())])
                continue
            if math.isinf(t[node]):
                todo.append((2 * node + 1, held))
                continue
            a, b = held.get(f[node], (-math.inf, math.inf))
            for child, low, high in ((2 * node + 1, a, min(b, t[node])), (2 * node + 2, max(a, t[node]), b)):
                if low < high:
                    todo.append((child, {**held, f[node]: (low, high)}))
    n = len(value)
    feature, above, upto = np.zeros((n, depth), np.int64), np.full((n, depth), -np.inf), np.full((n, depth), np.inf)
    used = np.zeros(n, np.uint8)
    for i, path in enumerate(paths):
        for k, (f, a, b) in enumerate(path):
            feature[i, k], above[i, k], upto[i, k] = f, a, b
        used[i] = (1 << len(path)) - 1
    return LeafPaths(np.array(value), feature, above, upto, used, np.array(twig, np.int64))


def path_rows(paths: LeafPaths) -> list[tuple]:
    """(leaf, feature, above, up_to, value) of every condition: the paths as a table."""
    return [(i, int(paths.feature[i, k]), float(paths.above[i, k]), float(paths.upto[i, k]), float(paths.value[i]))
            for i in range(len(paths.value)) for k in range(paths.feature.shape[1]) if paths.used[i] >> k & 1]


def _shares(depth: int) -> np.ndarray:
    """share[a, b, k]: what condition k gets of a leaf's value, when the row alone meets the conditions in the bits of
    ``a`` and the background alone those of ``b``: a coalition reaches the leaf if it has all of a and none of b."""
    size = 1 << depth
    out = np.zeros((size, size, depth))
    fact = [math.factorial(i) for i in range(2 * depth + 1)]
    for a in range(size):
        for b in range(size):
            if a & b:
                continue
            m, n = a.bit_count(), b.bit_count()
            for k in range(depth):
                if a >> k & 1:
                    out[a, b, k] = fact[m - 1] * fact[n] / fact[m + n]
                elif b >> k & 1:
                    out[a, b, k] = -fact[m] * fact[n - 1] / fact[m + n]
    return out


class Attributor:
    """Exact Shapley values of rows against background rows, four leaves at a time for a batch of rows.

    What the leaves of a twig give to features depends on a row only by the outcomes of the
    few tests (feature above a threshold) on their paths: a table by outcomes serves all rows."""

    ROWS = 512  # whose impacts stay in the processor's cache
    TWIGS = 64  # whose tables are held at once

    def __init__(self, paths: LeafPaths, background: np.ndarray, n_features: int) -> None:
        self.paths, self.n = paths, n_features
        self.held = np.stack([paths.holds(z) for z in background]) & paths.used  # background x leaves
        share = _shares(paths.feature.shape[1])
        # by number of conditions: condition x own bits x held bits; a condition that neither meets keeps every coalition out
        self.shares = []
        for n in range(paths.feature.shape[1] + 1):
            own, held = np.meshgrid(np.arange(1 << n), np.arange(1 << n), indexing="ij")
            self.shares.append(np.where((own | held) == (1 << n) - 1, share[own & ~held, held & ~own].transpose(2, 0, 1)[:n], 0.0))
        order = np.argsort(paths.twig, kind="stable")
        self.twigs = [t for t in np.split(order, np.flatnonzero(np.diff(paths.twig[order])) + 1) if len(t)]

    def _table(self, leaves: np.ndarray) -> tuple[list, dict[int, np.ndarray]]:
        """The tests of the leaves, and by feature the impacts: outcomes of the tests (as bits) x background."""
        p = self.paths
        paths = [[(int(p.feature[leaf, k]), float(p.above[leaf, k]), float(p.upto[leaf, k])) for k in range(int(p.used[leaf]).bit_count())] for leaf in leaves]
        tests = sorted({(f, t) for path in paths for f, above, upto in path for t in (above, upto) if not math.isinf(t)})
        outcomes = np.arange(1 << len(tests))
        bit = {t: (outcomes >> i) & 1 for i, t in enumerate(tests)}
        bit |= {(f, -math.inf): 1 for f in range(self.n)} | {(f, math.inf): 0 for f in range(self.n)}
        table: dict[int, np.ndarray] = {}
        for leaf, path in zip(leaves, paths):
            if not path:
                continue
            own = np.zeros(len(outcomes), np.int64)
            for k, (f, above, upto) in enumerate(path):
                own |= (bit[f, above] & (1 - bit[f, upto])) << k
            for (f, _, _), impact in zip(path, self.shares[len(path)].take(self.held[:, leaf], axis=2).take(own, axis=1) * p.value[leaf]):
                if f in table:
                    table[f] += impact
                else:
                    table[f] = impact
        return tests, table

    def batch(self, x: np.ndarray) -> np.ndarray:
        """features x rows x background: impacts; a row's over the features sum to its prediction less the background row's."""
        columns = np.ascontiguousarray(x.T)
        out = np.zeros((self.n, len(x), len(self.held)))
        above: dict[tuple, np.ndarray] = {}
        for begin in range(0, len(self.twigs), self.TWIGS):
            ready = []
            for leaves in self.twigs[begin : begin + self.TWIGS]:
                tests, table = self._table(leaves)
                outcome = np.zeros(len(x), np.int64)
                for i, (f, t) in enumerate(tests):
                    if (f, t) not in above:
                        if len(above) >= 1024:
                            above.clear()
                        above[f, t] = columns[f] > t
                    outcome += above[f, t].astype(np.int64) << i
                ready.append((outcome, table))
            for a in range(0, len(x), self.ROWS):
                here = slice(a, a + self.ROWS)
                for outcome, table in ready:
                    own = outcome[here]
                    for f, impact in table.items():
                        out[f, here] += impact.take(own, axis=0)
        return out

    def impacts(self, x: np.ndarray) -> np.ndarray:
        """background x features: impacts of one row."""
        return self.batch(x[None])[:, 0].T


def attribute(model: BoostedTrees, rows: DataFrame, key: str, features: list[str], background: list[list[float]]) -> DataFrame:
    """(key, feature, impact, std_error): exact impacts of each row's features on its prediction against the mean of the
    background rows; the error is that of the mean over the background rows."""
    paths = leaf_paths(model)
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        worker = Attributor(paths, np.array(background, float), len(features))
        m = len(background)
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(features))
            impact, error = [], []
            for a in range(0, b.num_rows, 10_000):
                each = worker.batch(flat[a : a + 10_000])
                impact.append(each.mean(axis=2).T.ravel())
                error.append((each.std(axis=2, ddof=1) / m**0.5 if m > 1 else np.zeros(each.shape[:2])).T.ravel())
            if impact:
                at = np.repeat(np.arange(b.num_rows), len(features))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(features * b.num_rows), pa.array(np.concatenate(impact)), pa.array(np.concatenate(error))],
                                                 [key, "feature", "impact", "std_error"])

    array = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    return rows.select(key, array.alias("features")).mapInArrow(run, f"{key} {kind}, feature string, impact double, std_error double")
