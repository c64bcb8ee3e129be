"""N-gram Jaccard join with signature trees.

Documents are sets of distinct word shingles (64-bit hashes). Equal sets are one
node from the start. Two nodes can only reach the similarity if they share one
of their first ``n - ceil(t n) + 1`` shingles in an order that all sets use
(by hash, with shingles that are frequent in a sample last: the sample only
decides the order, and any order gives the same links). A shingle's bucket holds
the nodes that have it among these.

1. In every bucket one node, the one whose shingles are shared most, is compared
   with all others. Groups of near copies, whatever their size, become connected
   by as many comparisons as they have members, and buckets with a single
   component are done.
2. In the other buckets, signature trees find the remaining pairs: a leaf holds
   a set's token bitmap and size, an inner node the OR of its children's bitmaps
   and their size range. A pair of nodes is followed only if the largest overlap
   that these allow reaches the similarity, and only between different
   components. Pairs of leaves are held against a second bitmap, in which each
   token flips its bit: two sets differ in at least as many tokens as these
   bitmaps in bits. Buckets of up to ``LEAF`` nodes are a single leaf; buckets
   above ``CHUNK`` nodes are split into pairs of chunks, each a piece of work of
   its own.
3. Pairs that pass are decided exactly on their whole shingle sets. Pairs are
   dealt to the cells of a grid, so that a set travels to a row and a column of
   cells at most, not once for each of its pairs.

Links become components by smallest neighbour with pointer jumping. Documents
without words have an empty set and no links. Rows are answered one by one:
repeated rows have equal sets and so share a component.

Node ids are 64-bit hashes of whole sets; two different sets share one with
probability n^2 / 2^65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm import words
from staylens.llm.words import U
from staylens.session import freed_shuffles, shared_path

SAMPLE = 12  # one in so many documents
MOST_FREQUENT = 1_000_000
LEAF = 8
CHUNK = 2_048
MANY_ROWS = 40_000
CELL = 4_096
MOST_SENT = 500_000
_SETS = "doc_id long, sid long, n int, token long, bits binary"


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingles(texts: words.Texts, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; all words as one shingle if there are fewer."""
    found = words.scan(texts)
    h = words.hashes(texts.data, found.starts, found.ends)
    grams = words.windows(h, n)
    out = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if b - a >= n:
            s = np.sort(grams[a : b - n + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        else:
            out.append(words.windows(h[a:b], b - a) ^ U(b - a) if b > a else np.zeros(0, U))
    return out


def width_of(n: int, percent: int) -> int:
    """Bits of a set's bitmaps: a power of two from four times the differences that the
    similarity allows, 128 at least (fewer bits hide differences, more tell little)."""
    return max(128, 1 << (4 * (2 * n * (100 - percent) // (100 + percent)) - 1).bit_length())


def bitmaps(s: np.ndarray, percent: int) -> bytes:
    """Two bitmaps of a set: half as many bits as ``width_of``, set where a token falls,
    and twice as many as ``width_of``, flipped by each token that falls there.

    The flipped ones decide whether a pair is made: with eight bits or more for each
    allowed difference few pairs just below the similarity look like links."""
    w = width_of(len(s), percent)
    counts = np.bincount((s & U(2 * w - 1)).astype(np.int64), minlength=2 * w)
    half = counts.reshape(4, w // 2).sum(axis=0) > 0
    return np.packbits(np.concatenate([half, counts % 2 > 0]), bitorder="little").tobytes()


def split_bitmaps(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The two bitmaps of rows of one width, as 64-bit words."""
    whole = np.frombuffer(b"".join(rows), "<u8").reshape(len(rows), -1)
    cut = whole.shape[1] // 5
    return whole[:, :cut], whole[:, cut:]


def fold(bits: np.ndarray, words_: int, op=np.bitwise_or) -> np.ndarray:
    """Bitmaps (rows) folded to fewer 64-bit words."""
    while bits.shape[1] > words_:
        half = bits.shape[1] // 2
        bits = op(bits[:, :half], bits[:, half:])
    return bits


def need(n: int, percent: int) -> int:
    """Smallest overlap of a set of this size with any set similar to it."""
    return -(-percent * n // 100)


def allowed(overlap, a, b, percent: int):
    """Whether an overlap of sets of sizes a and b reaches the similarity: 100 i >= percent (a + b - i)."""
    return (100 + percent) * overlap >= percent * (a + b)


def few_differences(differ, a, b, percent: int):
    """The same condition on the number of tokens that only one of the sets has."""
    return (100 + percent) * differ <= (100 - percent) * (a + b)


def _emit(n: int, percent: int, frequent) -> object:
    def run(batches):
        late = frequent.value
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for texts in words.slices(batch.column(1), lower=True, most=1 << 20):
                out = [[], [], [], [], []]
                tokens, owners, sizes = [], [], []
                for i, s in enumerate(shingles(texts, n)):
                    sid = signed(xxhash.xxh3_64_intdigest(s.tobytes()))
                    fresh = len(s) and sid not in seen
                    for column, x in zip(out, (ids[texts.rows.start + i], sid, len(s), None, bitmaps(s, percent) if fresh else None)):
                        column.append(x)
                    if not fresh:
                        continue
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(sid)
                    size = len(s) - need(len(s), percent) + 1
                    if len(late):
                        common = late[np.minimum(np.searchsorted(late, s), len(late) - 1)] == s
                        head = s[~common][:size]
                        head = np.concatenate([head, s[common][: size - len(head)]]) if len(head) < size else head
                    else:
                        head = s[:size]
                    tokens.append(head)
                    owners.append(sid)
                    sizes.append(len(s))
                if ids:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))], ["doc_id", "sid", "n", "token", "bits"])
                if tokens:
                    lens = [len(t) for t in tokens]
                    flat = np.concatenate(tokens).view(np.int64)
                    m = len(flat)
                    yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.array(np.repeat(np.array(owners, np.int64), lens)), pa.array(np.repeat(np.array(sizes, np.int32), lens)), pa.array(flat), pa.nulls(m, pa.binary())],
                                                     ["doc_id", "sid", "n", "token", "bits"])

    return run


def _frequent(rows: DataFrame, n: int) -> np.ndarray:
    """The most frequent shingles among those that documents of a sample share, sorted.

    They come last in the order of shingles. MOST_FREQUENT bounds what is sent to
    the tasks; which shingles are in it changes how much is compared, never the links.
    """
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)

    def each(batches):
        for batch in batches:
            for texts in words.slices(batch.column(1), lower=True, most=1 << 20):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingles(texts, n) or [np.zeros(0, U)]).view(np.int64))], ["token"])

    counts = sample.mapInArrow(words.tidy(each), "token long").groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    where = shared_path(rows.sparkSession, "frequent")
    counts.write.parquet(where)
    counts = rows.sparkSession.read.schema("token long, n long").parquet(where)
    least, left = 2, MOST_FREQUENT
    for r in counts.groupBy("n").agg(F.count("*").alias("tokens")).orderBy(F.desc("n")).collect():
        left -= r["tokens"]
        if left < 0:
            least = r["n"] + 1
            break
    top = counts.where(F.col("n") >= least).select("token").toPandas()
    return np.sort(top["token"].to_numpy(np.int64).view(U))


# ---- candidates


def close_enough(bits_a: list[bytes], bits_b: list[bytes], na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs may reach the similarity by their sizes and flipped bits."""
    out = allowed(np.minimum(na, nb), na, nb, percent)
    la, lb = np.fromiter(map(len, bits_a), np.int64, len(bits_a)), np.fromiter(map(len, bits_b), np.int64, len(bits_b))
    for x, y in {(x, y) for x, y in zip(la[out].tolist(), lb[out].tolist())}:
        every = np.flatnonzero(out & (la == x) & (lb == y))
        step = max(1, (4 << 20) // (x + y))
        for i in range(0, len(every), step):
            rows = every[i : i + step]
            a, b = split_bitmaps([bits_a[j] for j in rows])[1], split_bitmaps([bits_b[j] for j in rows])[1]
            w = min(a.shape[1], b.shape[1])
            differ = np.bitwise_count(fold(a, w, np.bitwise_xor) ^ fold(b, w, np.bitwise_xor)).sum(axis=1, dtype=np.int64)
            out[rows] = few_differences(differ, na[rows], nb[rows], percent)
    return out


class Tree:
    """Levels of nodes over sets of one bitmap width, leaves sorted by size."""

    def __init__(self, n: np.ndarray, comp: np.ndarray, bits: np.ndarray, flips: np.ndarray, at: np.ndarray) -> None:
        order = np.argsort(n, kind="stable")
        n, comp, bits = n[order], comp[order], bits[order]
        self.at, self.flips = at[order], flips[order]
        level = {"bits": bits, "least": n, "most": n, "low": comp, "high": comp}
        self.levels = [level]
        while len(level["least"]) > 1:
            cut = np.arange(0, len(level["least"]), LEAF)
            level = {k: op.reduceat(level[k], cut, axis=0) for k, op in (("bits", np.bitwise_or), ("least", np.minimum), ("most", np.maximum), ("low", np.minimum), ("high", np.maximum))}
            self.levels.append(level)

    def folded(self, words_: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Bitmaps of every level at this width, and the most tokens of a set beyond its distinct bits there."""
        bits = [fold(x["bits"], words_) for x in self.levels]
        spare = [self.levels[0]["most"] - np.bitwise_count(bits[0]).sum(axis=1, dtype=np.int64)]
        while len(spare) < len(bits):
            spare.append(np.maximum.reduceat(spare[-1], np.arange(0, len(spare[-1]), LEAF)))
        return bits, spare


def tree_pairs(x: Tree, y: Tree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaf pairs that sizes, bitmaps and components allow (each once, if both are one tree)."""
    same = x is y
    width = min(x.levels[0]["bits"].shape[1], y.levels[0]["bits"].shape[1])
    (bx, sx), (by, sy) = x.folded(width), y.folded(width)
    width = min(x.flips.shape[1], y.flips.shape[1])
    fx, fy = fold(x.flips, width, np.bitwise_xor), fold(y.flips, width, np.bitwise_xor)
    i, j = len(x.levels) - 1, len(y.levels) - 1
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    found = [[], []]
    stack = [(i, j, a, b)]
    while stack:
        i, j, a, b = stack.pop()
        if len(a) > 1 << 16:  # bounded memory: the halves one after the other
            h = len(a) // 2
            stack += [(i, j, a[:h], b[:h]), (i, j, a[h:], b[h:])]
            continue
        lx, ly = x.levels[i], y.levels[j]
        ok = (lx["low"][a] != ly["high"][b]) | (lx["high"][a] != ly["low"][b])  # one component on both sides otherwise
        ok &= allowed(np.minimum(lx["most"][a], ly["most"][b]), lx["least"][a], ly["least"][b], percent)
        ok &= (lx["least"][a] * percent <= 100 * ly["most"][b]) & (ly["least"][b] * percent <= 100 * lx["most"][a])
        if same and i == j:
            ok &= (a < b) if i == 0 else (a <= b)
        a, b = a[ok], b[ok]
        if not len(a):
            continue
        if i == 0 and j == 0:
            differ = np.bitwise_count(fx[a] ^ fy[b]).sum(axis=1, dtype=np.int64)
            keep = few_differences(differ, lx["least"][a], ly["least"][b], percent)
            found[0].append(x.at[a[keep]])
            found[1].append(y.at[b[keep]])
            continue
        common = np.bitwise_count(bx[i][a] & by[j][b]).sum(axis=1, dtype=np.int64)
        most = np.minimum(np.minimum(common + sx[i][a], lx["most"][a]), np.minimum(common + sy[j][b], ly["most"][b]))
        keep = allowed(most, lx["least"][a], ly["least"][b], percent)
        a, b = a[keep], b[keep]
        down_x, down_y = i > 0 and i >= j, j > 0 and j >= i
        if down_x:
            a, b = np.repeat(a * LEAF, LEAF) + np.tile(np.arange(LEAF), len(a)), np.repeat(b, LEAF)
            inside = a < len(x.levels[i - 1]["least"])
            a, b = a[inside], b[inside]
        if down_y:
            a, b = np.repeat(a, LEAF), np.repeat(b * LEAF, LEAF) + np.tile(np.arange(LEAF), len(b))
            inside = b < len(y.levels[j - 1]["least"])
            a, b = a[inside], b[inside]
        if len(a):
            stack.append((i - down_x, j - down_y, a, b))
    return (np.concatenate(found[0]), np.concatenate(found[1])) if found[0] else (np.zeros(0, np.int64),) * 2


def forest_pairs(n: np.ndarray, comp: np.ndarray, bits: list[bytes], side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one bucket's rows; where ``side`` has two values, only pairs between these."""
    lens = np.fromiter(map(len, bits), np.int64, len(bits))
    trees = {}
    for s in np.unique(side):
        for w in np.unique(lens[side == s]):
            at = np.flatnonzero((side == s) & (lens == w))
            trees[int(s), int(w)] = Tree(n[at].astype(np.int64), comp[at], *split_bitmaps([bits[i] for i in at]), at)
    two = len(np.unique(side)) > 1
    out = [[], []]
    keys = sorted(trees)
    for i, p in enumerate(keys):
        for q in keys[i:]:
            if two and p[0] == q[0]:
                continue
            a, b = tree_pairs(trees[p], trees[q], percent)
            out[0].append(a)
            out[1].append(b)
    return (np.concatenate(out[0]), np.concatenate(out[1])) if out[0] else (np.zeros(0, np.int64),) * 2


_PAIR = "a long, b long"


def _small_pairs(group: np.ndarray, last: np.ndarray, own: np.ndarray, mixed: np.ndarray, comp: np.ndarray, n: np.ndarray, percent: int):
    """Pairs within buckets that are one leaf, all such buckets at once (rows lie bucket by bucket)."""
    out = [[], []]
    at = np.arange(len(group))
    for step in range(1, LEAF):
        a = at[at + step <= last]
        if not len(a):
            break
        b = a + step
        ok = (comp[a] != comp[b]) & allowed(np.minimum(n[a], n[b]), n[a], n[b], percent) & (~mixed[a] | (own[a] != own[b]))
        out[0].append(a[ok])
        out[1].append(b[ok])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def _tree_task(percent: int):
    """Whole buckets (rows sorted by token, i, j), many at a time."""

    def work(batches: list[pa.RecordBatch]) -> np.ndarray:
        table = pa.Table.from_batches(batches).combine_chunks()
        token, i, j, sid, comp, n, own = (table.column(k).to_numpy().astype(np.int64) for k in (0, 1, 2, 3, 4, 5, 7))
        bits = table.column(6).to_pylist()
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(token)))
        group = np.cumsum(new) - 1
        small = size[group] <= LEAF
        last = np.where(small, (begin + size - 1)[group], -1)
        a, b = _small_pairs(group, last, own, i != j, comp, n, percent)
        # a pair of similar sets meets in many buckets: look at it once
        pairs = _unique(np.minimum(sid[a], sid[b]), np.maximum(sid[a], sid[b]), np.where(sid[a] < sid[b], a, b), np.where(sid[a] < sid[b], b, a))
        a, b = pairs
        ok = close_enough([bits[x] for x in a], [bits[x] for x in b], n[a], n[b], percent)
        out = [np.stack([sid[a[ok]], sid[b[ok]]])]
        for g in np.flatnonzero(size > LEAF).tolist():
            rows = np.arange(begin[g], begin[g] + size[g])
            if (comp[rows] == comp[rows[0]]).all():
                continue
            side = own[rows] if i[rows[0]] != j[rows[0]] else np.zeros(len(rows), np.int64)
            x, y = forest_pairs(n[rows], comp[rows], [bits[r] for r in rows], side, percent)
            x, y = sid[rows[x]], sid[rows[y]]
            if len(x):
                out.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))
        return np.concatenate(out, axis=1)

    def run(batches):
        held, rows, key = [], 0, None
        for batch in batches:
            if not len(batch):
                continue
            if rows >= MANY_ROWS:  # cut where a bucket ends
                k = [batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1, 2)]
                differs = np.flatnonzero((k[0] != key[0]) | (k[1] != key[1]) | (k[2] != key[2]))
                cut = int(differs[0]) if len(differs) else len(batch)
                held.append(batch.slice(0, cut))
                rows += cut
                batch = batch.slice(cut)
                if not len(batch):
                    continue
                yield from _pairs([work(held)])
                held, rows = [], 0
            held.append(batch)
            rows += len(batch)
            key = tuple(batch.column(c)[len(batch) - 1].as_py() for c in (0, 1, 2))
        if held:
            yield from _pairs([work(held)])

    return run


def _unique(a: np.ndarray, b: np.ndarray, *what: np.ndarray) -> tuple[np.ndarray, ...]:
    """``what`` of the first of each distinct (a, b)."""
    order = np.lexsort((b, a))
    first = np.ones(len(a), bool)
    first[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
    return tuple(x[order[first]] for x in what)


def _pairs(parts: list[np.ndarray]):
    whole = np.concatenate(parts, axis=1)
    a, b = _unique(whole[0], whole[1], whole[0], whole[1])
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _near(percent: int):
    """Keep the pairs that bitmaps allow; columns a, b, na, nb, bits_a, bits_b."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            na, nb = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
            ok = close_enough(batch.column(4).to_pylist(), batch.column(5).to_pylist(), na, nb, percent)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], ["a", "b"])

    return run


def _decide(percent: int):
    """Keep the pairs whose sets reach the similarity, in one cell of the grid."""

    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        place = {sid: k for k, sid in enumerate(sets.column("sid").to_pylist())}
        items = [np.frombuffer(x.as_buffer(), U) for x in sets.column("items")]
        ok = []
        for x, y in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
            s, t = items[place[x]], items[place[y]]
            if len(s) > len(t):
                s, t = t, s
            at = np.minimum(np.searchsorted(t, s), len(t) - 1)
            ok.append(bool(allowed(int((t[at] == s).sum()), len(s), len(t), percent)))
        return pairs.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


# ---- components


def components(links: DataFrame) -> DataFrame:
    """(sid, comp): the smallest node that each linked node reaches.

    Every round takes the smallest label among the neighbours and then that
    label's own label, so labels travel doubling distances; each round's table
    is written, and the loop ends when no label changes.
    """
    spark = links.sparkSession
    path = shared_path(spark, "links")
    links.select(F.col("a").alias("x"), F.col("b").alias("y")).union(links.select("b", "a")).distinct().write.parquet(path)
    edges = spark.read.schema("x long, y long").parquet(path)
    where = shared_path(spark, "labels")
    edges.groupBy(F.col("x").alias("sid")).agg(F.least(F.min("y"), F.first("x")).alias("comp")).write.parquet(where)
    while True:
        labels = spark.read.schema("sid long, comp long").parquet(where)
        around = edges.join(labels.select(F.col("sid").alias("y"), "comp"), "y").groupBy(F.col("x").alias("sid")).agg(F.min("comp").alias("near"))
        step = labels.join(around, "sid").select("sid", "comp", F.least("comp", "near").alias("to"))
        jump = labels.select(F.col("sid").alias("to"), F.col("comp").alias("far"))
        new = step.join(jump, "to").select("sid", F.least("to", "far").alias("new"), "comp")
        where = shared_path(spark, "labels")
        new.select("sid", F.col("new").alias("comp"), (F.col("new") != F.col("comp")).alias("moved")).write.parquet(where)
        if spark.read.schema("sid long, comp long, moved boolean").parquet(where).where("moved").isEmpty():
            return spark.read.schema("sid long, comp long").parquet(where)


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets reach the similarity, as a written table."""
    spark = docs.sparkSession
    path = shared_path(spark, "pairs")
    pairs.write.parquet(path)
    pairs = spark.read.schema(_PAIR).parquet(path)
    wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct().join(nodes, "sid").select(F.col("rep").alias("doc_id"), "sid")
    if wanted.count() <= MOST_SENT:
        wanted = F.broadcast(wanted)

    def sets(batches):
        for batch in batches:
            sids = batch.column(2).to_pylist()
            for texts in words.slices(batch.column(1), lower=True, most=1 << 20):
                rows = [(sids[texts.rows.start + i], s.tobytes()) for i, s in enumerate(shingles(texts, n)) if signed(xxhash.xxh3_64_intdigest(s.tobytes())) == sids[texts.rows.start + i]]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["sid", "items"])

    found = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"])).select(docs["doc_id"], docs["text"], wanted["sid"]).mapInArrow(words.tidy(sets), "sid long, items binary")
    where = shared_path(spark, "sets")
    found.dropDuplicates(["sid"]).write.parquet(where)
    found = spark.read.schema("sid long, items binary").parquet(where)
    # a grid of cells, each with at most about CELL nodes a side
    side = max(1, -(-found.count() // CELL))
    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(side)).cast("int")
    dealt = pairs.select("a", "b", cell("a").alias("i"), cell("b").alias("j"))
    ends = F.explode(F.array("a", "b")).alias("sid")
    wanted = pairs.select(cell("a").alias("row"), cell("b").alias("column"), ends).distinct().join(found, "sid")
    links = shared_path(spark, "linked")
    dealt.groupBy("i", "j").cogroup(wanted.groupBy("row", "column")).applyInArrow(_decide(percent), _PAIR).write.parquet(links)
    return spark.read.schema(_PAIR).parquet(links)


def similar_groups(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    Rows are linked when 100 * intersection >= percent * union of their shingle
    sets; a component's id is the smallest doc_id that links reach.
    """
    with freed_shuffles(docs.sparkSession):
        return _groups(docs, shingle, percent)


def _groups(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    late = spark.sparkContext.broadcast(_frequent(rows, shingle))
    where = shared_path(spark, "shingles")
    rows.mapInArrow(words.tidy(_emit(shingle, percent, late)), _SETS).write.parquet(where)
    every = spark.read.schema(_SETS).parquet(where)
    texts = every.where(F.col("token").isNull()).select("doc_id", "sid", "n")
    nodes = texts.where(F.col("n") > 0).groupBy("sid").agg(F.min("doc_id").alias("rep"))
    bits = every.where(F.col("bits").isNotNull()).select("sid", "n", "bits").groupBy("sid").agg(F.max("n").alias("n"), F.first("bits").alias("bits"))
    keys = every.where(F.col("token").isNotNull()).select("token", "sid", "n")

    # buckets of two nodes or more; of two, only if their sizes can be similar
    # (most tokens are alone: sums by token would move as much as the rows do, and the rows once more for the join)
    bucket = Window.partitionBy("token")
    size = (F.min("sid").over(bucket).alias("lo"), F.max("sid").over(bucket).alias("hi"), F.min("n").over(bucket).alias("least"), F.max("n").over(bucket).alias("most"), F.count("*").over(bucket).alias("c"))
    buckets = keys.select("token", "sid", "n", *size).where((F.col("lo") != F.col("hi")) & ((F.col("c") > 2) | (100 * F.col("least") >= percent * F.col("most"))))
    held = shared_path(spark, "held")
    buckets.select("token", "sid", "n", "c").write.parquet(held)
    members = spark.read.schema("token long, sid long, n int, c long").parquet(held)

    # 1. the node of every bucket whose shingles are shared most against the others
    central = members.groupBy("sid").agg((F.sum(F.least("c", F.lit(1 << 40))) / F.max("n")).alias("shared"))
    ranked = members.select("token", "sid", "n").join(central, "sid")
    leads = ranked.groupBy("token").agg(F.max(F.struct("shared", "sid")).alias("best")).select("token", F.col("best.sid").alias("lead"))
    stars = members.select("token", "sid", "n").join(leads, "token").where(F.col("sid") != F.col("lead"))
    stars = stars.groupBy(F.least("lead", "sid").alias("a"), F.greatest("lead", "sid").alias("b")).agg(F.count("*").alias("buckets")).select("a", "b")
    stars = stars.join(bits.select(F.col("sid").alias("a"), F.col("n").alias("na")), "a").join(bits.select(F.col("sid").alias("b"), F.col("n").alias("nb")), "b")
    stars = stars.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    stars = stars.join(bits.select(F.col("sid").alias("a"), F.col("bits").alias("bits_a")), "a").join(bits.select(F.col("sid").alias("b"), F.col("bits").alias("bits_b")), "b")
    stars = stars.select("a", "b", "na", "nb", "bits_a", "bits_b")
    links = _verified(rows, nodes, stars.mapInArrow(words.tidy(_near(percent)), _PAIR), shingle, percent)
    label = components(links)

    # 2. signature trees in the buckets that still hold several components
    known = members.select("token", "sid").distinct().join(label, "sid", "left").select("token", "sid", F.coalesce("comp", "sid").alias("comp"))
    open_ = known.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c"))
    open_ = open_.where(F.col("lo") != F.col("hi"))
    open_ = open_.select("token", F.ceil(F.col("c") / CHUNK).cast("int").alias("parts"))
    chunk = F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")
    rest = known.join(open_, "token").join(bits, "sid").withColumn("own", chunk)
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rest = rest.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "sid", "comp", "n", "bits", "own")
    dealt = rest.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    more = dealt.mapInArrow(words.tidy(_tree_task(percent)), _PAIR).distinct()
    more = _verified(rows, nodes, more, shingle, percent)
    label = components(links.union(more))

    # the smallest document of each component
    comp = nodes.join(label, "sid", "left").select("sid", "rep", F.coalesce("comp", "sid").alias("comp"))
    least = comp.groupBy("comp").agg(F.min("rep").alias("component_id"))
    of = comp.join(least, "comp").select("sid", "component_id")
    return texts.join(of, "sid", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, with all columns.

    Rows that repeat a doc_id count as one document and stay together.
    """
    stay = similar_groups(docs, shingle, percent).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_stay")).distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"))
    return rows.join(stay, F.col("d.doc_id").eqNullSafe(F.col("_stay")), "left_semi").select(*(F.col(f"d.`{c}`").alias(c) for c in docs.columns))
