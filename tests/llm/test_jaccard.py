import os
import random
import re

import numpy as np
import pytest

from staylens.llm import jaccard
from tests.llm.fixtures import answers, by_key, documents, frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets(rows, n):
    out = []
    for i, t, *_ in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append((i, frozenset(tuple(w[a : a + n]) for a in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])))
    return out


def brute(rows, n, percent):
    listed = sets(rows, n)
    parent = list(range(len(listed)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(listed)):
        for b in range(a):
            x, y = listed[a][1], listed[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(listed):
        if i is not None:
            least[root(a)] = min(least.get(root(a), i), i)
    return [(i, len(s), least.get(root(a)) if s else i) for a, (i, s) in enumerate(listed)]


def rows():
    r = random.Random(4)
    own = documents()
    base = prose(31, 160, 900).split(" ")
    for i in range(60):  # a chain and a cloud of near copies
        w = list(base)
        for _ in range(r.randint(1, 4)):
            w[r.randrange(len(w))] = f"edit{r.randint(0, 30)}"
        own.append((1000 + i, " ".join(w), "en", "s", 1))
    step = list(base[:100])
    for i in range(40):
        step[i * 2] = f"s{i}"
        own.append((1100 + i, " ".join(step), "en", "s", 1))
    common = prose(32, 30, 300)  # a passage that many documents share
    own += [(1200 + i, prose(600 + i, r.choice([8, 30, 200]), 3000) + " " + common, "en", "s", 1) for i in range(40)]
    return own + [(-3, "A b C", "en", "s", 1), (None, own[3][1], "en", "s", 1)]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80), (1, 50), (3, 100)])
def test_matches_brute_force(spark, n, percent, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 16)  # buckets in several chunks
    monkeypatch.setattr(jaccard, "CELL", 10)  # and pairs in several cells
    got = answers(jaccard.similar_groups(frame(spark, rows(), clash=True), n, percent), "doc_id", "n_shingles", "component_id")
    assert got == by_key(brute(rows(), n, percent))


def test_trees_lose_no_pair():
    r = np.random.default_rng(2)
    base = r.integers(0, 1 << 63, 4000).astype(np.uint64)
    items = []
    for _ in range(150):
        a, n = int(r.integers(0, 3000)), int(r.choice([3, 40, 64, 65, 200, 600]))
        items.append(np.unique(np.concatenate([base[a - a % 50 : a - a % 50 + n], r.integers(0, 1 << 63, n // 12).astype(np.uint64)])))
    n = np.array([len(s) for s in items])
    bits = [jaccard.bitmaps(s, 80) for s in items]
    a, b = jaccard.forest_pairs(n, np.arange(len(items)), bits, np.zeros(len(items), int), 80)
    got = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
    assert len(got) == len(a)
    want = {(i, j) for j in range(len(items)) for i in range(j) if jaccard.allowed(len(np.intersect1d(items[i], items[j])), len(items[i]), len(items[j]), 80)}
    assert want and want <= got and len(got) < 0.2 * len(items) ** 2 / 2
    ok = jaccard.close_enough([bits[i] for i, _ in want], [bits[j] for _, j in want], np.array([n[i] for i, _ in want]), np.array([n[j] for _, j in want]), 80)
    assert ok.all()


@pytest.mark.parametrize("percent, sizes", [(80, (148, 149)), (80, (292, 293)), (80, (580, 581)), (90, (313, 314)), (90, (617, 618)), (90, (1225, 1226))])
def test_trees_of_two_widths_lose_no_pair(percent, sizes):
    assert jaccard.width_of(sizes[0], percent) < jaccard.width_of(sizes[1], percent)
    r = np.random.default_rng(sizes[0])
    base = r.integers(0, 1 << 63, sizes[1]).astype(np.uint64)
    items = [np.unique(base[: sizes[k % 2]]) for k in range(2)]
    for k in range(40):  # similar sets on both sides of the size where bitmaps get wider
        s = base[: sizes[k % 2]].copy()
        s[r.choice(len(s), 1 + k % 4, replace=False)] = r.integers(0, 1 << 63, 1 + k % 4).astype(np.uint64)
        items.append(np.unique(s))
    n = np.array([len(s) for s in items])
    a, b = jaccard.forest_pairs(n, np.arange(len(items)), [jaccard.bitmaps(s, percent) for s in items], np.zeros(len(items), int), percent)
    got = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
    want = {(i, j) for j in range(len(items)) for i in range(j) if jaccard.allowed(len(np.intersect1d(items[i], items[j])), len(items[i]), len(items[j]), percent)}
    assert {n[i] != n[j] for i, j in want} == {True, False} and want <= got


def test_components_of_long_chains(spark):
    r = random.Random(0)
    ids = list(range(500))
    r.shuffle(ids)
    links = [(ids[i], ids[i + 1]) for i in range(499) if i % 100 != 99] + [(-7, -7)]
    got = {x["sid"]: x["comp"] for x in jaccard.components(spark.createDataFrame(links, "a long, b long")).collect()}
    for i in range(0, 500, 100):
        part = ids[i : i + 100]
        assert {got[x] for x in part} == {min(part)}


def test_one_of_each(spark):
    df = frame(spark, rows(), clash=True)
    out = jaccard.one_of_each(df)
    assert out.columns == df.columns
    want = {i for i, _, c in brute(rows(), 5, 80) if i == c}
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == want
    assert jaccard.one_of_each(frame(spark, [])).count() == 0


def shuffle_files(spark):
    """Shuffle files of this local session (its block folders lie in spark.local.dir)."""
    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in top for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}


def test_steps_leave_no_shuffle_files(spark):
    docs = frame(spark, rows()[:60])
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old, before = spark.conf.get(key, None), shuffle_files(spark)
    jaccard.similar_groups(docs, 5, 80)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(key, None) == old
