import random
import re
import zlib
from collections import Counter

import numpy as np
from staylens.llm import queries, variants, words
from tests.llm.fixtures import documents, frame

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_vocabulary(rows, least=3):
    n = Counter()
    for i, t, *_ in rows:
        for run in RUN.findall(t or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= least}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows, least=3):
    n = brute_vocabulary(rows, least)
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(out)


def dense(seed, n=900):
    """Many near words, repeated letters and counts that chain."""
    r = random.Random(seed)
    out = []
    for i in range(60):
        ws = []
        for _ in range(n // 15):
            w = "".join(r.choice("abé") for _ in range(r.choice([4, 5, 5, 6, 6, 7, 8])))
            ws += [w if r.random() < 0.8 else w.upper()] * r.choice([1, 1, 2, 3])
        out.append((i, " ".join(ws), "en", "s", 1))
    return out


def got(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def test_dense_vocabulary(spark):
    rows = dense(3)
    want = brute(rows)
    assert len(want) > 500 and max(w[4] for w in want) > 8 and len({w[2] for w in want if w[1] and w[2] != w[1]}) > 3
    assert got(variants.variants(frame(spark, rows, clash=True))) == want


def test_query(spark, tmp_path):
    rows = documents() + [(700, "zz" * 3000 + " " + "zz" * 3000 + "z " + "zz" * 3000, "en", "s", 1)] * 4 + [(None, "colour color " * 9, "en", "s", 1)]
    frame(spark, rows, clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    assert got(queries.QUERIES["op12_variants"](spark, str(tmp_path))) == brute(rows)
    assert variants.variants(frame(spark, [])).count() == 0
    assert variants.variants(frame(spark, [(1, None, "en", "s", 1), (2, "ab 12", "en", "s", 1)])).count() == 0


def test_runs_and_checksums():
    texts = ["Aé÷ ñandú×Straße ﬁ x", "ÀÿĀa", "", "end"]
    t = words.of(texts)
    w = variants.runs(t)
    got_ = [[t.data[a:b].tobytes().decode() for a, b in zip(w.starts[i:j], w.ends[i:j])] for i, j in zip(w.first[:-1], w.first[1:])]
    assert got_ == [RUN.findall(x) for x in texts]
    r = random.Random(2)
    parts = [(bytes(r.randrange(256) for _ in range(r.randint(1, 30))), bytes(r.randrange(256) for _ in range(r.randint(1, 64)))) for _ in range(500)]
    h = variants.Checksums().joined(np.array([zlib.crc32(a) for a, _ in parts], np.uint32), np.array([zlib.crc32(b) for _, b in parts], np.uint32), np.array([len(b) for _, b in parts]))
    assert h.tolist() == [zlib.crc32(a + b) for a, b in parts]


def test_composition_accepts_each_pair_once():
    r = random.Random(7)
    for _ in range(60):
        ws = sorted({"".join(r.choice("abc") for _ in range(r.choice([5, 6]))) for _ in range(r.choice([3, 40, 150]))})
        pairs = Counter()
        for side, cut in (("p", lambda w: (w[:2], w[2:])), ("s", lambda w: (w[-3:], w[: len(w) - 3][::-1]))):
            groups = {}
            for w in ws:
                k, rest = cut(w)
                groups.setdefault(k, []).append((rest, w))
            for g in groups.values():
                g.sort()
                a, b = variants.near_pairs(side, 5, [x for x, _ in g], [x for _, x in g])
                pairs.update(tuple(sorted((g[i][1], g[j][1]))) for i, j in zip(a, b))
        want = {(a, b) for a in ws for b in ws if a < b and one_edit(a, b) and min(len(a), len(b)) == 5}
        assert pairs == Counter(want)
