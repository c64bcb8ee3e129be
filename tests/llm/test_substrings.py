import hashlib
import random
import re

import numpy as np
import pytest

from staylens.llm import substrings, words
from tests.llm.fixtures import answers, by_key, documents, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k):
    key = lambda i: (i is not None, i or 0)
    first, listed = {}, []
    for i, t, *_ in rows:
        w = WORD.findall(t or "")
        listed.append((i, w))
        for a in range(len(w) - k + 1):
            g = tuple(w[a : a + k])
            first[g] = min(first.get(g, (key(i), a)), (key(i), a))
    out = []
    for i, w in listed:
        gone = set()
        for a in range(len(w) - k + 1):
            if first[tuple(w[a : a + k])] != (key(i), a):
                gone |= set(range(a, a + k))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def rows():
    r = random.Random(9)
    own = documents()
    few = [f"w{i}" for i in range(6)]
    own += [(300 + i, " ".join(r.choice(few) for _ in range(r.randint(1, 60))), "en", "s", 1) for i in range(20)]  # many ties of short windows
    own += [(400 + i, own[1][1], "en", "s", 1) for i in range(40)]  # a group of copies
    own += [(None, own[1][1], "en", "s", 1), (None, None, "en", "s", 1), (-5, own[2][1], "en", "s", 1), (7, own[2][1], "en", "s", 1)]
    return own + [(450, "tail " + "same word again " * 400, "en", "s", 1)]


@pytest.mark.parametrize("window", [1, 2, 3, 8, 20])
def test_matches_brute_force(spark, window):
    out = substrings.dedup_substrings(frame(spark, rows(), clash=True, parts=4), window=window, buckets=5)
    got = [tuple(r) for r in out.select("doc.doc_id", "n_words", "n_removed", "kept_sha256").collect()]
    assert by_key(got) == by_key(brute(rows(), window))


def test_small_flushes_and_groups(spark, monkeypatch):
    want = by_key(brute(rows(), 6))
    sent, count = substrings._send, substrings._count

    def small(f):
        def outer(*a):
            def run(batches):
                substrings.FLUSH_BYTES, substrings.MANY_WINDOWS, substrings.MOST_MARKS = 500, 50, 3
                yield from f(*a)(batches)

            return run

        return outer

    monkeypatch.setattr(substrings, "_send", small(sent))
    monkeypatch.setattr(substrings, "_count", small(count))
    out = substrings.dedup_substrings(frame(spark, rows(), parts=4), window=6, buckets=7)
    assert by_key([tuple(r) for r in out.select("doc.doc_id", "n_words", "n_removed", "kept_sha256").collect()]) == want


def test_runs_share_a_minimiser():
    texts = words.of([" ".join(f"{i * 7 % 13}" for i in range(90)), "a b c", "", " ".join("xyz"[i % 3] for i in range(700))])
    found = words.scan(texts)
    h = words.hashes(texts.data, found.starts, found.ends)
    at, low = substrings.minimisers(h, found.first, 20, 3)
    grams = words.windows(h, 3)
    assert [int(x) for x in low] == [int(grams[a : a + 18].min()) for a in at]
    begin, end = substrings.runs(at, low, found.first)
    assert (begin[1:] == end[:-1]).all() and begin[0] == 0 and end[-1] == len(at) and (end - begin).max() <= substrings.MOST_RUN
    for a, b in zip(begin, end):
        assert len(set(low[a:b].tolist())) == 1 and (np.diff(at[a:b]) == 1).all()


def test_columns_stay(spark):
    df = frame(spark, rows(), clash=True)
    out = substrings.drop_repeated(df)
    assert out.columns == df.columns and out.count() == df.count()
    assert substrings.drop_repeated(frame(spark, [])).count() == 0
    same = answers(out.where("doc_id = 60"), "text")
    assert same == [("",)]
