import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from staylens.llm import encode, packing, words
from tests.llm.fixtures import documents, frame


def check(rows, got, window):
    """Every id in exactly one piece, sequences gapless and within the window."""
    model = Tokenizer.from_file(encode.tokenizer_path("word_bpe_49k.json"))
    want = {}
    for r in rows:
        ids = np.array(model.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        want.setdefault(r[0], []).append(ids)
    pieces, seqs = {}, {}
    for p in got:
        ids = np.frombuffer(bytes(p["ids"]), "<u4")
        assert len(ids) == p["length"] and zlib.crc32(ids.tobytes()) == p["crc"]
        pieces.setdefault(p["doc_id"], []).append((p["start"], p["doc_tokens"], ids))
        seqs.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert set(pieces) == set(want)
    for k, texts in want.items():
        assert all(n == len(texts[0]) for _, n, _ in pieces[k]) or len({len(t) for t in texts}) > 1
        held = sorted(pieces[k], key=lambda p: p[0])
        copies = len(texts)
        for t in {t.tobytes(): t for t in texts}.values():  # every place of the text as often as the row is there
            covered = np.zeros(len(t), int)
            for start, _, ids in held:
                assert (t[start : start + len(ids)] == ids).all()
                covered[start : start + len(ids)] += 1
            assert (covered == copies).all()
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    assert set(seqs) == set(range(len(seqs)))
    return sum(p["length"] for p in got) / (window * max(1, len(seqs)))


@pytest.mark.parametrize("window", [64, 2048])
def test_pieces(spark, window):
    rows = documents()
    out = packing.pack(frame(spark, rows, clash=True), window=window, unit=4 if window == 64 else 16).withColumn("crc", F.crc32("ids"))
    fill = check(rows, out.collect(), window)
    assert fill > 0.9


def test_empty_table(spark):
    assert packing.pack(frame(spark, [])).count() == 0


def test_nnls_against_projected_gradient():
    r = np.random.default_rng(3)
    a, b = r.random((12, 30)), r.random(12)
    x = packing.nnls(a, b)
    y, step = np.zeros(30), 1 / np.linalg.norm(a, 2) ** 2
    for _ in range(20000):
        y = np.maximum(0, y - step * a.T @ (a @ y - b))
    assert (x >= 0).all() and np.linalg.norm(a @ x - b) <= np.linalg.norm(a @ y - b) + 1e-6


@pytest.mark.parametrize("kind", ["even", "short", "hot", "one"])
def test_plan_uses_every_rest_once(kind):
    r = random.Random(1)
    lengths = {"even": [r.randint(1, 2048) for _ in range(20000)], "short": [r.randint(1, 300) for _ in range(20000)],
               "hot": [700] * 7000 + [r.randint(1, 2047) for _ in range(14000)], "one": [5]}[kind]
    histogram = {}
    for x in lengths:
        histogram[x] = histogram.get(x, 0) + 1
    plan = packing.make_plan(histogram)
    used = np.zeros(3 * sum(lengths) + 4096, int)
    for length, n in histogram.items():
        at = plan.place(np.full(n, length), np.arange(n))
        for a in at.tolist():
            used[a : a + length] += 1
    assert used.max() == 1 and used.sum() == sum(lengths)
    last = -(-(int(np.flatnonzero(used)[-1]) + 1) // 2048)
    grid = used[: last * 2048].reshape(last, 2048)
    fill = grid.sum(axis=1)
    assert (fill > 0).all() and ((np.diff(grid, axis=1) > 0).sum() == 0) and (grid[:, 0] == 1).all()  # gapless from 0
    if kind != "one":
        assert sum(lengths) / (2048 * last) > 0.98


def test_chunked_encoding_equals_whole_text():
    model = encode.WordBpe(encode.tokenizer_path("word_bpe_49k.json"), most=50)
    texts = [r[1] or "" for r in documents()] + ["Don't STOP!! it's 'twas ÀÉß—x <|endoftext|> a<|startoftext|>b", "é ́x İstanbul ΣΑΣ", "tab\tsep  double", "...---...", "'s 't s' x's"]
    whole = Tokenizer.from_file(encode.tokenizer_path("word_bpe_49k.json"))
    for _ in range(2):
        for i in range(0, len(texts), 7):
            ids, borders = model.encode(words.of(texts[i : i + 7]))
            for j, t in enumerate(texts[i : i + 7]):
                assert ids[borders[j] : borders[j + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids, t
