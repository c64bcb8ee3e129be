import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from staylens.llm import alignment, encode, queries
from tests.llm.fixtures import documents, frame

A, B = encode.tokenizer_path("byte_bpe_50k.json"), encode.tokenizer_path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
EXTRA = ["<|endoftext|> <s> </s> <0x0A>", "a  b   c ", "\n\n x \t", "mark ▁ here", " ", "\n", "it's we're 'll", "漢字　かな\xa0x", "\x00 nul", "e.g. x,y;z(w)[q]{k}", "tail \n ", "ＡＢ ﬁ é"]


def spans(lens):
    ends = np.cumsum(lens).tolist()
    return list(zip([0, *ends[:-1]], ends))


def brute(texts):
    """Each text on its own, with the libraries; then counts over all."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    name_a = {i: alignment._decoded(t) for t, i in a.get_vocab().items() if t != "<|endoftext|>"}

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    out, linked = [], []
    for t in texts:
        ia, ib = ([], []) if not t else (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t))
        ra, rb = [name_a[i] for i in ia], [bytes_b(i) for i in ib]
        if not t or b"".join(ra) != (" " + t).encode() or b"".join(rb) != (" " + t).encode():
            out.append((0, 0, 0, ""))
            linked.append([])
            continue
        sa, sb = spans(list(map(len, ra))), spans(list(map(len, rb)))
        linked.append([(x, y) for x, (p, q) in zip(ia, sa) for y, (r, s) in zip(ib, sb) if p < s and r < q])
        common = sorted({q for _, q in sa} & {q for _, q in sb})
        groups = []
        for lo, hi in zip([0, *common], common):
            groups.append(",".join(str(x) for x, (_, q) in zip(ia, sa) if lo < q <= hi) + "|" + ",".join(str(x) for x, (_, q) in zip(ib, sb) if lo < q <= hi))
        out.append((len(ia), len(ib), len(common), ";".join(groups)))
    count = Counter(p for x in linked for p in x)
    best = defaultdict(int)
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return [(na, nb, ng, len(x), sum(count[p] == best[p[1]] for p in x), sum(count[p] for p in x), hashlib.sha256(g.encode()).hexdigest() if g else "")
            for (na, nb, ng, g), x in zip(out, linked)]


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def rows():
    kept = [r for r in documents(n=30) if r[1] is None or len(r[1]) < 6000]
    return kept + [(800 + i, t, "en", "s", 1) for i, t in enumerate(EXTRA)] + [(None, "no id here", "en", "s", 1)]


def test_query(spark, tmp_path):
    frame(spark, rows(), clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(((r[0], *x) for r, x in zip(rows(), brute([r[1] for r in rows()]))), key=str)
    assert got(queries.QUERIES["op11_alignment"](spark, str(tmp_path))) == want
    assert sum(w[4] == 0 for w in want) >= 3  # null, empty, a mark that is no space


def test_many_small_blocks_and_a_hot_token(spark):
    """A third of all rows are one text; blocks of a few documents and few or many partitions give the same counts."""
    r = random.Random(5)
    texts = [" ".join(r.choice(["thing", "things", "re-done", "naïve", "x"]) for _ in range(r.randint(1, 9))) for _ in range(120)] + ["the the the"] * 60
    docs = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    want = sorted(((i, *x) for i, x in enumerate(brute(texts))), key=str)
    for bits, block in ((6, 40), (9, 1000), (6, 1 << 20)):
        assert got(alignment.align(frame(spark, docs, parts=5), bits=bits, block_bytes=block)) == want
    assert alignment.align(frame(spark, [])).count() == 0
    kept = alignment.align(frame(spark, docs[:3]), keep_groups=True).collect()
    assert all(hashlib.sha256(x["groups"].encode()).hexdigest() == x["groups_sha256"] for x in kept)


def test_merge_counts_exactly(monkeypatch):
    """Runs of many frames, one B id across frames and runs, against a dictionary."""
    monkeypatch.setattr(alignment, "FRAME", 7)
    r = np.random.default_rng(3)
    for trial in range(40):
        raw = []
        for _ in range(r.integers(1, 9)):
            keys = np.unique((r.integers(0, 4, 200) << 16 | r.integers(0, 60, 200)).astype(np.uint32))[: r.integers(1, 90)]
            raw.append((keys, r.integers(1, 50, len(keys)).astype(np.uint64)))
        count = Counter()
        for keys, totals in raw:
            for k, n in zip(keys.tolist(), totals.tolist()):
                count[k] += n
        best = defaultdict(int)
        for k, n in count.items():
            best[k >> 16] = max(best[k >> 16], n)
        runs = [alignment.Run(alignment._frames(k, n)) for k, n in raw]
        alignment.merge(runs)
        for (keys, _), run in zip(raw, runs):
            assert np.concatenate(run.back).tolist() == [count[k] << 1 | (count[k] == best[k >> 16]) for k in keys.tolist()]


def test_packed_arrays():
    r = np.random.default_rng(1)
    for kind in (np.uint16, np.uint32, np.uint64):
        for n in (0, 1, 1000):
            x = r.integers(0, 1 << 15, n).astype(kind)
            assert alignment.unpack(alignment.pack(x), kind).tolist() == x.tolist()
    parts = [b"", b"abc", b"x" * 1000]
    assert alignment.split(alignment.join(parts)) == parts and alignment.split(alignment.join([])) == []
    key = alignment.radix(np.array([5 << 16 | 9, 4 << 16 | 1, 68 << 16 | 2], np.uint32), 6)
    assert (key >> 26).tolist() == [5, 4, 4] and key[1] < key[2]


def test_cuts_are_where_both_end():
    """Chunks encoded alone give what the whole text gives."""
    model = alignment.Aligner(A, B, most=50)
    r = random.Random(8)
    parts = list("aestc'rv  \n\t!?.,1é漢\x85\x1c　\xa0(\r") + ["'s", " the", "ing"]
    for _ in range(20):
        texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(60)]
        spaced = alignment._spaced(alignment.words.of(texts))
        found = model.cut(spaced)
        place = model.places(spaced, found)
        for i, t in enumerate(texts):
            own = [model.groups[p].decode() for p in place[found.first[i] : found.first[i + 1]]]
            ids = [x.replace("|", ";").split(";") for x in own]
            flat_a = [int(x) for g in own for part in g.split(";") for x in part.split("|")[0].split(",") if g]
            assert flat_a == (model.a.encode(" " + t, add_special_tokens=False).ids if t else []), ids
    assert pa.types.is_string(alignment.DOC.field("groups").type)
