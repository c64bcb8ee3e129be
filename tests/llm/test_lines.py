import random

import numpy as np

from staylens.llm import lines
from tests.llm.fixtures import answers, by_key, documents, frame


def rows():
    r = random.Random(3)
    block = [f"shared line {i} of a notice" for i in range(12)]
    own = documents(n=20)
    for i in range(30):
        body = [f"line {r.random()} here" for _ in range(r.randint(3, 12))]
        at = r.randint(0, len(body))
        own.append((500 + i, "\n".join(body[:at] + block[r.randint(0, 2) :] + body[at:]), "en", "s", 1))
    own.append((600, "\n".join(block * 3), "en", "s", 1))
    own += [(700, "\n".join(block), "en", "s", 1), (None, "\n".join(block), "en", "s", 1)]
    return own


def brute(rows):
    """Chunks by the operator's borders, kept where they stand first."""
    first = {}
    for i, t, *_ in rows:
        order = (i is not None, i or 0)
        for a, n, chunk in lines.chunks((t or "").encode()) if t is not None else []:
            first[chunk] = min(first.get(chunk, (order, a)), (order, a))
    out = []
    for i, t, *_ in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        listed, gone = t.split("\n"), set()
        for a, n, chunk in lines.chunks(t.encode()):
            if first[chunk] != ((i is not None, i or 0), a):
                gone |= set(range(a, a + n))
        out.append((i, "\n".join(x for k, x in enumerate(listed) if k not in gone), len(listed), len(gone)))
    return out


def test_matches_brute_force(spark):
    got = [tuple(r) for r in lines.dedup_lines(frame(spark, rows(), clash=True)).select("doc.doc_id", "kept", "n_lines", "n_removed").collect()]
    assert by_key(got) == by_key(brute(rows()))
    assert sum(r[3] for r in got) > 100


def test_hash_shared_by_two_texts(spark, monkeypatch):
    df = frame(spark, rows()).coalesce(1)
    real = lines._chunk_rows

    def clumsy(with_text, span, average):  # every hash stands for many texts: places must be matched by text
        run = real(with_text, span, average)

        def squeezed(batches):
            import pyarrow as pa

            for b in run(batches):
                h = pa.array(b.column(4).to_numpy() % 3)
                yield pa.RecordBatch.from_arrays([h if i == 4 else c for i, c in enumerate(b.columns)], b.schema.names)

        return squeezed

    monkeypatch.setattr(lines, "_chunk_rows", clumsy)
    got = [tuple(r) for r in lines.dedup_lines(df).select("doc.doc_id", "kept", "n_lines", "n_removed").collect()]
    assert by_key(got) == by_key(brute(rows()))


def test_borders_resist_shifts():
    r = np.random.default_rng(1)
    h = r.integers(0, 1 << 63, 400).astype(np.uint64)
    a = {x for x in lines.borders(h)}
    b = {x - 5 for x in lines.borders(np.concatenate([r.integers(0, 1 << 63, 5).astype(np.uint64), h]))}
    assert len(a & b) > 0.8 * len(a)


def test_columns_stay(spark):
    df = frame(spark, rows(), clash=True)
    out = lines.drop_repeated(df)
    assert out.columns == df.columns and out.count() == df.count()
    assert lines.drop_repeated(frame(spark, [])).count() == 0
    assert answers(out.where("text is null"), "doc_id") == answers(df.where("text is null"), "doc_id")


def test_long_text_with_many_removed_spans(spark):
    block = "\n".join(f"line {i} of a long list" for i in range(60_000))
    mixed = "\n".join(x if i % 9 else f"own {i}" for i, x in enumerate(block.split("\n")))
    own = [(1, block, "en", "s", 1), (2, block, "en", "s", 1), (3, mixed, "en", "s", 1)]
    got = {r["doc_id"]: r for r in lines.dedup_lines(frame(spark, own)).select("doc.doc_id", "kept", "n_removed").collect()}
    for i, kept, _, n in brute(own):
        assert (got[i]["kept"], got[i]["n_removed"]) == (kept, n)
    assert got[1]["n_removed"] == 0 and got[2]["n_removed"] > 59_000 and got[3]["n_removed"] > 10_000
