import re

import corpus_pipeline
from staylens.llm import lines, quality
from tests.conftest import SF_SMALL
from tests.llm import test_jaccard, test_lines, test_packing
from tests.llm.fixtures import documents, frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def without_windows(rows, k=20):
    """Texts without later copies of k-word windows (rows have distinct, non-null ids)."""
    first, out = {}, []
    for i, t, *_ in sorted(rows):
        w = WORD.findall(t or "")
        for a in range(len(w) - k + 1):
            first.setdefault(tuple(w[a : a + k]), (i, a))
    for i, t, *rest in rows:
        w = WORD.findall(t or "")
        gone = {a + j for a in range(len(w) - k + 1) if first[tuple(w[a : a + k])] != (i, a) for j in range(k)}
        out.append((i, " ".join(x for j, x in enumerate(w) if j not in gone) if gone else t, *rest))
    return out


def test_stages_match_brute_force(spark):
    """Each stage on what the one before kept, against plain versions of the same rules."""
    rows = [r for r in documents(n=80)[:-2] if r[0] is not None and r[1] is not None]
    for i in range(6):  # near copies on one line, which line dedup leaves alone
        w = prose(50 + i // 3, 90, 3000).replace("\n", " ").split(" ")
        w[10 + i] = f"edit{i}"
        rows.append((700 + i, " ".join(w), "en", "s", 1))
    df = frame(spark, rows)
    kept = {r["doc_id"] for r in quality.quality(df).collect() if r["kept"]}
    rows = [r for r in rows if r[0] in kept]
    after = {i: t for i, t, _, _ in test_lines.brute(rows)}
    rows = [(r[0], after[r[0]], *r[2:]) for r in rows]
    stay = {i for i, _, c in test_jaccard.brute(rows, 5, 80) if i == c}
    rows = without_windows([r for r in rows if r[0] in stay])
    assert len(rows) <= len(kept) - 4 and len(kept) < 80
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = spark.createDataFrame(stage(spark, df, "").collect(), df.schema)
    assert sorted((r["doc_id"], r["text"]) for r in df.collect()) == sorted(r[:2] for r in rows)
    assert lines.SPAN == 2
    from pyspark.sql import functions as F

    packed = corpus_pipeline.STAGES[-1][1](spark, df, "").withColumn("crc", F.crc32("ids")).collect()
    test_packing.check(rows, packed, 2048)


def test_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "substrings", "packing"]
    df = frame(spark, documents())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df2 = stage(spark, df, "")
        assert df2.columns == df.columns
        rows = df2.collect()
        df = spark.createDataFrame(rows, df.schema)
    assert rows
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, df, "").collect()} == {r["doc_id"] for r in rows}


def test_run_and_empty(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.count() > 0 and "sequence_id" in out.columns
    df = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df, "").count() == 0
