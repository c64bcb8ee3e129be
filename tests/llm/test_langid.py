import zlib

from pyspark.sql import functions as F

from staylens.llm import langid
from tests.conftest import SF_MID
from tests.llm.fixtures import documents, frame


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    held = langid.held_out(4, 2)
    out = langid.identify(docs, langid.learn(docs.where(~held))).join(docs.select("doc_id", "lang"), "doc_id").select("*", held.alias("held")).collect()
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    test = [r for r in out if r["held"] and r["lang_pred"] != "und"]
    assert len(test) > 100 and sum(r["lang_pred"] == r["lang"] for r in test) > 0.97 * len(test)
    assert all(0 <= r["score"] <= 1 for r in out)


def model():
    return langid.fit({"en": {"the": 50, "house": 5, "thing": 7}, "de": {"das": 40, "haus": 6, "ding": 5}})


def test_backoff_goes_from_words_to_shorter_grams():
    m = model()
    assert m.rows_of("the") == [m.words["the"]]
    four = m.rows_of("housed")
    assert four and set(four) <= set(m.grams[4].values())
    assert set(m.rows_of("xinx")) <= set(m.grams[2].values()) | set(m.grams[3].values()) and m.rows_of("xinx")
    assert set(m.rows_of("xdx")) <= set(m.grams[1].values()) and m.rows_of("xdx")


def test_edges(spark):
    rows = documents()
    out = {r["doc_id"]: r for r in langid.identify(frame(spark, rows, clash=True), model()).collect()}
    for i, t, *_ in rows:
        letters = any(c.isalpha() for c in t or "")
        assert (out[i]["lang_pred"] == "und") == (not letters), t
        assert (out[i]["score"] == 0) == (not letters)
    assert langid.identify(frame(spark, []), model()).count() == 0
    nothing = langid.learn(frame(spark, rows).where("lang = 'xx'"))
    assert {r["lang_pred"] for r in langid.identify(frame(spark, rows), nothing).collect()} == {"und"}
    assert langid.identify(frame(spark, rows[:1]).withColumn("lang", F.lit(None).cast("string")), model()).count() == 1


def test_slices_do_not_change_answers(spark):
    rows = [r for r in documents() if r[1]]
    whole = langid.Scores(model(), most=3)
    each = langid.Scores(model())
    for _, t, *_ in rows[:30]:
        p, n = whole.places([t])
        q, k = each.places([t])
        assert (abs(whole.score[p].sum(axis=0) - each.score[q].sum(axis=0)) < 1e-2).all()


def test_rare_languages_are_learned_whole(spark):
    letters = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    rows = [(i if i % 3 else None, f"hot{letters(i)}", "en", "s", 1) for i in range(3000)] + [(5000 + i, f"zeldzaam{letters(i)}", "nl", "s", 1) for i in range(5)]
    m = langid.learn(frame(spark, rows), most_rows=300)
    assert m.langs == ["en", "nl"] and sum(w.startswith("zeldzaam") for w in m.words) == 5
    assert 200 < sum(w.startswith("hot") for w in m.words) < 400  # rows without an id are sampled as well
