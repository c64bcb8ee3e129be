import re

from staylens.llm import quality
from tests.llm.fixtures import answers, by_key, documents, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def test_counts_match_brute_force(spark):
    rows = documents()
    got = answers(quality.quality(frame(spark, rows, clash=True)), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == by_key([(r[0], *brute(r[1])) for r in rows])


def test_verdict(spark):
    rows = documents()
    out = {r["doc_id"]: r for r in quality.quality(frame(spark, rows)).collect()}
    assert all(not r["kept"] for r in out.values() if r["base_failed"])
    noise = (900, " ".join("ᚠᚡᚢ"[i % 3] * (3 + i * i % 11) + str(i) for i in range(40)), "en", "s", 1)
    r = quality.quality(frame(spark, [noise])).collect()[0]
    assert not r["base_failed"] and not r["kept"] and r["byte_share"] > 0.5
    kept = {r["doc_id"] for r in quality.keep_good(frame(spark, rows, clash=True)).collect()}
    assert kept == {i for i, r in out.items() if r["kept"]}
    assert any(out[i]["kept"] for i in range(60))


def test_empty_table(spark):
    assert quality.quality(frame(spark, [])).count() == 0
    assert quality.keep_good(frame(spark, [])).count() == 0


def test_script():
    assert [quality.script_of(x) for x in ("abc é", "αβγ", "где", "漢字", "", "123")] == ["latin", "greek", "cyrillic", "other", "latin", "latin"]
