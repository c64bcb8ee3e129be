import numpy as np

from staylens.llm import encode, viterbi
from tests.llm.fixtures import answers, by_key, documents, frame

EXTRA = ["a  b   c ", " lead", "literal ▁ mark ▁▁", "emoji 😀 \x00 nul", "\n\n x \t", "¿Qué? ñandú", " "]


def rows():
    return documents() + [(1000 + i, t, "en", "s", 1) for i, t in enumerate(EXTRA)]


def plain(model, word):
    """Viterbi of one marked word, alone."""
    best, back = [0.0], [(0, -1)]
    for i in range(1, len(word) + 1):
        top = (best[i - 1] + model.lost, 0, (i - 1, -1))
        for j in range(i):
            p = model.piece.get(word[j:i])
            if p is not None and (best[j] + p[0], i - j) > top[:2]:
                top = (best[j] + p[0], i - j, (j, p[1]))
        best.append(top[0])
        back.append(top[2])
    ids, i = [], len(word)
    while i:
        j, p = back[i]
        ids = ([p] if p >= 0 else [int(model.byte[b]) for b in word[j:i].replace(viterbi.MARK, " ").encode()]) + ids
        i = j
    return ids


def test_matches_plain_viterbi(spark):
    model = viterbi.Viterbi(encode.tokenizer_path("piece_bpe_32k.model"))
    out = {r["doc_id"]: r for r in viterbi.encode_texts(frame(spark, rows(), clash=True)).collect()}
    for i, t, *_ in rows():
        got = out[i]["ids"]
        if t is None:
            assert got is None
            continue
        ids = np.frombuffer(bytes(got), "<u4").tolist()
        words = list(model.chunks(t)) if len(t) < 4000 else None
        if words is not None:
            assert ids == [x for w in words for x in plain(model, viterbi.MARK + w)]
        assert out[i]["n_ids"] == len(ids) and out[i]["round_trip"]


def test_round_trip(spark):
    back = viterbi.decode_texts(viterbi.encode_texts(frame(spark, rows())))
    assert answers(back, "doc_id", "text") == by_key([r[:2] for r in rows()])
    assert viterbi.encode_texts(frame(spark, [])).count() == 0
    assert viterbi.decode_texts(viterbi.encode_texts(frame(spark, []))).count() == 0


def test_small_table_changes_nothing():
    path = encode.tokenizer_path("piece_bpe_32k.model")
    a, b = viterbi.Viterbi(path), viterbi.Viterbi(path, most=5)
    texts = [r[1] or "" for r in rows()][:40]
    whole, edges = a.encode(texts)
    for i, t in enumerate(texts):
        assert b.encode([t])[0].tolist() == whole[edges[i] : edges[i + 1]].tolist()
