import hashlib
import random

import numpy as np
import pytest
import tiktoken

from staylens.llm import bytebpe, encode, pretokens, queries, words
from tests.llm.fixtures import documents, frame

PATH = encode.tokenizer_path("byte_bpe_50k.tiktoken")
EDGES = ["", " ", "\n", "'", "''", "'s", " 's", "x's't", "'ll'll", "it'lla 're'rest", "a  b", "a \n b", "\t'd", "tail  ", "<|endoftext|>", "\x85\xa0a　b",
         "\x1c\x1d x", "²³½ 12x3", "ǅ漢字 \U0001F600‍\U0001F600", "Ünï çödé", "z" * 3000, "ab" * 2000, "\n" * 500, "?!" * 700, " " * 200 + "x"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def model():
    return bytebpe.ByteBpe(PATH, pretokens.class_ranges())


def ids_of(model, texts):
    ids, borders = model.encode_slice(words.of(texts))
    return [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])]


def test_random_texts_as_the_library(model, library):
    r = random.Random(4)
    parts = list("aest'rvlmd  \n\t!?.19é漢\x85\x1c²ǅ") + ["'s", "'re", "'ll", "'ve", "  ", " '", "ing", " the", "\U0001F600"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 50))) for _ in range(4000)] + EDGES
    assert ids_of(model, texts) == [library.encode_ordinary(t) for t in texts]
    assert ids_of(model, texts[::-1]) == [library.encode_ordinary(t) for t in texts[::-1]]  # from the table


def test_every_codepoint(model, library):
    text = "".join(f"a{chr(c)}1 " for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    assert ids_of(model, [text]) == [library.encode_ordinary(text)]


def test_scan_is_the_automaton():
    starts, to, *_ = pretokens.automaton()
    r = np.random.default_rng(1)
    for n in (1, 127, 128, 129, 5000):
        cls = r.integers(0, 2 * pretokens.N_CLASSES, n).astype(np.uint8)
        state, want = pretokens.FRESH, []
        for c in cls:
            want.append(bool(starts[state, c]))
            state = int(to[state, c])
        assert pretokens.start_flags(cls).tolist() == want


def test_small_table_changes_nothing(model, library):
    small = bytebpe.ByteBpe(PATH, pretokens.class_ranges(), most=3)
    for t in EDGES:
        assert ids_of(small, [t, t + " end"]) == [library.encode_ordinary(t), library.encode_ordinary(t + " end")]


def test_query(spark, library, tmp_path):
    rows = documents() + [(500 + i, t, "en", "s", 1) for i, t in enumerate(EDGES)] + [(900, "a wörd, " * 40000, "en", "s", 1)]
    frame(spark, rows, clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries.QUERIES["op13_bytebpe"](spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, t, *_ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_decoding_by_offsets(spark):
    rows = documents()
    encoded = bytebpe.encode_texts(frame(spark, rows))
    back = bytebpe.decode_texts(encoded)
    assert sorted((r["doc_id"] or -1, bytes(r["decoded"]).decode()) for r in back.collect()) == sorted((r[0] or -1, r[1] or "") for r in rows)
    one = encoded.where("doc_id = 1").first()
    begins = np.frombuffer(bytes(one["offsets"]), "<u4")
    assert begins[0] == 0 and len(begins) == one["n_tokens"] and (np.diff(begins.astype(int)) > 0).all()
    assert bytebpe.decode_texts(bytebpe.encode_texts(frame(spark, []))).count() == 0
