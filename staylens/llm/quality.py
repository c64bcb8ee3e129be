"""Quality rules from tokeniser fertility, beside plain counting rules.

Base counts per text: words, their code points, symbols, repeated lines, and
words inside 8-word windows that the text has twice or more. The method then
encodes the text with a public vocabulary and measures

* characters per token (a vocabulary fits language it knows with long pieces;
  noise, base64 or an unknown script falls apart into short ones),
* the share of byte-fallback tokens,
* the entropy of the text's token distribution in bits (low for loops).

A text is rejected when a measure leaves the band of its language or, where the
language is unknown or has no band, of its main script. Short texts say little
about a distribution, so entropy counts from ``MIN_TOKENS`` tokens on.

One pass over the documents, no shuffle. Null or empty text: all counts 0, no
measures (null), rejected by the base rule. Repeated rows are each answered.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm import encode, words

WINDOW = 8
MIN_WORDS = 20
MOST_REPEATED = 30  # per cent
MIN_TOKENS = 64
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_NOT_CHAR = ~words.NOT_BLANK
_NOT_CHAR[0x80:0xC0] = True  # continuation bytes belong to the code point before


@dataclass(frozen=True)
class Band:
    """Accepted measures: characters per token, byte-fallback share, entropy in bits."""

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float


#: By language (as labelled), then by script.
LANGUAGES = {
    "en": Band(1.3, 8.0, 0.10, 2.5),
    "de": Band(1.3, 8.0, 0.10, 2.5),
    "fr": Band(1.3, 8.0, 0.15, 2.5),
    "es": Band(1.3, 8.0, 0.15, 2.5),
}
SCRIPTS = {
    "latin": Band(1.2, 9.0, 0.20, 2.5),
    "greek": Band(0.6, 6.0, 0.60, 2.5),
    "cyrillic": Band(0.8, 8.0, 0.40, 2.5),
    "other": Band(0.25, 9.0, 0.98, 2.0),
}

_OUT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "kept boolean, n_tokens long, chars_per_token double, byte_share double, token_entropy double, band string")


def script_of(text: str) -> str:
    """The script of most letters by lead byte: Latin (ASCII and U+00C0 to U+024F), Greek, Cyrillic or another."""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = np.bincount(raw, minlength=256)
    counts = {
        "latin": int(n[0x41:0x5B].sum() + n[0x61:0x7B].sum() + n[0xC3:0xCA].sum()),
        "greek": int(n[0xCD:0xD0].sum()),
        "cyrillic": int(n[0xD0:0xD4].sum()),
        "other": int(n[0xD4:0xF8].sum()),
    }
    return max(counts, key=counts.get) if any(counts.values()) else "latin"


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def repeated_words(window_hashes: np.ndarray, n: int = WINDOW) -> int:
    """Words covered by windows that occur twice or more among these."""
    m = len(window_hashes)
    if m < 2:
        return 0
    order = np.argsort(window_hashes)
    same = np.diff(window_hashes[order]) == 0
    if not same.any():
        return 0
    twice = np.zeros(m, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    cover = np.zeros(m + n, np.int64)
    at = np.flatnonzero(twice)
    cover[at] += 1
    np.add.at(cover, at + n, -1)
    return int((np.cumsum(cover) > 0).sum())


def entropy(ids: np.ndarray) -> float:
    """Bits of the distribution of these ids."""
    if not len(ids):
        return 0.0
    s = np.sort(ids)
    borders = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
    p = np.diff(borders) / len(ids)
    return float(max(0.0, -(p * np.log2(p)).sum()))


def _measure(path: str, languages: dict[str, Band], scripts: dict[str, Band]):
    def run(batches):
        model = encode.kept(encode.Pieces, path)
        for batch in batches:
            for texts in words.slices(batch.column(1)):
                found = words.scan(texts)
                n_words = found.counts
                chars = np.diff(texts.offsets) - words.count_at(np.flatnonzero(_NOT_CHAR[texts.data]), texts.offsets)
                symbols = words.count_at(np.flatnonzero(_SYMBOL[texts.data]), texts.offsets)
                h = words.hashes(texts.data, found.starts, found.ends)
                grams = words.windows(h, WINDOW)
                plain = [texts.bytes_of(i).decode() for i in range(len(texts))]
                ids, borders = model.encode(texts, found, words.distinct(h))
                n_tokens = np.diff(borders)
                n_bytes = words.count_at(np.flatnonzero(model.is_byte[ids]), borders)
                out = {k: [] for k in ("dup", "rep", "failed", "kept", "cpt", "share", "bits", "band")}
                langs = batch.column(2).slice(texts.rows.start, len(texts)).to_pylist()
                for i, text in enumerate(plain):
                    n, tokens = int(n_words[i]), int(n_tokens[i])
                    a = found.first[i]
                    rep = repeated_words(grams[a : a + max(0, n - WINDOW + 1)])
                    failed = n < MIN_WORDS or 100 * rep > MOST_REPEATED * n
                    lang = langs[i]
                    name = lang if lang in languages else script_of(text)
                    band = languages.get(name) or scripts[name]
                    cpt = share = bits = None
                    fits = True
                    if n and tokens:
                        cpt, share = int(chars[i]) / tokens, int(n_bytes[i]) / tokens
                        bits = entropy(ids[borders[i] : borders[i + 1]])
                        fits = band.least_chars <= cpt <= band.most_chars and share <= band.most_bytes
                        fits = fits and (tokens < MIN_TOKENS or bits >= band.least_entropy)
                    for k, v in zip(out, (repeated_lines(text) if n else 0, rep, failed, not failed and fits, cpt, share, bits, name)):
                        out[k].append(v)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(texts.rows.start, len(texts)), pa.array(n_words), pa.array(chars), pa.array(symbols),
                     pa.array(out["dup"], pa.int64()), pa.array(out["rep"], pa.int64()), pa.array(out["failed"], pa.bool_()), pa.array(out["kept"], pa.bool_()),
                     pa.array(n_tokens), pa.array(out["cpt"], pa.float64()), pa.array(out["share"], pa.float64()), pa.array(out["bits"], pa.float64()), pa.array(out["band"], pa.string())],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_tokens", "chars_per_token", "byte_share", "token_entropy", "band"])

    return run


def quality(docs: DataFrame, tokenizer: str | None = None, languages: dict[str, Band] | None = None, scripts: dict[str, Band] | None = None) -> DataFrame:
    """Counts, measures and verdict of every row of ``docs`` (doc_id, text, lang if there)."""
    path = tokenizer or encode.tokenizer_path("piece_bpe_32k.model")
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), lang.alias("lang"))
    return rows.mapInArrow(_measure(path, LANGUAGES if languages is None else languages, SCRIPTS if scripts is None else scripts), _OUT)


def _filter(path: str, schema: pa.Schema | None = None):
    measure = _measure(path, LANGUAGES, SCRIPTS)

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            lang = batch.column(names.index("lang")) if "lang" in names else pa.nulls(len(batch), pa.string())
            rows = pa.RecordBatch.from_arrays([batch.column(names.index("doc_id")), batch.column(names.index("text")), lang], ["doc_id", "text", "lang"])
            got = pa.Table.from_batches(list(measure([rows])) or [], schema=None) if len(batch) else None
            if got is not None:
                yield batch.filter(got.column("kept").combine_chunks())

    return run


def keep_good(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, in one pass."""
    path = tokenizer or encode.tokenizer_path("piece_bpe_32k.model")
    return docs.mapInArrow(_filter(path), docs.schema)
