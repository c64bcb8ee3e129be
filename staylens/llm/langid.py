"""Language identification by word-first backoff.

Known words are scored by their log frequency in each language. A word that was
not seen falls back to its character n-grams, the longest that the model knows
at all, down to single characters. A text's language has the highest sum.

The model is fitted on labelled rows: at most about ``most_rows`` of each
language, picked by a hash of id and text (all, if it has no more), which bounds
it whatever the size of the corpus and leaves no rare language out. It keeps the ``most_words`` most frequent
words of each language and the n-grams of these, and goes to the tasks in the
function. Prediction is one pass over all documents, no shuffle; only the text
is read.

Null text or no letter at all: ``und``, score 0; so is every text when nothing
was learned. Ties go to the language that sorts first. Repeated rows are each
answered (and each learned from).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm import encode, words

UNKNOWN = "und"
MOST_ROWS = 20_000
MOST_WORDS = 30_000
LONGEST = 4
_WORD = regex.compile(r"\p{L}+")
_OUT = "doc_id long, lang_pred string, score double, n_words long"


@dataclass
class Model:
    """Log10 frequencies by word and by n-gram (row of ``table``), one column a language."""

    langs: list[str]
    words: dict[str, int] = field(default_factory=dict)
    grams: list[dict[str, int]] = field(default_factory=lambda: [{} for _ in range(LONGEST + 1)])
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))

    def rows_of(self, word: str) -> list[int]:
        """The table rows whose mean scores a word: its own, or those of its longest known n-grams."""
        if (own := self.words.get(word)) is not None:
            return [own]
        marked = f"^{word}$"
        for n in range(LONGEST, 0, -1):
            known = self.grams[n]
            if got := [r for i in range(len(marked) - n + 1) if (r := known.get(marked[i : i + n])) is not None]:
                return got
        return []


def fit(counts: dict[str, dict[str, int]]) -> Model:
    """A model from word counts by language."""
    model = Model(sorted(counts))
    if not model.langs:
        return model
    columns = []

    def keep(table: dict[str, int], by_lang: list[Counter]) -> None:
        for item in sorted(set().union(*by_lang)):
            table[item] = len(columns)
            columns.append([c[item] for c in by_lang])
        n = len(table)
        if n:
            part = np.array(columns[-n:], np.float64)
            columns[-n:] = np.log10((part + 0.5) / (part.sum(axis=0) + 0.5 * (n + 1))).tolist()

    by_lang = [Counter(counts[x]) for x in model.langs]
    keep(model.words, by_lang)
    for n in range(1, LONGEST + 1):
        grams = [Counter() for _ in by_lang]
        for total, own in zip(grams, by_lang):
            for word, c in own.items():
                marked = f"^{word}$"
                for i in range(len(marked) - n + 1):
                    total[marked[i : i + n]] += c
        keep(model.grams[n], grams)
    model.table = np.array(columns, np.float32)
    return model


class Scores(encode.ChunkTable):
    """Scores of distinct chunks: the sum over their words, and how many words they have."""

    def __init__(self, model: Model, most: int = 250_000) -> None:
        self.model = model
        super().__init__(most)

    def clear(self) -> None:
        super().clear()
        self.score = np.zeros((0, max(1, len(self.model.langs))), np.float32)
        self.n = np.zeros(0, np.int64)

    def add(self, chunks: list[str]) -> None:
        rows, per_word, counts = [], [], []
        for chunk in chunks:
            found = _WORD.findall(chunk.lower())
            counts.append(len(found))
            for word in found:
                own = self.model.rows_of(word)
                per_word.append(len(own))
                rows += own
        lens, n = np.array(per_word, np.int64), np.array(counts, np.int64)
        total = np.concatenate([np.zeros((1, self.score.shape[1])), np.cumsum(self.model.table[rows] if rows else np.zeros((0, self.score.shape[1])), axis=0, dtype=np.float64)])
        ends = np.cumsum(lens)
        mean = (total[ends] - total[ends - lens]) / np.maximum(lens, 1)[:, None] if len(lens) else np.zeros((0, self.score.shape[1]))
        total = np.concatenate([np.zeros((1, self.score.shape[1])), np.cumsum(mean, axis=0)])
        ends = np.cumsum(n)
        self.score = np.concatenate([self.score, (total[ends] - total[ends - n]).astype(np.float32)])
        self.n = np.concatenate([self.n, n])


def _predict(model: Model):
    def run(batches):
        scores = Scores(model)
        for batch in batches:
            for texts in words.slices(batch.column(1)):
                plain = [texts.bytes_of(i).decode() for i in range(len(texts))]
                place, counts = scores.places(plain)
                ends = np.cumsum(counts)
                total = np.concatenate([np.zeros((1, scores.score.shape[1])), np.cumsum(scores.score[place], axis=0, dtype=np.float64)])
                total = total[ends] - total[ends - counts]
                n_words = np.concatenate([[0], np.cumsum(scores.n[place])])
                n_words = n_words[ends] - n_words[ends - counts]
                best = total.argmax(axis=1)
                share = 1 / np.exp(np.maximum(-700, np.log(10) * (total - total.max(axis=1, keepdims=True)))).sum(axis=1)
                known = (n_words > 0) & bool(model.langs)
                pred = [model.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.rows.start, len(texts)), pa.array(pred, pa.string()), pa.array(np.where(known, np.minimum(share, 1.0), 0.0)), pa.array(n_words)],
                                                 ["doc_id", "lang_pred", "score", "n_words"])

    return run


def _count_words(batches):
    for batch in batches:
        by_lang: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_lang.setdefault(lang, Counter()).update(_WORD.findall(text.lower()))
        rows = [(lang, word, n) for lang, c in by_lang.items() for word, n in c.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])


def learn(labelled: DataFrame, most_rows: int = MOST_ROWS, most_words: int = MOST_WORDS) -> Model:
    """A model from rows with doc_id, text and lang (others are left out)."""
    lang, text = F.col("lang").cast("string"), F.col("text").cast("string")
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", lang.alias("lang"), text.alias("text"))
    many = {r["lang"]: most_rows / r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") > most_rows).collect()}
    if many:
        rate = F.create_map(*(F.lit(x) for lang, share in many.items() for x in (lang, int(share * (1 << 30)))))
        rows = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.coalesce(rate[F.col("lang")], F.lit(1 << 30)))
    counts = rows.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long")
    counts = counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    top = counts.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("at") <= most_words)
    out: dict[str, dict[str, int]] = {}
    for r in top.collect():
        out.setdefault(r["lang"], {})[r["word"]] = r["n"]
    return fit(out)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and n_words of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(model), _OUT)


def held_out(folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into this fold (null id: as empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == fold
