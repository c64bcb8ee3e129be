"""Spelling variants: near words of a vocabulary by finite-state composition.

The vocabulary is an acceptor. Composed with a transducer of exactly one edit
and with the acceptor again it accepts the pairs of near words. Two words one
edit apart share the first or the last half of the shorter one, so the initial
state has one arc for each half: every partition of the data holds the
acceptors behind some of these arcs and enumerates their accepted pairs.

Behind an arc all words of a length are built into a minimal acyclic acceptor;
both lengths that can meet use one register of states, so equal languages are
one state. The composition walks both acceptors side by side before the edit,
and after it until both are in the same state: then all words from there are
accepted pairs, a range of places on each side, not a walk.

A word is counted once for every arc; what leaves a partition is one row a word
(count and best near word), never its pairs. Forms are followed to roots by
pointer jumping on a checkpointed table.

Null text: no words. A null ``doc_id`` stands as nothing before the colon.
Repeated rows count each time. An empty table gives no rows. Extra columns of
any name are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm import words
from staylens.session import ensure_checkpoint_dir, shared_path

SHORTEST = 5  # code points of a word
LONG = 64  # bytes; checksums of longer runs are taken one by one
PARTIAL = "word string, n long, n_near long, form_n long, form string"


# ---------------------------------------------------------------- the vocabulary


def runs(texts: words.Texts) -> words.Words:
    """Maximal runs of ASCII letters and U+00C0 to U+00FF (in UTF-8: C3 and the byte after it)."""
    data, n = texts.data, len(texts.data)
    low = data | 0x20
    inside = (low >= 0x61) & (low <= 0x7A) & (data < 0x80)
    mark = data == 0xC3
    inside |= mark
    inside[1:] |= mark[:-1]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    border = texts.offsets
    before[border[border < n]] = False
    after[border[border > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return words.Words(starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, border))


class Checksums:
    """crc32 of a prefix and a word from the two parts' own: behind ``k`` more bytes a checksum is a linear map of itself."""

    def __init__(self) -> None:
        table = np.array([zlib.crc32(bytes([i])) for i in range(256)], np.uint64)
        base = np.uint32(zlib.crc32(b"\0"))
        step = (table.astype(np.uint32) ^ base)[:, None]  # one zero byte behind a register with only its low byte set
        self.step = step.ravel()
        maps = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
        for _ in range(LONG):
            last = maps[-1]
            maps.append(self.step[last & 0xFF] ^ (last >> np.uint32(8)))
        self.maps = np.stack(maps)  # length, byte of the checksum, its value

    def joined(self, prefix: np.ndarray, word: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Checksums of prefix and word together; ``lens`` are the words' bytes, LONG at most."""
        out = word.copy()
        for k in range(4):
            out ^= self.maps[lens, k, (prefix >> np.uint32(8 * k)) & 0xFF]
        return out


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    lens = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lens)])
    flat = data[np.repeat(starts - offsets[:-1], lens) + np.arange(offsets[-1])]
    return pa.StringArray.from_buffers(len(lens), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(flat))


def _count(modulus: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Checksums()
        for batch in batches:
            prefixes = np.array([zlib.crc32(b"%s:" % (b"" if i is None else str(i).encode())) for i in batch.column(0).to_pylist()], np.uint32)
            for texts in words.slices(batch.column(1), lower=True):
                found = runs(texts)
                lens = found.ends - found.starts
                inner = np.concatenate([[0], np.cumsum((texts.data & 0xC0) == 0x80)])
                points = lens - (inner[found.ends] - inner[found.starts])
                use = np.flatnonzero(points >= SHORTEST)
                if not len(use):
                    continue
                starts, ends, lens, points = found.starts[use], found.ends[use], lens[use], points[use]
                doc = np.repeat(np.arange(len(texts)), found.counts)[use] + texts.rows.start
                _, one, which = words.distinct(words.hashes(texts.data, starts, ends))
                raw = texts.data.tobytes()
                own = np.array([zlib.crc32(raw[a:b]) for a, b in zip(starts[one].tolist(), ends[one].tolist())], np.uint32)
                h = sums.joined(prefixes[doc], own[which], np.minimum(lens, LONG))
                for i in np.flatnonzero(lens > LONG).tolist():
                    h[i] = zlib.crc32(raw[starts[i] : ends[i]], int(prefixes[doc[i]]))
                hit = h % np.uint32(modulus) == 0
                n = np.bincount(which[~hit], minlength=len(one))
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([_strings(texts.data, starts[one[some]], ends[one[some]]), pa.array(n[some])], ["word", "n"])
                cut = []
                for i in np.flatnonzero(hit).tolist():
                    if points[i] > SHORTEST:
                        at, word = int(h[i]) % int(points[i]), raw[starts[i] : ends[i]].decode()
                        cut.append(word[:at] + word[at + 1 :])
                if cut:
                    yield pa.RecordBatch.from_arrays([pa.array(cut, pa.string()), pa.array(np.ones(len(cut), np.int64))], ["word", "n"])

    return words.tidy(run)


def vocabulary(docs: DataFrame, least: int = 3, modulus: int = 97) -> DataFrame:
    """word, n: runs of letters with one code point deleted where ``modulus`` divides the checksum of id and run."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    counted = rows.mapInArrow(_count(modulus), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").cast("long").alias("n")).where(F.col("n") >= least)


# ---------------------------------------------------------------- acceptors and their composition


class Register:
    """States of minimal acyclic acceptors: equal languages are one state.

    ``arcs[s]`` maps a character to (state, how many words of ``s`` come before it); ``size[s]`` counts its words.
    State 0 accepts the empty word alone.
    """

    def __init__(self) -> None:
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]
        self.size = [1]
        self.known: dict[tuple, int] = {}

    def state(self, arcs: list[tuple[str, int]]) -> int:
        key = tuple(arcs)
        s = self.known.get(key)
        if s is None:
            s = self.known[key] = len(self.arcs)
            out, before = {}, 0
            for c, t in arcs:
                out[c] = (t, before)
                before += self.size[t]
            self.arcs.append(out)
            self.size.append(before)
        return s

    def acceptor(self, sorted_words: list[str]) -> int:
        """The state that accepts these distinct words of one length, given in order; from the ends to the start."""
        length = len(sorted_words[0])
        states = [0] * len(sorted_words)
        first = list(range(len(sorted_words)))  # of the words with one beginning: the first
        common = [-1, *(len(commonprefix(pair)) for pair in zip(sorted_words, sorted_words[1:]))]  # with the word before
        for depth in range(length - 1, -1, -1):
            at, merged_first, merged = 0, [], []
            while at < len(first):
                head, arcs = first[at], []
                while at < len(first) and (first[at] == head or common[first[at]] >= depth):
                    arcs.append((sorted_words[first[at]][depth], states[at]))
                    at += 1
                merged_first.append(head)
                merged.append(self.state(arcs))
            first, states = merged_first, merged
        return states[0]

    def same(self, p: int, q: int, i: int, j: int, out: list[tuple[int, int, int]], but: str | None = None) -> None:
        """Words that both states accept: ranges of places (from i, from j, how many). ``but``: not with this first character."""
        todo = [(p, q, i, j, but)]
        while todo:
            p, q, i, j, but = todo.pop()
            if p == q and but is None:
                out.append((i, j, self.size[p]))
                continue
            a, b = self.arcs[p], self.arcs[q]
            if len(b) < len(a):
                for c, (t, n) in b.items():
                    if c != but and (x := a.get(c)) is not None:
                        todo.append((x[0], t, i + x[1], j + n, None))
            else:
                for c, (t, n) in a.items():
                    if c != but and (x := b.get(c)) is not None:
                        todo.append((t, x[0], i + n, j + x[1], None))

    def replaced(self, p: int) -> list[tuple[int, int, int]]:
        """Pairs of one acceptor's words that differ in one character (each pair once)."""
        out: list[tuple[int, int, int]] = []
        todo = [(p, 0)]
        while todo:
            p, i = todo.pop()
            arcs = list(self.arcs[p].values())
            for k, (t, n) in enumerate(arcs):
                if self.size[t] > 1:
                    todo.append((t, i + n))
                for u, m in arcs[k + 1 :]:
                    self.same(t, u, i + n, i + m, out)
        return out

    def deleted(self, p: int, q: int) -> list[tuple[int, int, int]]:
        """Pairs of a word of ``p`` and a word of ``q`` that is it without one character (each pair once: the last of a repeated character)."""
        out: list[tuple[int, int, int]] = []
        todo = [(p, q, 0, 0)]
        while todo:
            p, q, i, j = todo.pop()
            shorter = self.arcs[q]
            for c, (t, n) in self.arcs[p].items():
                if q == 0:
                    if t == 0:
                        out.append((i + n, j, 1))
                    continue
                self.same(t, q, i + n, j, out, but=c)
                if (x := shorter.get(c)) is not None:
                    todo.append((t, x[0], i + n, j + x[1]))
        return out


def _expand(found: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    a, b, n = np.array(found, np.int64).reshape(-1, 3).T
    more = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(a, n) + more, np.repeat(b, n) + more


def near_pairs(side: str, length: int, rests: list[str], whole: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of near words behind one arc: words of ``length`` with each other and with words one longer.

    ``rests`` are distinct, of two lengths, and sorted; ``whole`` are the words they belong to.
    """
    keep = length - length // 2 if side == "s" else length // 2
    short = [i for i, r in enumerate(rests) if len(r) == length - keep]
    long = [i for i, r in enumerate(rests) if len(r) == length - keep + 1]
    register = Register()
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if not short:
        return left[0], right[0]
    low = register.acceptor([rests[i] for i in short])
    short_at = np.array(short)
    if len(short) > 1 and (found := register.replaced(low)):
        a, b = _expand(found)
        left.append(short_at[a])
        right.append(short_at[b])
    if long and (found := register.deleted(register.acceptor([rests[i] for i in long]), low)):
        a, b = _expand(found)
        a, b = np.array(long)[a], short_at[b]
        if side == "s":  # with the first half in common the pair is found behind that arc
            half = length // 2
            other = np.array([whole[x][:half] != whole[y][:half] for x, y in zip(a.tolist(), b.tolist())], bool)
            a, b = a[other], b[other]
        left.append(a)
        right.append(b)
    return np.concatenate(left), np.concatenate(right)


def _group_rows(key: str, rests: list[str], whole: list[str], n: list[int]) -> list[tuple]:
    """One row for every word that has a near word behind this arc."""
    side, length = key[0], int(key[1 : key.index(":")])
    a, b = near_pairs(side, length, rests, whole)
    if not len(a):
        return []
    best_first = sorted(range(len(whole)), key=lambda i: (-n[i], whole[i]))
    rank = np.empty(len(whole), np.int64)
    rank[best_first] = np.arange(len(whole))
    best = np.full(len(whole), len(whole))
    np.minimum.at(best, a, rank[b])
    np.minimum.at(best, b, rank[a])
    count = np.bincount(a, minlength=len(whole)) + np.bincount(b, minlength=len(whole))
    return [(whole[i], n[i], int(count[i]), n[best_first[best[i]]], whole[best_first[best[i]]]) for i in np.flatnonzero(count).tolist()]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of rows with one key (they follow each other) to one row a word and key."""
    key, rests, whole, n, out = None, [], [], [], []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out))
        out.clear()
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["word", "n", "n_near", "form_n", "form"])

    for part in batches:
        for k, r, w, c in zip(*(part.column(i).to_pylist() for i in range(4))):
            if k != key:
                if len(whole) > 1:
                    out += _group_rows(key, rests, whole, n)
                    if len(out) > 20_000:
                        yield batch()
                key, rests, whole, n = k, [], [], []
            rests.append(r)
            whole.append(w)
            n.append(c)
    if len(whole) > 1:
        out += _group_rows(key, rests, whole, n)
    if out:
        yield batch()


def _arcs(vocab: DataFrame) -> DataFrame:
    """key, rest, word, n: every word behind the arcs of its halves, as the shorter or as the longer one of a pair."""
    made = []
    size = F.char_length("word")
    for one_longer in (0, 1):
        length = size - one_longer
        half = F.floor(length / 2).cast("int")
        tail = length - half
        first = F.struct(F.concat(F.lit("p"), length, F.lit(":"), F.substring("word", F.lit(1), half)).alias("key"),
                         F.substring("word", half + 1, size).alias("rest"))
        last = F.struct(F.concat(F.lit("s"), length, F.lit(":"), F.substring("word", size - tail + 1, tail)).alias("key"),
                        F.reverse(F.substring("word", F.lit(1), size - tail)).alias("rest"))
        made += [F.when(length >= SHORTEST, x) for x in (first, last)]
    return vocab.select("word", "n", F.explode(F.array_compact(F.array(*made))).alias("at")).select("at.key", "at.rest", "word", "n")


def variants(docs: DataFrame, least: int = 3, modulus: int = 97, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of the vocabulary of ``docs``.

    ``form`` is the near word of largest n (ties: smallest) if that is at least ``times`` the word's own.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "vocabulary")
    vocabulary(docs, least, modulus).write.parquet(path)
    vocab = spark.read.schema("word string, n long").parquet(path)
    dealt = _arcs(vocab).repartition("key").sortWithinPartitions("key", "rest")
    near = dealt.mapInArrow(words.tidy(_pairs), PARTIAL)
    alone = vocab.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))))
    found = alone.unionByName(near).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").cast("long").alias("n_near"), best.alias("best"))
    taken = -F.col("best.less") >= times * F.col("n")
    forms = found.select("word", F.when(taken, F.col("best.form")).alias("form"), "n", "n_near", F.when(taken, -F.col("best.less")).alias("form_n"))
    written = shared_path(spark, "forms")
    forms.write.parquet(written)
    forms = spark.read.schema("word string, form string, n long, n_near long, form_n long").parquet(written)
    roots = _roots(forms)
    out = forms.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of words with a form: pointers are doubled until none moves (counts at least double along a chain, so it is short)."""
    ensure_checkpoint_dir(forms.sparkSession)
    at = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = at.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")).checkpoint()
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at
