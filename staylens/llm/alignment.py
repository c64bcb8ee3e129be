"""Cross-tokenizer alignment: which tokens of two vocabularies share bytes, counted over the corpus.

A byte-level BPE (A) reads a space and the text, a SentencePiece model (B) the
text, which adds the space. Both are cut where neither joins anything (before a
run of spaces and line ends, before marks that no piece of B has behind a
letter); a distinct chunk is encoded and aligned once. Between two neighbouring
token ends, of either side, exactly one A token and one B token overlap.

Counting spills and merges. A task writes its pair-document records in runs: a
run belongs to a slice of documents, is sorted by B id, then A id, and packed
with zstd. The pairs of a block of slices, each once with its total, are
radix-partitioned by bits of the B id. A partition merges the runs of all blocks
with a heap of run heads; as it goes through a B id's pairs together, the
highest count is known with the last of them, and counts and marks of the best
stream back to the blocks, in the order of their own pairs. There every record
takes its pair's count.

A pair travels once a block, however many documents hold it, so a frequent
token costs a partition no more than a rare one; the records go to their own
block, whose size is bounded by bytes of text (one document more at most).

Null or empty texts, and texts whose bytes a vocabulary does not give back, have
no tokens: zeros. Repeated rows (also of one id) each count. Null ids are kept.
An empty table gives no rows. Extra columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm import encode, words
from staylens.session import shared_path

BLOCK_BYTES = 32 << 20
FRAME = 2048  # pairs of a run that are unpacked at a time

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


# ---------------------------------------------------------------- packed arrays


def pack(values: np.ndarray, level: int = 1) -> bytes:
    """Unsigned integers as zstd of their byte planes (equal high bytes cost next to nothing)."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=level).compress(planes.tobytes())


def unpack(raw: bytes, kind: type) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(data.reshape(size, len(data) // size).T).view(kind).ravel()


def join(parts: list[bytes]) -> bytes:
    """Byte strings in one: how many, their lengths, themselves."""
    return np.array([len(parts), *map(len, parts)], "<u8").tobytes() + b"".join(parts)


def split(raw: bytes) -> list[bytes]:
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    ends = 8 * (n + 1) + np.cumsum(np.frombuffer(raw, "<u8", n, 8).astype(np.int64))
    return [raw[a:b] for a, b in zip([8 * (n + 1), *ends[:-1].tolist()], ends.tolist())]


# ---------------------------------------------------------------- encoding and alignment of chunks


def _decoded(token: str) -> bytes:
    """Bytes of a byte-level token: printable bytes stand for themselves, the others for 256, 257 and so on."""
    return bytes(_BYTE[c] for c in token)


_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE = {chr(b): b for b in _PLAIN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}


class Side:
    """Token bytes of a vocabulary in one array."""

    def __init__(self, raw: list[bytes]) -> None:
        assert len(raw) <= 1 << 16
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.len = np.fromiter(map(len, raw), np.int64, len(raw))
        self.at = np.cumsum(self.len) - self.len

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        lens = self.len[ids]
        ends = np.concatenate([[0], np.cumsum(lens)])
        return self.raw[np.repeat(self.at[ids] - ends[:-1], lens) + np.arange(ends[-1])]


class Aligner:
    """Alignments of distinct chunks, found by hash; started anew beyond ``most``."""

    def __init__(self, path_a: str, path_b: str, most: int = 300_000) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.most = most
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        vocabulary = self.a.get_vocab()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        raw = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if token not in special:
                raw[i] = _decoded(token)
        self.side_a = Side(raw)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.side_b = Side([bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else
                            p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        spelled = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        assert not any("\n" in p or "▁" in p.lstrip("▁") for p in spelled)  # what the cuts rely on
        joined = {p[i] for p in spelled for i in range(1, len(p)) if p[i - 1].isascii() and p[i - 1].isalpha()}
        self.mark = np.zeros(256, bool)  # ASCII marks that no piece has behind a letter; an apostrophe may begin a contraction
        self.mark[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in joined and chr(c) != "'"]] = True
        self.names = [str(i) for i in range(1 << 16)]
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.row = np.zeros(0, np.int64)
        self.groups: list[bytes] = []
        self.stats = np.zeros((0, 5), np.int64)  # A tokens, B tokens, groups, links, bad
        self.begin = np.zeros(0, np.int64)  # of a chunk's links in the next
        self.link = np.zeros(0, np.uint32)  # A id and, above it, B id

    def cut(self, texts: words.Texts) -> words.Words:
        """Chunks of texts that each begin with their space."""
        data, n = texts.data, len(texts.data)
        ahead = data[1:] == 0x20
        ahead |= data[1:] == 0x0A
        ahead &= ~_BLANK[data[:-1]]
        # a blank beyond ASCII may stand before: its last byte is a continuation behind one of these leads
        for lead, reach in ((0xC2, 1), (0xE1, 2), (0xE2, 2), (0xE3, 2)):
            ahead[reach:] &= data[: n - 1 - reach] != lead
        ahead |= self.mark[data[1:]] & _LETTER[data[:-1]]
        starts = np.zeros(n + 1, bool)
        starts[1:n] = ahead
        starts[texts.offsets[:-1]] = True  # an empty text marks its successor's start, or the end
        at = np.flatnonzero(starts[:n])
        return words.Words(at, np.concatenate([at[1:], [n]])[: len(at)], np.searchsorted(at, texts.offsets))

    def places(self, texts: words.Texts, found: words.Words) -> np.ndarray:
        """The table row of every chunk."""
        if len(self.known) > self.most:
            self.clear()
        distinct, one, which = words.distinct(words.hashes(texts.data, found.starts, found.ends))
        spot = np.searchsorted(self.known, distinct)
        rows = np.full(len(distinct), -1)
        inside = np.flatnonzero(spot < len(self.known))
        hit = inside[self.known[spot[inside]] == distinct[inside]]
        rows[hit] = self.row[spot[hit]]
        if len(new := np.flatnonzero(rows < 0)):
            raw = texts.data.tobytes()
            n = len(self.groups)
            self._add([raw[a:b] for a, b in zip(found.starts[one[new]].tolist(), found.ends[one[new]].tolist())])
            rows[new] = np.arange(n, n + len(new))
            self.known = np.insert(self.known, spot[new], distinct[new])
            self.row = np.insert(self.row, spot[new], rows[new])
        return rows[which]

    def _ids(self, chunks: list[str]) -> tuple[list, list]:
        """Ids of both sides. B puts a space before what it reads: a chunk's own space is left to it, else a line end
        takes that space, and both are dropped."""
        a = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        drop = [0 if c[0] == " " else 1 if c[0] == "\n" else 2 for c in chunks]
        b = self.b.encode([c if d == 1 else "\n" + c if d else c[1:] for c, d in zip(chunks, drop)], num_threads=1)
        lone = self.b.piece_to_id("▁")
        return a, [[lone] if c == " " else ids[d:] if d else ids for c, d, ids in zip(chunks, drop, b)]

    def _add(self, chunks: list[bytes]) -> None:
        ids_a, ids_b = self._ids([c.decode() for c in chunks])
        n = len(chunks)
        na, nb = (np.fromiter(map(len, x), np.int64, n) for x in (ids_a, ids_b))
        flat_a, flat_b = (np.fromiter((i for x in ids for i in x), np.int64, int(m.sum())) for ids, m in ((ids_a, na), (ids_b, nb)))
        size = np.fromiter(map(len, chunks), np.int64, n)
        bad = np.zeros(n, bool)
        for side, flat, m in ((self.side_a, flat_a, na), (self.side_b, flat_b, nb)):
            total = np.add.reduceat(np.append(side.len[flat], 0), np.cumsum(m) - m) * (m > 0)
            bad |= total != size
        good = ~bad
        keep_a, keep_b = np.repeat(good, na), np.repeat(good, nb)
        flat_a, flat_b = flat_a[keep_a], flat_b[keep_b]
        ends = np.cumsum(size * good)
        text = np.frombuffer(b"".join([c for c, g in zip(chunks, good.tolist()) if g]), np.uint8)
        wrong = np.flatnonzero((self.side_a.bytes_of(flat_a) != text) | (self.side_b.bytes_of(flat_b) != text))
        bad[np.searchsorted(ends, wrong, "right")] = True
        ends_a, ends_b = np.cumsum(self.side_a.len[flat_a]), np.cumsum(self.side_b.len[flat_b])
        both = np.union1d(ends_a, ends_b)
        link = flat_b[np.searchsorted(ends_b, both)] << 16 | flat_a[np.searchsorted(ends_a, both)]
        of_link = np.searchsorted(ends, both)
        n_links = np.bincount(of_link, minlength=n)
        border = np.intersect1d(ends_a, ends_b, assume_unique=True)
        of_border = np.searchsorted(ends, border)
        n_groups = np.bincount(of_border, minlength=n)
        good_a, good_b = na * good, nb * good
        upto_a = np.searchsorted(ends_a, border, "right") - (np.cumsum(good_a) - good_a)[of_border]
        upto_b = np.searchsorted(ends_b, border, "right") - (np.cumsum(good_b) - good_b)[of_border]
        at, upto_a, upto_b = (np.cumsum(n_groups) - n_groups).tolist(), upto_a.tolist(), upto_b.tolist()
        names = self.names
        for i, (a, b, m) in enumerate(zip(ids_a, ids_b, n_groups.tolist())):
            if m == 1:
                self.groups.append(f"{','.join([names[x] for x in a])}|{','.join([names[x] for x in b])}".encode())
                continue
            parts, p, q = [], 0, 0
            for k in range(at[i], at[i] + m):
                parts.append(f"{','.join([names[x] for x in a[p : upto_a[k]]])}|{','.join([names[x] for x in b[q : upto_b[k]]])}")
                p, q = upto_a[k], upto_b[k]
            self.groups.append(";".join(parts).encode())
        self.begin = np.concatenate([self.begin, len(self.link) + np.cumsum(n_links) - n_links])
        self.link = np.concatenate([self.link, link.astype(np.uint32)])
        self.stats = np.concatenate([self.stats, np.stack([na, nb, n_groups, n_links, bad], axis=1)])


_kept: dict = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner of these vocabularies, kept between tasks."""
    if (path_a, path_b) not in _kept:
        _kept.clear()
        _kept[path_a, path_b] = Aligner(path_a, path_b)
    return _kept[path_a, path_b]


def _spaced(texts: words.Texts) -> words.Texts:
    """Every text that is not empty behind a space."""
    some = np.diff(texts.offsets) > 0
    data = np.insert(texts.data, texts.offsets[:-1][some], 0x20)
    return words.Texts(data, texts.offsets + np.concatenate([[0], np.cumsum(some)]), texts.rows)


# ---------------------------------------------------------------- runs of pair-document records


def radix(link: np.ndarray, bits: int) -> np.ndarray:
    """Links with the lowest ``bits`` of their B id moved to the front: sorted, they lie by partition, B id, A id."""
    b = link >> np.uint32(16)
    turned = (b & np.uint32((1 << bits) - 1)) << np.uint32(16 - bits) | b >> np.uint32(bits)
    return turned << np.uint32(16) | link & np.uint32(0xFFFF)


def summed(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of each one's amounts."""
    if not len(keys):
        return keys, amounts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(amounts[order], first)


def _frames(pairs: np.ndarray, totals: np.ndarray) -> bytes:
    """A run of pairs and totals, in frames that can be unpacked one by one."""
    return join([join([pack(pairs[i : i + FRAME]), pack(totals[i : i + FRAME])]) for i in range(0, len(pairs), FRAME)])


DOC = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string())])
SPILL = "block string, bucket int, totals binary, slice binary"


class Block:
    """Pairs of the slices of a block, each once with its total."""

    def __init__(self, name: str, bits: int) -> None:
        self.name, self.bits, self.size = name, bits, 0
        self.pairs, self.totals = np.zeros(0, np.uint32), np.zeros(0, np.uint64)

    def add(self, pairs: np.ndarray, totals: np.ndarray, size: int) -> None:
        self.pairs, self.totals = summed(np.concatenate([self.pairs, pairs]), np.concatenate([self.totals, totals]))
        self.size += size

    def rows(self) -> pa.RecordBatch:
        """One run for every partition in which the block has pairs."""
        bucket = self.pairs >> np.uint32(32 - self.bits)
        some, first = np.unique(bucket, return_index=True)
        last = np.append(first[1:], len(bucket))
        runs = [_frames(self.pairs[a:b], self.totals[a:b]) for a, b in zip(first.tolist(), last.tolist())]
        return _spill_rows([self.name] * len(some), some.astype(np.int32).tolist(), runs, [None] * len(some))


def _spill_rows(block, bucket, totals, slices) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((block, bucket, totals, slices), kinds)], ["block", "bucket", "totals", "slice"])


def _slice(model: Aligner, texts: words.Texts, ids: pa.Array, bits: int, keep_groups: bool) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A slice's documents and packed records, and its pairs with their totals."""
    m = len(texts)
    spaced = _spaced(texts)
    found = model.cut(spaced)
    place = model.places(spaced, found) if len(found.starts) else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(m), found.counts)
    sums = np.stack([np.bincount(doc, weights=model.stats[place, k], minlength=m).astype(np.int64) for k in range(5)])
    good = sums[4] == 0
    sums[:, ~good] = 0
    listed, first, digests, texts_of = place.tolist(), found.first.tolist(), [], []
    groups = model.groups
    for i in range(m):
        spelled = b";".join([groups[p] for p in listed[first[i] : first[i + 1]]]) if good[i] else b""
        digests.append(hashlib.sha256(spelled).hexdigest() if spelled else "")
        texts_of.append(spelled.decode() if keep_groups else None)
    rows = pa.RecordBatch.from_arrays([ids, *(pa.array(x) for x in sums[:4]), pa.array(digests, pa.string()), pa.array(texts_of, pa.string())], schema=DOC)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, DOC, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    # distinct chunks of each document, then their links
    use = good[doc]
    at, times = summed(place[use] << np.int64(32) | doc[use], np.ones(int(use.sum()), np.int64))
    chunk, doc = at >> np.int64(32), (at & np.int64(0xFFFFFFFF)).astype(np.uint64)
    n = model.stats[chunk, 3]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    link = model.link[np.repeat(model.begin[chunk] - (ends - n), n) + np.arange(total)]
    key = radix(link, bits).astype(np.uint64) << np.uint64(32) | np.repeat(doc, n)
    key, times = summed(key, np.repeat(times, n))
    pair, doc = (key >> np.uint64(32)).astype(np.uint32), (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    begins = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
    pairs = pair[begins]
    totals = np.add.reduceat(times, begins).astype(np.uint64) if len(begins) else np.zeros(0, np.uint64)
    held = np.diff(np.append(begins, len(pair))).astype(np.uint32)
    gaps = np.diff(doc, prepend=np.uint32(0)).astype(np.uint32)
    gaps[begins] = doc[begins]
    parts = [sink.getvalue().to_pybytes(), pack(np.diff(pairs, prepend=np.uint32(0))), pack(held), pack(gaps), pack(times.astype(np.uint32))]
    return join(parts), pairs, totals


def _spill(path_a: str, path_b: str, bits: int, keep_groups: bool, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        model = _aligner(path_a, path_b)
        block = Block(f"{task}-{number}", bits)
        for batch in batches:
            for texts in words.slices(batch.column(1)):
                ids = batch.column(0).slice(texts.rows.start, len(texts))
                raw, pairs, totals = _slice(model, texts, ids, bits, keep_groups)
                yield _spill_rows([block.name], [None], [None], [raw])
                block.add(pairs, totals, len(texts.data))
                if block.size >= block_bytes:
                    yield block.rows()
                    number += 1
                    block = Block(f"{task}-{number}", bits)
        yield block.rows()

    return words.tidy(run)


# ---------------------------------------------------------------- merging runs, counts back


class Run:
    """A run of pairs and totals that is read frame by frame."""

    def __init__(self, raw: bytes) -> None:
        self.frames = split(raw)[::-1]
        self.keys, self.totals = np.zeros(0, np.uint32), np.zeros(0, np.uint64)
        self.back: list[np.ndarray] = []

    def more(self) -> bool:
        """Another frame behind what is left of the one before."""
        if not self.frames:
            return False
        keys, totals = (unpack(x, t) for x, t in zip(split(self.frames.pop()), (np.uint32, np.uint64)))
        self.keys, self.totals = np.concatenate([self.keys, keys]), np.concatenate([self.totals, totals])
        return True


def merge(runs: list[Run]) -> None:
    """Count every pair over all runs; each run gets back, in its order, its pairs' counts with a mark for a B id's best.

    One heap has the last key that each run has unpacked: what lies before the
    least of them, up to its B id, is complete. Another has the runs' first keys,
    so only runs that hold such pairs are touched.
    """
    ends, heads = [], []
    for i, run in enumerate(runs):
        if run.more():
            ends.append((int(run.keys[-1]), i))
            heads.append((int(run.keys[0]), i))
    heapq.heapify(ends)
    heapq.heapify(heads)
    while heads:
        # all pairs below this key are unpacked wherever they are
        bound = (ends[0][0] >> 16) << 16 if ends else 1 << 32
        taken = []
        while heads and heads[0][0] < bound:
            i = heapq.heappop(heads)[1]
            taken.append((i, int(np.searchsorted(runs[i].keys, bound)) if bound < 1 << 32 else len(runs[i].keys)))
        if taken:
            keys = np.concatenate([runs[i].keys[:n] for i, n in taken])
            distinct, which = np.unique(keys, return_inverse=True)
            counts = np.zeros(len(distinct), np.uint64)
            np.add.at(counts, which, np.concatenate([runs[i].totals[:n] for i, n in taken]))
            side = distinct >> np.uint32(16)
            first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
            highest = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(side))))
            back = (counts << np.uint64(1) | (counts == highest).astype(np.uint64))[which]
            at = 0
            for i, n in taken:
                run = runs[i]
                run.back.append(back[at : at + n])
                at += n
                run.keys, run.totals = run.keys[n:], run.totals[n:]
                if len(run.keys):
                    heapq.heappush(heads, (int(run.keys[0]), i))
        if ends:  # the run that held the bound goes on
            i = heapq.heappop(ends)[1]
            empty = not len(runs[i].keys)
            if runs[i].more():
                heapq.heappush(ends, (int(runs[i].keys[-1]), i))
                if empty:
                    heapq.heappush(heads, (int(runs[i].keys[0]), i))


BACK = "block string, bucket int, counts binary"


def _merge(table: pa.Table) -> pa.Table:
    """All runs of a partition to the counts for each block."""
    runs = [Run(raw) for raw in table.column("totals").to_pylist()]
    merge(runs)
    counts = [pack(np.concatenate(run.back)) for run in runs]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "counts": pa.array(counts, pa.binary())})


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def _records(raw: bytes) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    docs, pairs, held, gaps, times = split(raw)
    rows = pa.ipc.open_stream(docs).read_next_batch()
    pairs, held = np.cumsum(unpack(pairs, np.uint32), dtype=np.uint32), unpack(held, np.uint32).astype(np.int64)
    gaps = unpack(gaps, np.uint32).astype(np.int64)
    if len(held):
        run = np.cumsum(gaps)
        begins = np.cumsum(held) - held
        gaps = run - np.repeat(run[begins] - gaps[begins], held)
    return rows, pairs, held, gaps, unpack(times, np.uint32).astype(np.int64)


def _finish(slices: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block; its pairs' counts lie by partition as the pairs do."""
    order = np.argsort(counts.column("bucket").to_numpy()) if len(counts) else []
    packed = counts.column("counts").to_pylist()
    count = np.concatenate([np.zeros(0, np.uint64), *(unpack(packed[i], np.uint64) for i in order)])
    raw = slices.column("slice").to_pylist()
    every = np.unique(np.concatenate([np.zeros(0, np.uint32), *(np.cumsum(unpack(split(x)[1], np.uint32), dtype=np.uint32) for x in raw)]))
    assert len(every) == len(count)
    best, count = (count & np.uint64(1)).astype(np.int64), (count >> np.uint64(1)).astype(np.int64)
    out = []
    for x in raw:
        rows, pairs, held, doc, times = _records(x)
        at = np.repeat(np.searchsorted(every, pairs), held)
        n_best, total = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
        np.add.at(n_best, doc, times * best[at])
        np.add.at(total, doc, times * count[at])
        c = rows.columns
        out.append(pa.Table.from_arrays([*c[:5], pa.array(n_best), pa.array(total), *c[5:]], [x.split()[0] for x in RESULT.split(", ")]))
    return pa.concat_tables(out) if out else pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in RESULT.split(", ")]).empty_table()


def partition_bits(docs: DataFrame) -> int:
    """At least two radix partitions for every shuffle partition of the session, 64 to 4,096."""
    wanted = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(12, max(6, (wanted - 1).bit_length()))


def align(docs: DataFrame, tokenizer_a: str | None = None, tokenizer_b: str | None = None, keep_groups: bool = False,
          bits: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: tokens, groups, links, links that are their B id's best, sum of the links' counts, and the groups'
    SHA-256 (``groups`` themselves with ``keep_groups``, else null)."""
    spark = docs.sparkSession
    path_a, path_b = tokenizer_a or encode.tokenizer_path("byte_bpe_50k.json"), tokenizer_b or encode.tokenizer_path("piece_bpe_32k.model")
    bits = partition_bits(docs) if bits is None else bits
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = shared_path(spark, "alignment")
    rows.mapInArrow(_spill(path_a, path_b, bits, keep_groups, block_bytes), SPILL).write.parquet(path)
    spilled = spark.read.schema(SPILL).parquet(path)
    totals = spilled.where("totals is not null").select("block", "bucket", "totals")
    counts = totals.groupBy("bucket").applyInArrow(_merge, BACK)
    slices = spilled.where("slice is not null").select("block", "slice")
    return slices.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_finish, RESULT)
