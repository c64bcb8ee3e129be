"""Byte-level BPE encoding and decoding over slices that a scan has found.

``pretokens`` cuts the texts; distinct slices are merged once and kept in a table
by their 64-bit hashes. New slices are merged together, one merge a round and
slice: the pair of lowest rank, the leftmost of equal ones, as the rank file's
own library does. A long slice is merged alone with a heap. The table is bounded
and started anew when full; that costs time, never ids.

Texts stay in their partitions: nothing is shuffled, nothing gathered, and a lost
task is simply run again.

Null or empty text: no ids, empty bytes. Repeated rows (also of one id) are each
answered, a null id stays null. An empty table gives no rows. Extra columns of
any name are ignored.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm import encode, pretokens, words

LONG = 48  # bytes; a longer slice is merged with a heap
NONE = np.int64(1 << 40)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks (lines of base64 and a number)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PairTable:
    """Ranks by pair in one open-addressed array: a few gathers for a whole array of pairs."""

    def __init__(self, pairs: list[tuple[int, int]]) -> None:
        key, rank = np.array(pairs, np.int64).reshape(-1, 2).T
        bits = int(2 * len(key) + 2).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key, self.rank = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE)
        left, at = np.arange(len(key)), self._home(key)
        while len(left):  # one step of linear probing for all that have no place yet
            free = self.key[at] < 0
            self.key[at[free]] = key[left[free]]  # of several at one place the last stays
            lost = self.key[at] != key[left]
            self.rank[at[~lost]] = rank[left[~lost]]
            left, at = left[lost], (at[lost] + 1) & self.mask

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE where there is none."""
        at = self._home(key)
        found = self.key[at]
        out = self.rank[at]
        out[found != key] = NONE
        open_ = np.flatnonzero((found != key) & (found >= 0))
        at = at[open_]
        while len(open_):
            at = (at + 1) & self.mask
            found = self.key[at]
            hit = found == key[open_]
            out[open_[hit]] = self.rank[at[hit]]
            more = ~hit & (found >= 0)
            open_, at = open_[more], at[more]
        return out


class Merger:
    """Pair merging by rank."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        assert self.size <= 1 << 16
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        # every way to put a token together from two others
        self.pairs = PairTable([(ranks[t[:i]] << 16 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks])

    def merge(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all slices end to end, and how many each has."""
        done_slice: list[np.ndarray] = []
        done_ids: list[np.ndarray] = []
        direct = np.fromiter((self.ranks.get(s, -1) for s in slices), np.int64, len(slices))
        lens = np.fromiter(map(len, slices), np.int64, len(slices))
        whole = np.flatnonzero(direct >= 0)
        done_slice.append(whole)
        done_ids.append(direct[whole])
        for i in np.flatnonzero((direct < 0) & (lens > LONG)).tolist():
            ids = self.merge_long(slices[i])
            done_slice.append(np.full(len(ids), i))
            done_ids.append(np.array(ids, np.int64))
        rest = np.flatnonzero((direct < 0) & (lens <= LONG) & (lens > 0))
        ids = self.single[np.frombuffer(b"".join([slices[i] for i in rest.tolist()]), np.uint8)]
        owner = np.repeat(rest, lens[rest])
        while len(ids):
            start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            joined = np.full(len(ids), NONE)
            joined[:-1] = np.where(owner[1:] == owner[:-1], self.pairs.find(ids[:-1] << 16 | ids[1:]), NONE)
            # rank first, place second: the least is the leftmost pair of lowest rank
            best = np.minimum.reduceat(joined << 22 | np.arange(len(ids)), start)
            rank, place = best >> 22, best & ((1 << 22) - 1)
            more = rank < NONE
            if not more.all():  # nothing left to merge in these
                ready = np.repeat(~more, np.diff(np.concatenate([start, [len(ids)]])))
                done_slice.append(owner[ready])
                done_ids.append(ids[ready])
            at = place[more]
            ids[at] = rank[more]
            keep = np.repeat(more, np.diff(np.concatenate([start, [len(ids)]])))
            keep[at + 1] = False
            ids, owner = ids[keep], owner[keep]
        which, flat = np.concatenate(done_slice), np.concatenate(done_ids)
        order = np.argsort(which, kind="stable")
        return flat[order].astype(np.uint16), np.bincount(which, minlength=len(slices)).astype(np.int64)

    def merge_long(self, raw: bytes) -> list[int]:
        """One long slice: a heap of pairs, neighbours as linked places."""
        if (r := self.ranks.get(raw)) is not None:
            return [r]
        n = len(raw)
        ranks = self.ranks
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a part is raw[i:end[i]]
        live = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not live[i] or j >= n or end[j] != stop:  # one of the two has changed since
                continue
            live[j] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(raw[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(raw[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i : end[i]]])
            i = end[i]
        return out


class ByteBpe(encode.WordEncoder):
    """Ids by a rank file; slices are kept by hash."""

    AT_ONCE = 50_000  # with LONG: at most 2,400,000 bytes merged at once, whose places fit in 22 bits

    def __init__(self, path: str, ranges: list[tuple[int, int, int]], most: int = 400_000) -> None:
        super().__init__(most)
        self.merger = Merger(read_ranks(path))
        self.table = pretokens.class_array(ranges)
        raw = [b""] * self.merger.size
        for token, i in self.merger.ranks.items():
            raw[i] = token
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_len = np.fromiter(map(len, raw), np.int64, len(raw))
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len

    def new_ids(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.merger.merge([s.encode() for s in new[i : i + self.AT_ONCE]]) for i in range(0, len(new), self.AT_ONCE)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def encode_slice(self, texts: words.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice of texts end to end, and the borders of each text's ids."""
        return self.encode(texts, pretokens.scan(texts, self.table))

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The byte at which each id begins, and the end of the last."""
        return np.concatenate([[0], np.cumsum(self.raw_len[ids])])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bytes of the ids, each put at its offset."""
        return self.raw[np.repeat(self.raw_at[ids] - offsets[:-1], self.raw_len[ids]) + np.arange(offsets[-1])]


_kept: dict = {}


def _encoder(path: str, ranges: list) -> ByteBpe:
    """The worker's encoder of this file, kept between tasks."""
    if path not in _kept:
        _kept.clear()
        _kept[path] = ByteBpe(path, ranges)
    return _kept[path]


ENCODED = "doc_id long, n_tokens long, ids binary, offsets binary, decoded binary"


def _packed(whole: np.ndarray, borders: np.ndarray) -> pa.Array:
    """Rows of whole[borders[i]:borders[i + 1]] as binaries, without a copy of each."""
    offsets = (borders * whole.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(borders) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(whole))])


def _run(path: str, ranges: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _encoder(path, ranges)
        for batch in batches:
            for texts in words.slices(batch.column(1)):
                ids, borders = model.encode_slice(texts)
                offsets = model.offsets(ids)
                decoded = model.decode(ids, offsets)
                edges = offsets[borders]
                own = offsets[:-1] - np.repeat(edges[:-1], np.diff(borders))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(texts.rows.start, len(texts)), pa.array(np.diff(borders)), _packed(ids.astype("<u4"), borders),
                     _packed(own.astype("<u4"), borders), _packed(decoded, edges)], ["doc_id", "n_tokens", "ids", "offsets", "decoded"])

    return words.tidy(run)


def encode_texts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids and offsets (little-endian unsigned 32-bit: each id, and the byte of its text at which
    it begins) and the bytes decoded from these ids."""
    path = tokenizer or encode.tokenizer_path("byte_bpe_50k.tiktoken")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_run(path, pretokens.class_ranges()), ENCODED)


def decode_texts(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and decoded (binary) of rows of doc_id, ids and offsets; null ids are decoded as none."""
    path = tokenizer or encode.tokenizer_path("byte_bpe_50k.tiktoken")
    ranges = pretokens.class_ranges()

    def run(batches):
        model = _encoder(path, ranges)
        for batch in batches:
            out = []
            for ids, begins in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ids = np.frombuffer(ids or b"", "<u4").astype(np.int64)
                begins = np.frombuffer(begins or b"", "<u4").astype(np.int64)
                end = begins[-1] + model.raw_len[ids[-1]] if len(ids) else 0
                out.append(model.decode(ids, np.append(begins, end)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids", "offsets").mapInArrow(run, "doc_id long, decoded binary")
