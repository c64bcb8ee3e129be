"""Vectorised word scanning of Arrow text batches, shared by the operators here.

A batch's UTF-8 bytes are scanned once with numpy: word borders come from a
256-entry byte table, and every word gets a 64-bit hash read eight bytes at a
time, so no Python object is made per word. All functions work on slices of a
bounded number of bytes (one document more at most).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64
SLICE_BYTES = 2 << 20
LONG_WORD = 256

#: Bytes of words ``[^\x20\x09-\x0D]+``.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, 9, 10, 11, 12, 13]] = False
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after A-Z became a-z).
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_MASK = np.array([0] + [(1 << (8 * i)) - 1 for i in range(1, 9)], dtype=U)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def tidy(run):
    """``run`` (batches to batches) in a worker that holds little before and after it.

    Python workers outlive a task: an encoder that an earlier operator kept is
    let go first, and freed memory goes back to the system at the end.
    """

    def tidied(batches):
        from staylens.llm import encode

        encode.forget()
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (in place on a fresh array)."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    x *= U(0xA0761D6478BD642F)
    x ^= x >> U(32)
    return x


@dataclass
class Texts:
    """A slice of a batch: bytes of its texts end to end, and their borders."""

    data: np.ndarray
    offsets: np.ndarray
    rows: slice

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


@dataclass
class Words:
    """Words of a slice: byte borders, and for each text its first word's index."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def slices(column: pa.Array, lower: bool = False, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """Runs of texts of about ``most`` bytes (null: empty), optionally A-Z lowered."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        part = data[offsets[at] : offsets[end]]
        yield Texts(LOWER[part] if lower else part, offsets[at : end + 1] - offsets[at], slice(at, end))
        at = end


def of(texts: list[str] | list[bytes]) -> Texts:
    """These texts (or their bytes) as one slice."""
    raw = [t.encode() if isinstance(t, str) else t for t in texts]
    return Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), slice(0, len(raw)))


def scan(texts: Texts, table: np.ndarray = NOT_BLANK) -> Words:
    """Maximal runs of word bytes; a word never spans two texts."""
    word, n = table[texts.data], len(texts.data)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    border = texts.offsets
    before[border[border < n]] = False
    after[border[border > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    return Words(starts, np.flatnonzero(word & ~after) + 1, np.searchsorted(starts, border))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte range (equal ranges, equal hashes, in any batch)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    lens = ends - starts
    h = mix(lens.astype(U) + U(_BASE))
    if not len(h):
        return h
    h = mix(h ^ (eight[starts] & _MASK[np.minimum(lens, 8)]))
    live, done = np.flatnonzero(lens > 8), 8
    while len(live) and done < LONG_WORD:
        left = lens[live] - done
        h[live] = mix(h[live] ^ (eight[starts[live] + done] & _MASK[np.minimum(left, 8)]))
        done += 8
        live = live[left > 8]
    for i in live:
        h[i] = U(xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes()))
    return h


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes in order, a place of each, and for every hash its place among them."""
    order = np.argsort(h)
    s = h[order]
    first = np.ones(len(s), bool)
    first[1:] = s[1:] != s[:-1]
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(first) - 1
    return s[first], order[first], which


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` items from each place on (places too near the end left out).

    A prefix sum of item hashes times powers of an odd base gives every window
    in constant time, whatever ``n`` is.
    """
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U)
    power = np.full(len(h), _BASE, U)
    power[0] = 1
    total = np.concatenate([np.zeros(1, U), np.cumsum(h * np.cumprod(power), dtype=U)])
    back = np.full(m, _BASE_INV, U)
    back[0] = 1
    return mix((total[n:] - total[:m]) * np.cumprod(back))


def count_at(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the sorted positions lie in each text."""
    return np.diff(np.searchsorted(positions, offsets))
