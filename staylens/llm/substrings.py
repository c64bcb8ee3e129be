"""Substring dedup by super-k-mer partitioning of word windows.

Every window of ``window`` consecutive words has a minimiser, the smallest hash
among its runs of ``MINIMISER`` words. Neighbouring windows mostly share it, and
such a run of windows travels as one packed string (a super-k-mer: its words
joined by single spaces) to the bucket of the minimiser. Equal windows have
equal minimisers, so they meet in one bucket, where sorting finds equal windows
exactly: sorted by hash, then compared as bytes. A window that also starts
earlier (smaller doc_id, or same document and earlier word) marks its words.

Hot passages: a task sends equal super-k-mers of a run of documents once, for
their earliest place; the places left out are marked at once. So a bucket gets
a passage at most once from each such run, however many copies there are.
Strings to one bucket travel as compressed blobs.

Null text has no words and stays null. Rows that repeat a doc_id count as the
same document (a window at one place is no copy of itself). A null doc_id comes
before all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm import words
from staylens.llm.words import U

WINDOW = 20
MINIMISER = 2
MOST_RUN = 256  # windows of one super-k-mer; longer runs are split
FLUSH_BYTES = 32 << 20
MOST_MARKS = 400_000
MANY_WINDOWS = 600_000
NULL_ID = -(1 << 63)
LEVEL = 6  # of the blobs' compression

_SENT = "bucket int, n int, blob binary"
_MARK = "doc_id long, row long, start long, end long"


def canonical(texts: words.Texts, found: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with one space after each word, and the words' borders there."""
    n = len(texts.data)
    keep = np.zeros(n + 1, bool)
    keep[:n] = words.NOT_BLANK[texts.data]
    data = np.append(texts.data, np.uint8(32))
    gap = found.ends[(found.ends < n)]
    gap = gap[~keep[gap]]
    keep[gap] = True
    data[gap] = 32
    moved = np.cumsum(keep) - keep
    return data[keep], moved[found.starts], moved[found.ends - 1] + 1


def minimisers(h: np.ndarray, first: np.ndarray, window: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window places (word index) and each window's minimiser."""
    counts = np.diff(first)
    m = len(h) - window + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    low = words.windows(h, size)  # one for each run of `size` words
    span, reach = window - size + 1, 1
    while reach * 2 <= span:
        low = np.minimum(low[: len(low) - reach], low[reach:])
        reach *= 2
    if reach < span:
        low = np.minimum(low[: len(low) - (span - reach)], low[span - reach :])
    ends = np.repeat(first[1:], counts)[:m]
    at = np.flatnonzero(np.arange(m) + window <= ends)
    return at, low[at]


def runs(at: np.ndarray, low: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Borders of super-k-mers among the windows: same document, adjacent, same minimiser."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(at), bool)
    doc = np.searchsorted(first, at, "right")
    new[1:] = (np.diff(at) != 1) | (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    begin = np.flatnonzero(place % MOST_RUN == 0)
    return begin, np.append(begin[1:], len(at))


class _Sender:
    """Super-k-mers of a run of documents, equal ones once."""

    def __init__(self, window: int, buckets: int) -> None:
        self.window, self.buckets = window, buckets
        self.clear()

    def clear(self) -> None:
        self.held: dict[bytes, tuple[int, int, int, int]] = {}  # string: doc, row, start, minimiser's bucket
        self.marks: list[tuple[int, int, int, int]] = []
        self.size = 0

    def add(self, texts: words.Texts, ids: np.ndarray, rows: np.ndarray) -> None:
        found = words.scan(texts)
        h = words.hashes(texts.data, found.starts, found.ends)
        at, low = minimisers(h, found.first, self.window, min(MINIMISER, self.window))
        begin, end = runs(at, low, found.first)
        if not len(begin):
            return
        data, starts, ends = canonical(texts, found)
        raw = data.tobytes()
        doc = np.searchsorted(found.first, at[begin], "right") - 1
        bucket = (low[begin] % U(self.buckets)).astype(np.int64)
        held, marks, window = self.held, self.marks, self.window
        columns = (starts[at[begin]], ends[at[end - 1] + window - 1], ids[doc], rows[doc], at[begin] - found.first[doc], bucket, end - begin)
        for a, b, d, r, s, k, n in zip(*(c.tolist() for c in columns)):
            text = raw[a:b]
            old = held.setdefault(text, new := (d, r, s, k))
            if old is new:
                self.size += b - a
            elif (d, s) < (old[0], old[2]):
                held[text] = new
                marks.append((old[0], old[1], old[2], old[2] + n + window - 1))
            elif (d, s) != (old[0], old[2]):
                marks.append((d, r, s, s + n + window - 1))
            elif r != old[1]:
                self.size += b - a  # another text under the same doc_id, at the same place
                held[text + b" " * (1 + len(held))] = new

    def rows(self) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL)
        order = sorted(self.held.items(), key=lambda x: x[1][3])
        out = [[], [], []]
        i = 0
        while i < len(order):
            j, bucket = i, order[i][1][3]
            while j < len(order) and order[j][1][3] == bucket:
                j += 1
            strings = [x[0] for x in order[i:j]]
            doc, row, start = np.array([x[1][:3] for x in order[i:j]], np.int64).T
            facts = _packed(doc, row, start, np.fromiter(map(len, strings), np.int64, j - i))
            for column, x in zip(out, (bucket, j - i, pack.compress(facts + b"".join(strings)))):
                column.append(x)
            i = j
        for a in range(0, len(out[0]), 512):
            yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 512], t) for c, t in zip(out, (pa.int32(), pa.int32(), pa.binary()))], ["bucket", "n", "blob"])
        if self.marks:  # marks made here need no bucket: they travel as rows of bucket -1
            for a in range(0, len(self.marks), 500_000):
                part = np.array(self.marks[a : a + 500_000], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([len(part)], pa.int32()), pa.array([pack.compress(part.tobytes())], pa.binary())], ["bucket", "n", "blob"])


#: Bytes of a string's facts in a blob: document (as difference to the one before), row, start, length.
FACTS = 8 + 4 + 8 + 8


def _packed(doc: np.ndarray, row: np.ndarray, start: np.ndarray, lens: np.ndarray) -> bytes:
    with np.errstate(over="ignore"):
        step = np.diff(doc, prepend=np.int64(0))
    return step.tobytes() + row.astype("<u4").tobytes() + start.tobytes() + lens.tobytes()


def _unpacked(raw: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        doc = np.cumsum(np.frombuffer(raw, np.int64, n), dtype=np.int64)
    return doc, np.frombuffer(raw, "<u4", n, 8 * n).astype(np.int64), np.frombuffer(raw, np.int64, n, 12 * n), np.frombuffer(raw, np.int64, n, 20 * n)


def _send(window: int, buckets: int):
    def run(batches):
        sender = _Sender(window, buckets)
        for batch in batches:
            ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            rows = batch.column(1).to_numpy(zero_copy_only=False)
            for texts in words.slices(batch.column(2)):
                sender.add(texts, ids[texts.rows], rows[texts.rows])
                if sender.size >= FLUSH_BYTES or len(sender.marks) >= MOST_MARKS:
                    yield from sender.rows()
                    sender.clear()
        yield from sender.rows()

    return run


def later_windows(strings: list[bytes], docs: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, window in it) of the windows whose words also start at an earlier place."""
    data = np.frombuffer(b"".join(strings), np.uint8)
    lens = np.fromiter(map(len, strings), np.int64, len(strings))
    texts = words.Texts(data, np.concatenate([[0], np.cumsum(lens)]), slice(0, len(strings)))
    found = words.scan(texts)
    h = words.windows(words.hashes(data, found.starts, found.ends), window)
    counts = found.counts
    ends = np.repeat(found.first[1:], counts)[: len(h)]
    at = np.flatnonzero(np.arange(len(h)) + window <= ends)
    h = h[at]
    order = np.argsort(h)
    same = np.diff(h[order]) == 0
    if not same.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    pick = order[twice]
    string = np.searchsorted(found.first, at[pick], "right") - 1
    place = at[pick] - found.first[string]
    doc, start = docs[string], starts[string] + place
    sort = np.lexsort((start, doc, h[pick]))
    raw, first, out = data.tobytes(), {}, []
    begin, end = found.starts[at[pick]], found.ends[at[pick] + window - 1]
    for i, a, b, d, s in zip(sort.tolist(), begin[sort].tolist(), end[sort].tolist(), doc[sort].tolist(), start[sort].tolist()):
        if first.setdefault(raw[a:b], (d, s)) != (d, s):
            out.append(i)
    return string[out], place[out]


def joined(doc: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """The union of word ranges of each (doc, row)."""
    if not len(doc):
        return [doc, row, start, end]
    order = np.lexsort((start, row, doc))
    doc, row, start, end = doc[order], row[order], start[order], end[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])
    group = np.cumsum(new)
    # the running end within a group: ends are shifted so that groups can't reach each other
    shift = group * (int(end.max()) + 1)
    far = np.maximum.accumulate(end + shift) - shift
    cut = new.copy()
    cut[1:] |= start[1:] > far[:-1]
    at = np.flatnonzero(cut)
    return [doc[at], row[at], start[at], far[np.append(at[1:], len(doc)) - 1]]


def _count(window: int):
    """Windows of whole buckets, several small buckets at a time."""

    def work(held):
        unpack = zstandard.ZstdDecompressor()
        strings, facts, marks = [], [], []
        for bucket, n, blob in held:
            raw = unpack.decompress(blob)
            if bucket < 0:
                marks.append(np.frombuffer(raw, np.int64).reshape(n, 4))
                continue
            doc, row, start, lens = _unpacked(raw, n)
            at = FACTS * n
            for length in lens.tolist():
                strings.append(raw[at : at + length])
                at += length
            facts.append(np.stack([doc, row, start]))
        if strings:
            doc, row, start = np.concatenate(facts, axis=1)
            string, place = later_windows(strings, doc, start, window)
            a = start[string] + place
            marks.append(np.stack([doc[string], row[string], a, a + window], axis=1))
        whole = np.concatenate(marks) if marks else np.zeros((0, 4), np.int64)
        return joined(*(whole[:, i] for i in range(4)))

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            for bucket, n, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if bucket != last and size >= MANY_WINDOWS:
                    yield _marks(work(held))
                    held, size = [], 0
                held.append((bucket, n, blob))
                size, last = size + 8 * n, bucket
        if held:
            yield _marks(work(held))

    return run


def _marks(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "row", "start", "end"])


def _row(text) -> Column:
    """32 bits that tell rows of one doc_id apart by their text."""
    return F.pmod(F.xxhash64(text), F.lit(1 << 32))


def repeated(docs: DataFrame, window: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """(doc_id, row, spans): word ranges to remove; ``row`` is the hash of the text, a null id is ``NULL_ID``."""
    spark = docs.sparkSession
    buckets = buckets or max(256, 16 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.col("text").cast("string")
    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), _row(text).alias("row"), text.alias("text"))
    sent = rows.mapInArrow(words.tidy(_send(window, buckets)), _SENT)
    # marks of bucket -1 are spread: they need no company
    key = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("blob"), F.lit(buckets))).otherwise(F.col("bucket"))
    met = sent.withColumn("key", key).repartition("key").sortWithinPartitions("bucket").select("bucket", "n", "blob")
    marks = met.mapInArrow(words.tidy(_count(window)), _MARK)
    return marks.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


_KEPT = "kept string, n_words long, n_removed long, kept_sha256 string"


def _cut(batches):
    for batch in batches:
        spans = batch.column(batch.schema.names.index("_spans"))
        doc = batch.column(batch.schema.names.index("doc"))
        column = doc.field("text").cast(pa.string())
        new = [[], [], [], []]
        texts_left = column.is_null().to_pylist()
        listed = spans.to_pylist()
        for texts in words.slices(column):
            found = words.scan(texts)
            data, starts, ends = canonical(texts, found)
            raw = data.tobytes()
            for i in range(len(texts)):
                at = texts.rows.start + i
                a, b = int(found.first[i]), int(found.first[i + 1])
                gone = np.zeros(b - a, bool)
                for s in listed[at] or ():
                    gone[s["start"] : s["end"]] = True
                parts, last = [], 0
                if a < b:
                    edges = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
                    parts = [raw[starts[a + x] : ends[a + y - 1]] for x, y in zip(edges[::2].tolist(), edges[1::2].tolist())]
                kept = b" ".join(parts)
                n = int(gone.sum())
                for c, x in zip(new, (None if texts_left[at] or not n else kept.decode(), b - a, n, hashlib.sha256(kept).hexdigest())):
                    c.append(x)
        yield pa.RecordBatch.from_arrays([doc, *(pa.array(c, t) for c, t in zip(new, (pa.string(), pa.int64(), pa.int64(), pa.string())))], ["doc", "kept", "n_words", "n_removed", "kept_sha256"])


def dedup_substrings(docs: DataFrame, window: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """(doc, kept, n_words, n_removed, kept_sha256): each row whole as a struct.

    ``kept`` is null where nothing was removed, else the kept words joined by a
    space; the digest is of the kept words joined by a space in either case.
    """
    gone = repeated(docs, window, buckets).select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), F.col("spans").alias("_spans"))
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_d"), _row(text).alias("_r"))
    both = rows.join(gone, (F.col("_d") == F.col("_id")) & (F.col("_r") == F.col("_row")), "left").select("doc", "_spans")
    doc_type = both.schema["doc"].dataType.simpleString()
    return both.mapInArrow(words.tidy(_cut), f"doc {doc_type}, {_KEPT}")


def drop_repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with later copies of windows taken out of ``text``, all columns as they were."""
    out = dedup_substrings(docs, window)
    text = F.coalesce(F.col("kept"), F.col("doc.text")).cast(docs.schema["text"].dataType)
    return out.select(*((text if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))
