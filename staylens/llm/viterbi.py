"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is cut before each space into marked words; pieces never reach across a
mark. The distinct marked words of a run of texts are sorted, which walks their
trie depth-first: the best scores up to each place of a word stay on a stack,
and the next word goes on from the prefix it shares with the one before. Of
equally good pieces the longer is taken. A character that no piece covers
becomes its UTF-8 bytes.

Every task has its own words, so nothing is shuffled; the table of words is
bounded and started anew when full. Decoding gathers piece bytes and gives the
text back exactly, whatever characters it has (the vocabulary's own mark in a
text is encoded as bytes).

Null text: null ids. Empty text: no ids. Repeated rows are each answered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm import encode, words

#: The mark inside this module: a lone surrogate, which no text can hold.
MARK = "\ud800"
UNCOVERED = 10.0  # below the lowest score, for each character taken as bytes
SLICE = 8 << 20


class Viterbi(encode.ChunkEncoder):
    """Best segmentations by the vocabulary's piece scores."""

    def __init__(self, path: str, most: int = 450_000) -> None:
        import sentencepiece

        super().__init__(most)
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        assert self.size <= 1 << 16
        self.piece: dict[str, tuple[float, int]] = {}
        self.byte = np.zeros(256, int)
        raw = [b""] * self.size
        for i in range(self.size):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(name[3:-1], 16)
                self.byte[value] = i
                raw[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.piece[name.replace("▁", MARK)] = (model.get_score(i), i)
                raw[i] = name.replace("▁", " ").encode()
        lengths: dict[str, set[int]] = {}
        for p in self.piece:
            lengths.setdefault(p[-1], set()).add(len(p))
        self.lengths = {c: sorted(x, reverse=True) for c, x in lengths.items()}
        self.lost = min(s for s, _ in self.piece.values()) - UNCOVERED
        lens = np.fromiter(map(len, raw), np.int64, self.size)
        self.raw, self.raw_len = np.frombuffer(b"".join(raw), np.uint8), lens
        self.raw_at = np.cumsum(lens) - lens

    @staticmethod
    def chunks(text: str) -> list[str]:
        return text.split(" ") if text else []

    def new_ids(self, chunks: list[str]) -> list[list[int]]:
        order = sorted(range(len(chunks)), key=chunks.__getitem__)
        out: list = [None] * len(chunks)
        for at, ids in zip(order, self.walk([MARK + chunks[i] for i in order])):
            out[at] = ids
        return out

    def walk(self, marked: list[str]):
        """Ids of sorted marked words, one after the other."""
        piece, lengths, byte = self.piece, self.lengths, self.byte
        best, back, before = [0.0], [(0, -1)], ""
        for word in marked:
            n, same = len(word), 0
            limit = min(n, len(before))
            while same < limit and word[same] == before[same]:
                same += 1
            del best[same + 1 :], back[same + 1 :]
            for i in range(same + 1, n + 1):
                top, step = best[i - 1] + self.lost, (i - 1, -1)
                for k in lengths.get(word[i - 1], ()):
                    if k <= i and (p := piece.get(word[i - k : i])) is not None and (s := best[i - k] + p[0]) > top:
                        top, step = s, (i - k, p[1])
                best.append(top)
                back.append(step)
            before, ids, i = word, [], n
            while i:
                j, p = back[i]
                if p >= 0:
                    ids.append(p)
                else:
                    ids += [int(byte[b]) for b in reversed(word[j:i].replace(MARK, " ").encode())]
                i = j
            yield ids[::-1]

    def decode(self, ids: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts of these ids end to end, and their borders."""
        lens = self.raw_len[ids]
        ends = np.concatenate([[0], np.cumsum(lens)])
        data = self.raw[np.repeat(self.raw_at[ids] - ends[:-1], lens) + np.arange(ends[-1])]
        edges = ends[borders]
        first = edges[:-1][np.diff(edges) > 0]  # the first mark of a text stands for no space
        keep = np.ones(len(data), bool)
        keep[first] = False
        return data[keep], np.concatenate([[0], np.cumsum(np.diff(edges) - (np.diff(edges) > 0))])


def _encode(path: str):
    def run(batches):
        model = encode.kept(Viterbi, path)
        for batch in batches:
            for texts in words.slices(batch.column(1), most=SLICE):
                plain = [texts.bytes_of(i).decode() for i in range(len(texts))]
                ids, borders = model.encode(plain)
                data, edges = model.decode(ids, borders)
                m = len(plain)
                if np.array_equal(edges, texts.offsets) and np.array_equal(data, texts.data):
                    same = np.ones(m, bool)
                else:
                    same = np.array([data[edges[i] : edges[i + 1]].tobytes() == texts.bytes_of(i) for i in range(m)])
                whole = ids.astype("<u4")
                null = batch.column(1).slice(texts.rows.start, m).is_null().to_numpy(zero_copy_only=False)
                packed = pa.array([None if x else whole[borders[i] : borders[i + 1]].tobytes() for i, x in enumerate(null)], pa.binary())
                n_words = np.fromiter((len(model.chunks(t)) for t in plain), np.int64, m)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.rows.start, m), pa.array(n_words), pa.array(np.diff(borders)), packed, pa.array(same)], ["doc_id", "n_words", "n_ids", "ids", "round_trip"])

    return run


def encode_texts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_words, n_ids, ids (little-endian unsigned 32-bit) and whether decoding gives the text back."""
    path = tokenizer or encode.tokenizer_path("piece_bpe_32k.model")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encode(path), "doc_id long, n_words long, n_ids long, ids binary, round_trip boolean")


def decode_texts(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and text of rows of doc_id and ids (null ids: null text)."""
    path = tokenizer or encode.tokenizer_path("piece_bpe_32k.model")

    def run(batches):
        model = encode.kept(Viterbi, path)
        for batch in batches:
            listed = batch.column(1).to_pylist()
            ids = np.frombuffer(b"".join(x or b"" for x in listed), "<u4").astype(np.int64)
            data, edges = model.decode(ids, np.concatenate([[0], np.cumsum([len(x or b"") // 4 for x in listed])]).astype(np.int64))
            texts = [None if x is None else data[a:b].tobytes().decode() for x, a, b in zip(listed, edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
