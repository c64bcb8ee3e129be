"""Subword ids of whole texts from the public tokenizer files, one call per distinct chunk.

Texts are cut at spaces and line ends, where neither vocabulary joins anything,
each distinct chunk is encoded once by the tokenizer library, and the ids of a
text are gathered from a table with numpy. The chunk table is kept between the
batches a Python worker sees and started anew beyond ``most`` chunks, so its
memory is bounded; that only costs time, never ids.
"""

from __future__ import annotations

from itertools import chain

import numpy as np

from staylens.llm import words

#: ASCII marks but the apostrophe, which can be part of a contraction.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
JOIN = 64


class ChunkTable:
    """A table of distinct chunks; subclasses keep something for each of them."""

    def __init__(self, most: int = 250_000) -> None:
        self.most = most
        self.place: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        """Start anew (subclasses forget what they keep)."""
        self.place.clear()

    def add(self, chunks: list[str]) -> None:
        """Keep something for these new chunks, in this order."""
        raise NotImplementedError

    @staticmethod
    def chunks(text: str) -> list[str]:
        return text.replace("\n", " ").split(" ")

    def places(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The table place of every chunk, end to end, and how many each text has."""
        if len(self.place) > self.most:
            self.clear()
        parts = [self.chunks(t) for t in texts]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        every = [c for p in parts for c in p]
        if new := list(set(every).difference(self.place)):
            self.add(new)
            n = len(self.place)
            self.place.update(zip(new, range(n, n + len(new))))
        return np.fromiter(map(self.place.__getitem__, every), np.int64, len(every)), counts


class ChunkEncoder(ChunkTable):
    """Ids of texts through a table of distinct chunks; subclasses encode new chunks."""

    def clear(self) -> None:
        super().clear()
        self.flat = np.zeros(0, np.uint16)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def new_ids(self, chunks: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def add(self, chunks: list[str]) -> None:
        ids = self.new_ids(chunks)
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        fresh = np.fromiter((i for x in ids for i in x), np.uint16, int(lens.sum()))
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(lens) - lens])
        self.count = np.concatenate([self.count, lens])
        self.flat = np.concatenate([self.flat, fresh])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end (uint16), and the borders of each text's ids."""
        place, counts = self.places(texts)
        lens = self.count[place]
        ends = np.concatenate([[0], np.cumsum(lens)])
        ids = self.flat[np.repeat(self.begin[place] - ends[:-1], lens) + np.arange(ends[-1])]
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]


class WordEncoder:
    """Ids of texts through a table of distinct words, found by their 64-bit hashes.

    Words are maximal runs of the bytes in ``table``. No Python object is made
    for a word that is known; two words share a hash once in 2^64 pairs.
    """

    table = words.NOT_BLANK

    def __init__(self, most: int = 500_000) -> None:
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes, and the table row of each
        self.row = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint16)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def new_ids(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words end to end, and how many each has."""
        raise NotImplementedError

    def encode(self, texts: words.Texts, found: words.Words | None = None, groups: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end (uint16), and the borders of each text's ids.

        ``found`` and ``groups`` are the texts' words and their distinct hashes, if known.
        """
        if len(self.known) > self.most:
            self.clear()
        found = found or words.scan(texts, self.table)
        distinct, one, which = groups or words.distinct(words.hashes(texts.data, found.starts, found.ends))
        spot = np.searchsorted(self.known, distinct)
        rows = np.full(len(distinct), -1)
        inside = np.flatnonzero(spot < len(self.known))
        hit = inside[self.known[spot[inside]] == distinct[inside]]
        rows[hit] = self.row[spot[hit]]
        if len(new := np.flatnonzero(rows < 0)):
            at, raw = one[new], texts.data.tobytes()
            ids, lens = self.new_ids([raw[a:b].decode() for a, b in zip(found.starts[at].tolist(), found.ends[at].tolist())])
            n = len(self.begin)
            rows[new] = np.arange(n, n + len(new))
            self.known = np.insert(self.known, spot[new], distinct[new])
            self.row = np.insert(self.row, spot[new], rows[new])
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(lens) - lens])
            self.count = np.concatenate([self.count, lens])
            self.flat = np.concatenate([self.flat, ids])
        place = rows[which]
        lens = self.count[place]
        ends = np.concatenate([[0], np.cumsum(lens)])
        ids = self.flat[np.repeat(self.begin[place] - ends[:-1], lens) + np.arange(ends[-1])]
        return ids, ends[found.first]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lens = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint16, int(lens.sum())), lens


class WordBpe(WordEncoder):
    """A vocabulary file of the ``tokenizers`` library (word ends marked, lower case).

    Texts are cut at spaces and line ends only, so whatever else there is comes
    to the library as it stands. Latin-1 words, with or without ASCII marks
    behind them, go many to a call and are told apart by their word-end ids.
    """

    table = np.ones(256, bool)
    table[[0x20, 0x0A]] = False

    def __init__(self, path: str, most: int = 500_000) -> None:
        from tokenizers import Tokenizer

        super().__init__(most)
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        assert self.size <= 1 << 16
        self.last = np.zeros(self.size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.last[i] = token.endswith("</w>")

    def encode(self, texts: words.Texts, found: words.Words | None = None, groups: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
        if b"<|" not in texts.data.tobytes():  # else lowering could make a special token of a text's own
            texts = words.Texts(words.LOWER[texts.data], texts.offsets, texts.rows)
        return super().encode(texts)

    @staticmethod
    def _parts(word: str) -> int:
        """Pre-tokens of a Latin-1 word (1) or such a word and ASCII marks (2); 0 if it is neither."""
        if not (word.isascii() or max(word) <= "ÿ"):
            return 0
        if word.isalpha():
            return 1
        core = word.rstrip(MARKS)
        return 2 if len(core) < len(word) and core.isalpha() else 0

    def new_ids(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = np.fromiter(map(self._parts, new), np.int64, len(new))
        plain = np.flatnonzero(parts)
        lists: list = [None] * len(new)
        groups = [plain[i : i + JOIN] for i in range(0, len(plain), JOIN)]
        joined = self.tokenizer.encode_batch_fast([" ".join([new[i] for i in g]) for g in groups], add_special_tokens=False) if groups else []
        for g, got in zip(groups, joined):
            ids = got.ids
            ends = np.flatnonzero(self.last[ids]) + 1
            due = np.cumsum(parts[g]) - 1
            if len(ends) != due[-1] + 1:  # not told apart after all
                for i in g.tolist():
                    lists[i] = self.tokenizer.encode(new[i], add_special_tokens=False).ids
                continue
            a = 0
            for i, b in zip(g.tolist(), ends[due].tolist()):
                lists[i] = ids[a:b]
                a = b
        other = np.flatnonzero(parts == 0).tolist()
        if other:
            for i, got in zip(other, self.tokenizer.encode_batch_fast([new[i] for i in other], add_special_tokens=False)):
                lists[i] = got.ids
        return _flat(lists)


class Pieces(WordEncoder):
    """A SentencePiece model file; every blank-separated word is encoded on its own."""

    def __init__(self, path: str, most: int = 500_000) -> None:
        import sentencepiece

        super().__init__(most)
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        assert self.size <= 1 << 16
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.size)])

    def new_ids(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self.model.encode(new, num_threads=1))


_kept: dict = {}


def kept(kind: type, path: str):
    """The worker's encoder of this kind and file, kept between tasks; one at a time."""
    if (kind, path) not in _kept:
        _kept.clear()
        _kept[kind, path] = kind(path)
    return _kept[kind, path]


def forget() -> None:
    """Let the kept encoder go."""
    _kept.clear()


def tokenizer_path(name: str) -> str:
    """The default place of a public vocabulary (every operator takes another as a parameter)."""
    import public_tokenizers

    return public_tokenizers.path(name)
