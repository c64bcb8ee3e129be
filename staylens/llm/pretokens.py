"""Pre-token borders of byte-level BPE, found by a scan over codepoint classes.

Every codepoint gets a class from one array. A small automaton walks the
classes and says where a pre-token starts; what it needs to see ahead (does a
blank end its run, does an ``r`` stand before an ``e``) is part of the class. A
transition function of the automaton is a number, the composition of two is an
entry of a table, and composing is associative: blocks of text are composed side
by side, the blocks' products are scanned by doubling, and every block is then
walked from its own first state, all blocks at once. No regular expression runs
over the text.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from staylens.llm import words

#: Classes. A blank that another blank or the end follows; the last blank of a run (space or not);
#: letters; numbers; the rest; the apostrophe; letters that end a contraction; letters that begin one's last two.
MID, SPACE, LAST, LETTER, NUMBER, OTHER, QUOTE, ONE, TWO = range(9)
N_CLASSES = 9
#: States: what the next codepoint continues.
FRESH, BLANKS, LED, LETTERS, NUMBERS, OTHERS, QUOTED, HALF = range(8)
N_STATES = 8

#: Fixed values of the public pattern: contractions of one and of two letters after the apostrophe.
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")

BLOCK = 128


def _step(state: int, cls: int) -> tuple[bool, int]:
    """Does a pre-token start here, and the next state."""
    if state == HALF:
        return False, FRESH
    if state == QUOTED and cls == ONE:
        return False, FRESH
    if state == QUOTED and cls == TWO:
        return False, HALF
    if cls == MID:
        return state != BLANKS, BLANKS
    if cls == SPACE:
        return True, LED
    if cls == LAST:
        return True, FRESH
    if cls in (LETTER, ONE, TWO):
        return state not in (LED, LETTERS), LETTERS
    if cls == NUMBER:
        return state not in (LED, NUMBERS), NUMBERS
    if cls == OTHER:
        return state not in (LED, OTHERS, QUOTED), OTHERS
    if state in (LED, OTHERS, QUOTED):  # an apostrophe inside a run
        return False, OTHERS
    return True, QUOTED


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """starts[state, class], to[state, class], function of a class, product[f, g] (f first), image[f, state].

    Class ``c + N_CLASSES`` is class ``c`` at the start of a text: its function ignores the state.
    """
    starts = np.zeros((N_STATES, 2 * N_CLASSES), bool)
    to = np.zeros((N_STATES, 2 * N_CLASSES), np.uint8)
    for c in range(N_CLASSES):
        for s in range(N_STATES):
            starts[s, c], to[s, c] = _step(s, c)
            starts[s, c + N_CLASSES], to[s, c + N_CLASSES] = _step(FRESH, c)
    place: dict[tuple, int] = {tuple(range(N_STATES)): 0}  # the function that changes nothing
    of_class = []
    for c in range(2 * N_CLASSES):
        of_class.append(place.setdefault(tuple(int(x) for x in to[:, c]), len(place)))
    todo = list(place)
    while todo:
        f = todo.pop()
        for c in range(2 * N_CLASSES):
            g = tuple(int(to[x, c]) for x in f)
            if g not in place:
                place[g] = len(place)
                todo.append(g)
    functions = list(place)
    product = np.array([[place[tuple(g[x] for x in f)] for g in functions] for f in functions], np.uint16)
    return starts, to, np.array(of_class, np.uint16), product, np.array(functions, np.uint8)


@lru_cache(maxsize=1)
def class_ranges() -> list[tuple[int, int, int]]:
    """(first, last, class) of codepoints that are not OTHER, as the tokenizer library sees them (made once, on the driver)."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    out = []
    for pattern, cls in ((r"\s", MID), (r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        found = tiktoken.Encoding(f"class{cls}", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        at = np.array([ord(c) for i in range(0, len(every), 1 << 16) for c in bytes(found.encode_ordinary(every[i : i + (1 << 16)])).decode()])
        cut = np.flatnonzero(np.diff(at) != 1)
        out += [(int(a), int(b), cls) for a, b in zip(at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])])]
    return out


def class_array(ranges: list[tuple[int, int, int]]) -> np.ndarray:
    """The class of every codepoint (all blanks as MID, letters that begin a contraction's last two as LETTER)."""
    table = np.full(0x110000, OTHER, np.uint8)
    for a, b, cls in ranges:
        table[a : b + 1] = cls
    table[ord("'")] = QUOTE
    table[[ord(c) for c in ONE_LETTER]] = ONE
    return table


def classes(codes: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Classes with what lies ahead worked in; ``first`` marks the first codepoint of each text."""
    cls = table[codes]
    n = len(cls)
    blank = cls == MID
    ends = np.ones(n, bool)
    ends[:-1] = first[1:]
    last = np.zeros(n, bool)
    last[:-1] = blank[:-1] & ~blank[1:] & ~ends[:-1]
    cls[last] = LAST
    cls[last & (codes == 0x20)] = SPACE
    for a, b in TWO_LETTERS:
        cls[:-1][(codes[:-1] == ord(a)) & (codes[1:] == ord(b)) & ~ends[:-1]] = TWO
    cls[first] += N_CLASSES
    return cls


def start_flags(cls: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, by a blocked scan over transition functions."""
    starts, to, of_class, product, image = automaton()
    n = len(cls)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, LETTER, np.uint8)
    padded[:n] = cls
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    width = product.shape[1]
    flat = product.ravel()
    whole = of_class[columns[0]].astype(np.int32)
    for row in columns[1:]:
        whole = flat[whole * width + of_class[row]].astype(np.int32)
    before = np.zeros(blocks, np.int32)  # the product of all blocks before each
    before[1:] = whole[:-1]
    step = 1
    while step < blocks:
        before[step:] = flat[before[:-step] * width + before[step:]]
        step *= 2
    state = image[before, FRESH].astype(np.int32)
    begins, moves = starts.ravel(), to.ravel()
    out = np.empty((BLOCK, blocks), bool)
    for i, row in enumerate(columns):
        at = state * (2 * N_CLASSES) + row
        out[i] = begins[at]
        state = moves[at].astype(np.int32)
    return out.T.ravel()[:n]


def scan(texts: words.Texts, table: np.ndarray) -> words.Words:
    """The pre-tokens of a slice of texts as byte ranges; none spans two texts, together they are every byte."""
    data, border = texts.data, texts.offsets
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return words.Words(none, none, np.zeros(len(border), np.int64))
    first = np.zeros(n + 1, bool)
    first[border[:-1]] = True
    if data.max() < 0x80:
        codes, lead = data.astype(np.uint32), None
    else:
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        lead = np.flatnonzero((data & 0xC0) != 0x80)
    begin = first[:n] if lead is None else first[lead]
    flags = np.flatnonzero(start_flags(classes(codes, begin, table)))
    starts = flags if lead is None else lead[flags]
    return words.Words(starts, np.concatenate([starts[1:], [n]]), np.searchsorted(starts, border))
