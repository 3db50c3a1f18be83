"""Byte-level BPE by arrays: pre-tokens found by a scan of transition functions, pair merging with a cache, decoding.

The pattern of the public byte-level vocabularies is a small automaton once two code points of lookahead are folded into
the symbol that a code point stands for. Every symbol is a function from states to states; functions compose
associatively, so the states of millions of positions come from a blocked scan over numbers of functions, and the places
where pre-tokens start from one more table. No regular expression runs. The bytes between two starts are merged once
per distinct pre-token and remembered up to a bound. Ids keep the byte at which they start, so any stretch of them can
be decoded to its place.

* The classes of code points (letter, number, white space) are read once per worker from the library whose result is to
  be met, so both follow the same Unicode version.
* Null text: empty, no ids. Empty tables give no rows; repeated rows and null ids are kept as they come. Columns other
  than doc_id and text are not read. Scanning takes a bounded stretch of a long text at a time; its ids are one row.
* Nothing is shuffled and nothing is shared between rows, so a lost task is simply run again.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import in_python

#: Symbols. A quote stands for itself plus what follows: one or two letters of a contraction.
LETTER, NUMBER, OTHER, SPACE_BEFORE, LAST_WHITE, WHITE, QUOTE_1, QUOTE_2, RESET = range(9)
#: States: what the pre-token read so far is. HANGING is a space that the next code point takes in.
START, LETTERS, NUMBERS, OTHERS, HANGING, WHITES, TWO_LEFT, ONE_LEFT, CONTRACTED = range(9)

#: The endings of contractions, by their first letter; None: complete with it.
ENDINGS = {"s": None, "t": None, "m": None, "d": None, "r": "e", "v": "e", "l": "l"}

_STRETCH = 1 << 20
_COLUMNS = 128


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a pre-token starts at this code point."""
    if symbol == RESET:
        return START, False
    if symbol == LETTER:
        if state in (TWO_LEFT, ONE_LEFT):
            return state + 1, False
        return LETTERS, state not in (LETTERS, HANGING)
    if symbol == NUMBER:
        return NUMBERS, state not in (NUMBERS, HANGING)
    if symbol in (OTHER, QUOTE_1, QUOTE_2):
        if state in (OTHERS, HANGING):
            return OTHERS, False
        return {OTHER: OTHERS, QUOTE_1: ONE_LEFT, QUOTE_2: TWO_LEFT}[symbol], True
    if symbol == SPACE_BEFORE:
        return HANGING, True
    return WHITES, symbol == LAST_WHITE or state != WHITES


@functools.cache
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of each symbol's function, composition of any two functions, their values, and starts by (state, symbol)."""
    symbols = [tuple(_step(state, s)[0] for state in range(9)) for s in range(9)]
    numbers = {tuple(range(9)): 0}
    functions = [tuple(range(9))]
    for f in functions:
        for g in symbols:
            both = tuple(g[f[state]] for state in range(9))
            if both not in numbers:
                numbers[both] = len(functions)
                functions.append(both)
    compose = np.array([[numbers[tuple(g[x] for x in f)] for g in functions] for f in functions], np.uint8)
    starts = np.array([[_step(state, s)[1] for s in range(9)] for state in range(9)])
    return np.array([numbers[s] for s in symbols], np.uint8), compose, np.array(functions, np.uint8), starts


def _states(functions: np.ndarray, state: int) -> np.ndarray:
    """State after every position, from the composed functions of all positions before it (blocked scan)."""
    _, compose, values, _ = _automaton()
    n = len(functions)
    if n <= _COLUMNS:
        out = np.empty(n, np.uint8)
        for i, f in enumerate(functions.tolist()):
            state = values[f, state]
            out[i] = state
        return out
    rows = -(-n // _COLUMNS)
    grid = np.zeros(rows * _COLUMNS, np.uint8)  # function 0 changes nothing
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(rows, _COLUMNS).T)
    for k in range(1, _COLUMNS):
        grid[k] = compose[grid[k - 1], grid[k]]
    entering = np.empty(rows, np.uint8)
    entering[0] = state
    entering[1:] = _states(grid[-1], state)[:-1]
    return values[grid, entering].T.reshape(-1)[:n]


@functools.cache
def _classes() -> np.ndarray:
    """LETTER, NUMBER, WHITE or OTHER for every code point, as the library sees them.

    A pattern that matches single code points of one class makes the library return exactly their bytes.
    """
    import tiktoken

    points = np.array([i for i in range(0x110000) if not 0xD800 <= i < 0xE000], np.uint32)
    text = points.tobytes().decode("utf-32-le")
    kinds = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        single = tiktoken.Encoding(
            f"class-{kind}", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={}
        )
        found = bytes(single.encode_ordinary(text)).decode()
        kinds[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return kinds


def _symbols(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Classes with the lookahead folded in. Separators are RESET in ``kinds`` and end a run of white space."""
    out = kinds.copy()
    white = kinds == WHITE
    last = np.zeros(len(kinds), bool)
    last[:-1] = white[:-1] & (kinds[1:] != WHITE) & (kinds[1:] != RESET)
    out[last] = np.where(points[last] == 32, SPACE_BEFORE, LAST_WHITE)
    quotes = np.flatnonzero((points == 39) & (kinds == OTHER))
    if len(quotes):
        padded = np.concatenate([np.where(kinds == RESET, 0, points), np.zeros(2, points.dtype)])
        first, second = padded[quotes + 1], padded[quotes + 2]
        for letter, rest in ENDINGS.items():
            here = first == ord(letter)
            if rest is None:
                out[quotes[here]] = QUOTE_1
            else:
                out[quotes[here & (second == ord(rest))]] = QUOTE_2
    return out


def starts_of(points: np.ndarray, separators: np.ndarray) -> np.ndarray:
    """Positions at which pre-tokens start in code points of several texts with one separator after each."""
    numbers, _, _, starts = _automaton()
    found, state = [], START
    resets = np.zeros(len(points), bool)
    resets[separators] = True
    for begin in range(0, len(points), _STRETCH):
        stretch = points[begin : begin + _STRETCH + 2]  # two more for the lookahead
        kinds = _classes()[stretch]
        kinds[resets[begin : begin + _STRETCH + 2]] = RESET
        size = min(_STRETCH, len(points) - begin)
        symbols = _symbols(stretch, kinds)[:size]
        after = _states(numbers[symbols], state)
        before = np.concatenate([np.array([state], np.uint8), after[:-1]])
        found.append(np.flatnonzero(starts[before, symbols]) + begin)
        state = int(after[-1])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank is joined, the leftmost first, until none is known."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n > 48:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(n)]
    known = [ranks.get(piece[i : i + 2], _NONE) for i in range(n - 1)]
    while known:
        best = min(known)
        if best == _NONE:
            break
        i = known.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del known[i]
        if i < len(known):
            known[i] = ranks.get(parts[i] + parts[i + 1], _NONE)
        if i:
            known[i - 1] = ranks.get(parts[i - 1] + parts[i], _NONE)
    return [ranks[p] for p in parts]


_NONE = 1 << 62


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs and linked neighbours, for pre-tokens of any length."""
    n = len(piece)
    ends = list(range(1, n + 1))  # of the part that starts here; 0: joined to an earlier one
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = ends[i]
        if not middle or middle >= end or ends[middle] != end:
            continue  # one of the two has grown since
        ends[middle] = 0
        ends[i] = end
        if end < n:
            before[end] = i
            rank = ranks.get(piece[i : ends[end]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, ends[end]))
        if before[i] >= 0:
            rank = ranks.get(piece[before[i] : end])
            if rank is not None:
                heapq.heappush(heap, (rank, before[i], end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return out


class Pieces(dict):
    """Packed ids of each pre-token, remembered up to a bound."""

    LIMIT, LONGEST = 400_000, 64

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= self.LIMIT:
            self.clear()
        packed = np.array(merge(piece, self.ranks), np.int32).tobytes()
        if len(piece) <= self.LONGEST:
            self[piece] = packed
        return packed


class Vocabulary:
    """Ranks of a public vocabulary, the bytes of every id in one array, and the cache of pre-tokens."""

    def __init__(self, ranks_path: str) -> None:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        tokens = sorted((number, token) for token, number in ranks.items())
        size = tokens[-1][0] + 1
        self.lengths = np.zeros(size, np.int64)
        self.lengths[[number for number, _ in tokens]] = [len(token) for _, token in tokens]
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(token for _, token in tokens), np.uint8)
        self.pieces = Pieces(ranks)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, the byte of its text at which each starts, and the number of ids of every text."""
        joined = "\n".join(texts) + "\n"
        raw = joined.encode()
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1  # separators
        starts = starts_of(points, ends)
        width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        at = np.cumsum(width, dtype=np.int64) - width  # byte of every code point
        bytes_from = at[starts]
        last_of = np.searchsorted(starts, ends)  # pre-tokens before each separator
        bytes_to = np.empty(len(starts), np.int64)
        bytes_to[:-1] = bytes_from[1:]
        filled = last_of > np.concatenate([[0], last_of[:-1]])
        bytes_to[last_of[filled] - 1] = at[ends[filled]]
        packed = list(map(self.pieces.__getitem__, [raw[a:b] for a, b in zip(bytes_from.tolist(), bytes_to.tolist())]))
        ids = np.frombuffer(b"".join(packed), np.int32)
        total = np.concatenate([[0], np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed)) // 4)])
        counts = np.diff(total[np.concatenate([[0], last_of])])
        lengths = self.lengths[ids]
        offsets = np.cumsum(lengths) - lengths
        text_bytes = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts) - counts]  # before each text
        return ids, (offsets - np.repeat(text_bytes, counts)).astype(np.int32), counts

    def decode(self, ids: np.ndarray, places: np.ndarray, size: int) -> bytes:
        """``size`` bytes with the bytes of every id at its place."""
        lengths = self.lengths[ids]
        inner = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out = np.zeros(size, np.uint8)
        out[np.repeat(places, lengths) + inner] = self.flat[np.repeat(self.begins[ids], lengths) + inner]
        return out.tobytes()


@functools.cache
def vocabulary_of(ranks_path: str) -> Vocabulary:
    """One per Python worker."""
    return Vocabulary(ranks_path)


def encode_documents(
    documents: DataFrame, ranks_path: str, block_chars: int = 1_000_000, decoded: bool = False
) -> DataFrame:
    """doc_id, ids, offsets (the byte of the text at which each id starts) for every row of ``documents``.

    With ``decoded`` also the bytes that the ids stand for, put together from the vocabulary on the same way.
    """
    names = ["doc_id", "ids", "offsets", *(["decoded"] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(ranks_path)

        def encoded(ids: list, texts: list[str]) -> pa.RecordBatch:
            flat, offsets, counts = vocabulary.encode(texts)
            ends = np.cumsum(counts)
            bounds = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            columns = [pa.ListArray.from_arrays(bounds, pa.array(values)) for values in (flat, offsets)]
            if decoded:
                sizes = np.zeros(len(counts), np.int64)  # the last id of a text ends where the text does
                filled = counts > 0
                last = ends[filled] - 1
                sizes[filled] = offsets[last] + vocabulary.lengths[flat[last]]
                text_ends = np.cumsum(sizes)
                places = np.repeat(text_ends - sizes, counts) + offsets
                raw = vocabulary.decode(flat, places, int(sizes.sum()))
                text_bounds = np.concatenate([[0], text_ends]).astype(np.int32)
                columns.append(pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(text_bounds), pa.py_buffer(raw)]))
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *columns], names)

        ids, texts, chars = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py())
                chars += len(texts[-1]) + 1
                if chars >= block_chars:
                    yield encoded(ids, texts)
                    ids, texts, chars = [], [], 0
        if ids:
            yield encoded(ids, texts)

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return in_python(texts, run, f"doc_id long, ids array<int>, offsets array<int>{', decoded binary' if decoded else ''}")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The rows of ``encode_documents`` (doc_id, ids, offsets) with the bytes that their ids stand for: ``decoded``.

    Stretches of ids may be handed in as well; bytes come from the first id's offset on. Null ids: null bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(ranks_path)
        for batch in batches:
            decoded = []
            for ids, offsets in zip(batch.column(1), batch.column(2)):
                if not ids.is_valid or not offsets.is_valid:
                    decoded.append(None)
                    continue
                ids, places = (x.values.to_numpy().astype(np.int64) for x in (ids, offsets))
                if len(ids):
                    places = places - places[0]
                    size = int(places[-1] + vocabulary.lengths[ids[-1]])
                    decoded.append(vocabulary.decode(ids, places, size))
                else:
                    decoded.append(b"")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(decoded, pa.binary())], ["doc_id", "ids", "offsets", "decoded"]
            )

    columns = encoded.select("doc_id", "ids", "offsets")
    return in_python(columns, run, "doc_id long, ids array<int>, offsets array<int>, decoded binary")
