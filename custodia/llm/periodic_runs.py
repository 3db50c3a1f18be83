"""Periodic runs of words: maximal pairs of the LCP-interval tree whose distance satisfies the length constraints.

A run of period q that starts at word s and has length L is exactly a maximal pair (s, s + q): the L - q words from s on
equal those from s + q on, the words before differ and the words after differ (the text's ends differ from everything).
So no candidate is extended. All such pairs come from one bottom-up walk over the LCP intervals of a text's suffix array.
Suffixes that meet first in an interval of LCP l have exactly l words in common (right-maximal); the positions of a
subtree are kept in order and cut into blocks of one left word, so only pairs with different left words are looked at
(left-maximal). Distances beyond l give no run and are cut off by the order. Smaller lists are put into larger ones.

A pair of any multiple of the smallest period describes the same stretch; the smallest one is kept per stretch. Runs and
their multiples number no more than a few per word, so the work is about n log n for any text, hot words included.

* Intervals of fewer than ``least / 2`` words cannot hold a run of ``least`` words. Texts without a repeated window of that
  many words (by 64-bit hashes, equal windows have equal hashes) are settled without the tree. All else is exact: words
  are numbered, not hashed. A text with repeats takes about 150 bytes per word while it is worked on.
* Words are ``[^\\x20\\x09-\\x0D]+``. Null text: no words, no runs, an empty collapsed text. Empty tables give no rows; repeated
  rows and null ids are kept as they come. Columns other than doc_id and text are not read.
* Row-local: nothing is shuffled, no group is gathered, a lost task is simply run again.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import in_python, windows, word_hashes


def suffix_order(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of numbered words and the LCP of every suffix with the one before it.

    Windows of 1, 2, 4, ... words are named until all names differ; the LCP is put together from the same names.
    """
    n = len(codes)
    names = [np.unique(codes, return_inverse=True)[1].astype(np.int64)]
    width = 1
    while names[-1].max() < n - 1:
        second = np.zeros(n, np.int64)
        second[: max(n - width, 0)] = names[-1][width:] + 1
        names.append(np.unique(names[-1] * (n + 1) + second, return_inverse=True)[1].astype(np.int64))
        width *= 2
    order = np.empty(n, np.int64)
    order[names[-1]] = np.arange(n)
    common = np.zeros(n, np.int64)
    left, right = order[:-1].copy(), order[1:].copy()
    for level in range(len(names) - 2, -1, -1):
        padded = np.concatenate([names[level], [-1]])
        equal = padded[left] == padded[right]
        step = equal.astype(np.int64) << level
        common[1:] += step
        left += step
        right += step
    return order, common


class Positions:
    """Positions of a subtree in order, and the heads of their blocks: neighbours with the same left word."""

    __slots__ = ("all", "heads")

    def __init__(self, position: int) -> None:
        self.all = [position]
        self.heads = [position]

    def add(self, x: int, left: list[int]) -> None:
        places, heads = self.all, self.heads
        at = bisect_left(places, x)
        word = left[x]
        new_head = not at or left[places[at - 1]] != word
        if at < len(places):
            after = places[at]
            k = bisect_left(heads, after)
            is_head = k < len(heads) and heads[k] == after
            if left[after] == word:
                if is_head:
                    del heads[k]
            elif not is_head:
                heads.insert(k, after)
        places.insert(at, x)
        if new_head:
            insort(heads, x)

    def others(self, x: int, reach: int, left: list[int]) -> Iterator[int]:
        """Positions at most ``reach`` away whose left word differs from that of ``x``. Every other block has some."""
        places, heads = self.all, self.heads
        low, high, word = x - reach, x + reach, left[x]
        k = max(bisect_right(heads, low) - 1, 0)
        size = len(heads)
        while k < size and heads[k] <= high:
            head = heads[k]
            k += 1
            if left[head] != word:
                until = min(heads[k] - 1, high) if k < size else high
                at = bisect_left(places, max(head, low))
                while at < len(places) and places[at] <= until:
                    yield places[at]
                    at += 1


def find_runs(codes: np.ndarray, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run of at least ``least`` words and two periods, in order."""
    n = len(codes)
    if n < max(least, 2):
        return []
    order, common = (x.tolist() for x in suffix_order(codes))
    left = [-1, *codes[:-1].tolist()]
    shortest = -(-least // 2)
    found: dict[tuple[int, int], int] = {}

    def joined(one: Positions, two: Positions, depth: int) -> Positions:
        """Take two children of an interval together, with the runs that their pairs are."""
        small, large = (one, two) if len(one.all) < len(two.all) else (two, one)
        for x in small.all:
            for y in large.others(x, depth, left):
                period = abs(x - y)
                if period + depth >= least:
                    stretch = (min(x, y), depth + period)
                    if period < found.get(stretch, n):
                        found[stretch] = period
        for x in small.all:
            large.add(x, left)
        return large

    stack: list[tuple[int, Positions]] = []
    last = Positions(order[0])
    for i in range(1, n + 1):
        depth = common[i] if i < n else 0
        while stack and stack[-1][0] > depth:
            open_depth, group = stack.pop()
            last = joined(group, last, open_depth)
        if depth >= shortest:
            if stack and stack[-1][0] == depth:
                stack[-1] = (depth, joined(stack[-1][1], last, depth))
            else:
                stack.append((depth, last))
        if i < n:
            last = Positions(order[i])
    return sorted((start, length, period) for (start, length), period in found.items())


def runs_of(raw: bytes, words: list[bytes], least: int) -> list[tuple[int, int, int]]:
    if len(words) < least:
        return []
    hashed = np.sort(windows(word_hashes(raw), -(-least // 2)))
    if not (hashed[1:] == hashed[:-1]).any():
        return []
    number: dict[bytes, int] = {}
    return find_runs(np.array([number.setdefault(w, len(number)) for w in words], np.int64), least)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(documents: DataFrame, least: int = 12) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; in order) and collapsed text for every row of ``documents``."""
    run_type = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, texts = [], [], []
            for text in batch.column(1):
                raw = text.as_py().encode()
                words = raw.split()
                found = runs_of(raw, words, least)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                texts.append(collapsed(words, found).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, pa.list_(run_type)), pa.array(texts)],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return in_python(texts, run, schema)
