"""License notices by MinHash bands over overlapping text windows, verified by exact shingle containment.

Templates and texts are words in lower case without outer punctuation; shingles are five words. A template of ``m``
shingles belongs to the smallest stride 2, 4, 8, ... that holds it, and is looked for in windows of two strides,
one every stride, so an occurrence always lies whole in a window. A window retrieves a template if any of ``bands``
MinHash values agree; the number of bands is set so that the least similar window that may match is still
retrieved with probability ``certain``. A retrieved window matches where a stretch of it holds at least ``containment``
of the template's shingles; the tightest such stretch is the span, so a neighbouring notice that shares shingles stays
outside it, and what lies before and after is searched again.

* Templates are a table of wordings, ``license_texts`` if none is given; its size is checked, as all of it goes with the
  code. Of wordings that overlap in a text the one most like the stretch that holds it counts, the longest of equals,
  which tells versions apart. Texts are read whole where they lie, in stretches of bounded
  length that overlap by a window, and nothing is shuffled.
* Null text: empty, no licenses. Repeated rows and null ids are scanned and returned as they are; empty tables give no
  rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import WordHashes, in_python, mixed, windows
from custodia.llm.license_texts import TEMPLATES

SHINGLE = 5
_OUTER = b".,;:!?()[]{}<>\"'`*#/|-_"
_STRETCH = 1 << 15
#: A shingle at the end of a span may lie behind so many places that are not the template's.
_STRAY = 4

def normal_words(text: str) -> list[bytes]:
    return [w for w in (x.strip(_OUTER) for x in text.encode().lower().split()) if w]


def stride_of(shingles: int) -> int:
    return max(2, 1 << (shingles - 1).bit_length())


def least_similarity(shingles: int, containment: float) -> float:
    """Jaccard similarity of a template and the worst window that still holds enough of it."""
    held = math.ceil(containment * shingles - 1e-9)
    return held / (2 * stride_of(shingles) + shingles - held)


def bands_for(sizes: list[int], containment: float, certain: float) -> int:
    worst = min(least_similarity(n, containment) for n in sizes)
    return math.ceil(math.log(1 - certain) / math.log(1 - worst))


def tightest(places: np.ndarray, values: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(first place, last place, distinct values) of the stretches that hold ``least`` distinct values.

    From the shortest stretch with all the values there are, each end moves to where ``_STRAY`` times the distinct values
    less the strange places are most, while enough values stay; then the same before and after it.
    """
    out: list[tuple[int, int, int]] = []
    todo = [(0, len(places))]
    while todo:
        low, high = todo.pop()
        distinct = len(np.unique(values[low:high]))
        if distinct < max(least, 1):
            continue
        a, b = _shortest(places, values, low, high, distinct)
        before = None
        while before != (a, b):
            before = (a, b)
            b = a + _best_end(places[a:high], values[a:high], least)
            a = b - _best_end(-places[low:b][::-1], values[low:b][::-1], least)
        out.append((int(places[a]), int(places[b - 1]), len(np.unique(values[a:b]))))
        todo += [(low, a), (b, high)]
    return sorted(out)


def _shortest(places: np.ndarray, values: np.ndarray, low: int, high: int, distinct: int) -> tuple[int, int]:
    """Bounds of the shortest stretch that holds so many distinct values; the first one at a tie."""
    counts: dict[int, int] = {}
    best, a = (low, high), low
    keys = values.tolist()
    for b in range(low, high):
        counts[keys[b]] = counts.get(keys[b], 0) + 1
        while len(counts) == distinct:
            if places[b] - places[a] < places[best[1] - 1] - places[best[0]]:
                best = (a, b + 1)
            counts[keys[a]] -= 1
            if not counts[keys[a]]:
                del counts[keys[a]]
            a += 1
    return best


def _best_end(places: np.ndarray, values: np.ndarray, least: int) -> int:
    """How many of the first places to take, so that ``_STRAY`` times the distinct values less the strange places are most."""
    fresh = np.zeros(len(values), np.int64)
    fresh[np.unique(values, return_index=True)[1]] = 1
    distinct = np.cumsum(fresh)
    strange = places - places[0] - np.arange(len(places))
    score = np.where(distinct >= least, _STRAY * distinct - strange, np.iinfo(np.int64).min)
    return int(np.argmax(score)) + 1


@dataclass(frozen=True)
class Library:
    """Templates by stride, with the multipliers of the bands and each template's band values."""

    names: list[str]
    shingles: list[np.ndarray]
    factors: np.ndarray
    offsets: np.ndarray
    by_stride: dict[int, tuple[list[int], np.ndarray]]
    containment: float

    @staticmethod
    def of(templates, containment: float, certain: float) -> Library:
        hashes = WordHashes()
        sets = [np.unique(windows(hashes.of(normal_words(t)), SHINGLE)) for _, t in templates]
        bands = bands_for([len(s) for s in sets], containment, certain)
        factors = mixed(np.arange(1, bands + 1, dtype=np.uint64)) | np.uint64(1)
        offsets = mixed(np.arange(1001, 1001 + bands, dtype=np.uint64))
        strides: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            strides.setdefault(stride_of(len(s)), []).append(i)
        by_stride = {
            stride: (found, np.array([(sets[i][:, None] * factors + offsets).min(axis=0) for i in found]))
            for stride, found in sorted(strides.items())
        }
        return Library([n for n, _ in templates], sets, factors, offsets, by_stride, containment)

    def matches(self, text: str, hashes: WordHashes) -> list[tuple[int, int, int, float]]:
        """(template, first word, end word, containment) of verified windows; the best one where several overlap."""
        shingles = windows(hashes.of(normal_words(text)), SHINGLE)
        reach = 2 * max(self.by_stride)
        found: dict[tuple[int, int, int], float] = {}
        for start in range(0, max(len(shingles), 1), _STRETCH):
            part = shingles[start : start + _STRETCH + reach]
            for template, at, stride in self._retrieved(part):
                window = part[at : at + 2 * stride]
                wanted = self.shingles[template]
                held = np.flatnonzero(np.isin(window, wanted))
                least = math.ceil(self.containment * len(wanted) - 1e-9)
                for low, high, count in tightest(held, window[held], least):
                    found[template, start + at + low, start + at + high + SHINGLE] = count / len(wanted)
        best: list[tuple[int, int, int, float]] = []

        def fit(match: tuple) -> tuple:
            """Likeness of the wording and the stretch that holds it, then the wording's length."""
            (template, first, end), share = match
            size, stretch = len(self.shingles[template]), end - first - SHINGLE + 1
            return -(share * size) / (size + stretch - share * size), -size, match[0]

        for (template, first, end), share in sorted(found.items(), key=fit):
            if not any(first < e and f < end for _, f, e, _ in best):
                best.append((template, first, end, share))
        return sorted(best, key=lambda m: (m[1], m[0]))

    def _retrieved(self, shingles: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(template, window start, stride) where a band agrees."""
        if not len(shingles):
            return
        values = shingles[:, None] * self.factors + self.offsets
        top = np.uint64(2**64 - 1)
        stride, blocks = 1, values
        for wanted, (templates, signatures) in self.by_stride.items():
            while stride < wanted:
                if len(blocks) % 2:
                    blocks = np.concatenate([blocks, np.full((1, blocks.shape[1]), top)])
                blocks = np.minimum(blocks[0::2], blocks[1::2])
                stride *= 2
            least = blocks.copy()
            least[:-1] = np.minimum(blocks[:-1], blocks[1:])
            for template, signature in zip(templates, signatures):
                for window in np.flatnonzero((least == signature).any(axis=1)).tolist():
                    yield template, window * stride, stride


def listed(templates: DataFrame, most_characters: int = 20_000_000) -> tuple[tuple[str, str], ...]:
    """The rows of a table of (license, wording), which must fit a task; wordings without a word are left out."""
    wanted = templates.select("license", "wording").where("license IS NOT NULL AND wording IS NOT NULL")
    total = wanted.agg(F.sum(F.length("wording"))).first()[0] or 0
    if total > most_characters:
        raise ValueError(f"templates of {total} characters; at most {most_characters} go with the code")
    return tuple(sorted((n, w) for n, w in map(tuple, wanted.distinct().collect()) if normal_words(w)))


def scan_licenses(
    documents: DataFrame, templates=TEMPLATES, containment: float = 0.75, certain: float = 0.999
) -> DataFrame:
    """doc_id, licenses (distinct, sorted), n_matches, best containment, and spans as name:first word:end word.

    ``templates``: pairs of license and wording, or a table of them.
    """
    if isinstance(templates, DataFrame):
        templates = listed(templates)
    library = Library.of(templates, containment, certain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column(1)
            found = [library.matches(texts[i].as_py(), hashes) for i in range(len(texts))]
            names = [[library.names[t] for t, *_ in f] for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([",".join(sorted(set(n))) for n in names], pa.string()),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([max((m[3] for m in f), default=0.0) for f in found], pa.float64()),
                    pa.array([",".join(f"{n}:{m[1]}:{m[2]}" for n, m in zip(ns, f)) for ns, f in zip(names, found)], pa.string()),
                ],
                ["doc_id", "licenses", "n_matches", "containment", "spans"],
            )

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return in_python(texts, run, "doc_id long, licenses string, n_matches long, containment double, spans string")
