"""Quality scores by Bradley-Terry ranking.

Text features of labelled documents are compared in pairs of a good and a bad one: the probability that
the good one wins is the logistic function of the difference of two linear scores. The weights minimise the
logistic loss of the feature differences. The decision point is the quantile of the labelled scores at the
share of bad labels; scores are mapped so that it lands on ``decision``.

* Fitting: all labelled rows outside the held-out fold, and all pairs of them. A pair enters the loss through the difference
  of two scores only, so the tasks add up masses and features on a fine grid of scores, per label, and the driver meets the two
  grids; a Newton step is two passes over the features. Each score is spread over four grid points (cubic
  interpolation, ``_GRID`` apart), which is exact to about 1e-8 of a pair's share. The quantile is exact.
* Moves: the features (14 numbers a document), written once; texts are read once and stay. The driver holds grids, no rows.
* Ids select rows and folds only; they, language, source and labels are no features.
* Null text: empty, scored as such. Null id: not held out, not learned from. Rows repeated in either table: the least label
  and the least features per id are used, all documents are scored. Without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from custodia.llm.common import WordHashes, in_python, stored
from custodia.llm.line_rules import SYMBOLS, repeated_words

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_MARKS = b".,;:!?"
#: How many ``features`` give.
FEATURES = 14
#: Distance of the grid points that scores are spread over.
_GRID = 1 / 32


def _share(raw: bytes, of: bytes) -> float:
    return (len(raw) - len(raw.translate(None, of))) / max(len(raw), 1)


def features(text: str, hashes: WordHashes) -> list[float]:
    """What a reader sees of form: length, variety, repetition, capitals, symbols, punctuation, lines."""
    raw = text.encode()
    words = raw.split()
    n = max(len(words), 1)
    values = hashes.of(words)
    _, counts = np.unique(values, return_counts=True)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    upper, lower = _share(raw, _UPPER), _share(raw, _LOWER)
    top = int(counts.max()) if len(words) else 0
    return [
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        len(counts) / n,
        top / n,
        float((values[1:] == values[:-1]).sum()) / n if len(words) > 1 else 0.0,
        repeated_words(values) / n,
        upper / max(upper + lower, 1e-9),
        _share(raw, SYMBOLS),
        _share(raw, _DIGITS),
        _share(raw, _MARKS),
        raw.count(b"!") / n,
        sum(1 for w in words if len(w) == 1 and not w.isalnum()) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        float(np.log1p(n / max(len(lines), 1))),
    ]


def expanded(x: np.ndarray) -> np.ndarray:
    """Standardised features with soft steps for the far ends."""
    return np.concatenate([x, np.tanh(x), np.tanh(x * x / 4)], axis=1)


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    decision: float

    def wide(self, x: np.ndarray) -> np.ndarray:
        return expanded(np.clip((x - self.mean) / self.scale, -8, 8))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.wide(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        shift = np.log(self.decision / (1 - self.decision))
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.cut + shift, -30, 30)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), FEATURES)


def _settled(x: np.ndarray, digits: int = 9) -> np.ndarray:
    """Rounded to so many digits, so that the order in which tasks add up does not show in the scores."""
    size = 10.0 ** (digits - 1 - np.floor(np.log10(np.maximum(np.abs(x), 1e-12))))
    return np.round(x * size) / size


def on_grid(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The four grid points around each score, and its shares in them."""
    at = scores / _GRID
    first = np.floor(at)
    t = at - first
    shares = [-t * (t - 1) * (t - 2) / 6, (t + 1) * (t - 1) * (t - 2) / 2, -(t + 1) * t * (t - 2) / 2, (t + 1) * t * (t - 1) / 6]
    return first.astype(np.int64)[:, None] + np.arange(-1, 3), np.stack(shares, axis=1)


class GridSums:
    """Sums of rows on the grid points they fall on."""

    def __init__(self, columns: int) -> None:
        self.points, self.sums = np.zeros(0, np.int64), np.zeros((0, columns))

    def add(self, points: np.ndarray, shares: np.ndarray, rows: np.ndarray) -> None:
        found, place = np.unique(points, return_inverse=True)
        place = place.reshape(points.shape)
        new = np.zeros((len(found), rows.shape[1]))
        for k in range(points.shape[1]):
            for c in range(rows.shape[1]):
                new[:, c] += np.bincount(place[:, k], shares[:, k] * rows[:, c], len(found))
        both = np.union1d(self.points, found)
        sums = np.zeros((len(both), rows.shape[1]))
        sums[np.searchsorted(both, self.points)] = self.sums
        sums[np.searchsorted(both, found)] += new
        self.points, self.sums = both, sums


def grid_sums(labelled: DataFrame, model: Ranker) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per label the occupied grid points, in order, and on each the mass and the features of all its rows."""
    width = len(model.weights) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {0: GridSums(width), 1: GridSums(width)}
        for batch in batches:
            label, wide = batch.column(0).to_numpy(), model.wide(_vectors(batch.column(1)))
            points, shares = on_grid(wide @ model.weights)
            rows = np.concatenate([np.ones((len(wide), 1)), wide], axis=1)
            for kind, own in sums.items():
                if (label == kind).any():
                    own.add(points[label == kind], shares[label == kind], rows[label == kind])
        for kind, own in sums.items():
            columns = [pa.array(np.full(len(own.points), kind)), pa.array(own.points), *map(pa.array, own.sums.T.copy())]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["label", "point", *[f"s{i}" for i in range(width)]]
    schema = "label long, point long, " + ", ".join(f"s{i} double" for i in range(width))
    found = in_python(labelled, run, schema).groupBy("label", "point").agg(*[F.sum(n).alias(n) for n in names[2:]]).toPandas()
    out = {}
    for kind in (0, 1):
        own = found[found["label"] == kind].sort_values("point")
        out[kind] = own["point"].to_numpy(), own[names[2:]].to_numpy()
    return out


def second_moments(labelled: DataFrame, model: Ranker, weight: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sum of the outer products of all rows' features, each with the weight of its score among those of its label."""
    size = len(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            label, wide = batch.column(0).to_numpy(), model.wide(_vectors(batch.column(1)))
            points, shares = on_grid(wide @ model.weights)
            for kind, (known, of) in weight.items():
                own = label == kind
                place = np.minimum(np.searchsorted(known, points[own]), len(known) - 1)
                each = (of[place] * shares[own]).sum(axis=1)
                total += (wide[own].T * each) @ wide[own]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.reshape(-1))], ["place", "total"])

    found = in_python(labelled, run, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).toPandas()
    return found.sort_values("place")["total"].to_numpy().reshape(size, size)


def pair_sums(good: tuple[np.ndarray, np.ndarray], bad: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, dict]:
    """Over all pairs: sum of p times the difference of features, p the probability that the bad one wins; the cross
    products weighted with p (1 - p); and that weight of a row summed over all rows of the other label, by grid point."""
    (at_good, sums_good), (at_bad, sums_bad) = good, bad
    size = sums_good.shape[1] - 1
    slope, cross, weight_good, weight_bad = np.zeros(size), np.zeros((size, size)), np.zeros(len(at_good)), np.zeros(len(at_bad))
    for i in range(0, len(at_good), 512):
        own = slice(i, i + 512)
        p = 1 / (1 + np.exp(np.clip((at_good[own, None] - at_bad) * _GRID, -30, 30)))
        slope += (p @ sums_bad[:, 0]) @ sums_good[own, 1:] - (sums_good[own, 0] @ p) @ sums_bad[:, 1:]
        p *= 1 - p
        cross += sums_good[own, 1:].T @ p @ sums_bad[:, 1:]
        weight_good[own] = p @ sums_bad[:, 0]
        weight_bad += sums_good[own, 0] @ p
    return slope, cross, {1: (at_good, weight_good), 0: (at_bad, weight_bad)}


def neighbours(values: DataFrame, rank: int) -> tuple[float, float]:
    """The values of column ``value`` at ``rank`` - 1 and ``rank``, in order and from 0, by counting in ever narrower ranges."""
    value = F.col("value")
    low, high = values.agg(F.min(value), F.max(value)).first()
    while low < high:
        part = F.floor((value - low) / (high - low) * 1000)
        parts: list[Row] = (
            values.where(value.between(low, high)).groupBy(part.alias("part"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min(value).alias("least"), F.max(value).alias("most")).orderBy("part").collect()
        )
        before = values.where(value < low).count()
        for i, own in enumerate(parts):
            if rank < before + own.rows:
                break
            before += own.rows
        if rank == before:
            return parts[i - 1].most, own.least
        low, high = own.least, own.most
    return low, high


def fit(labelled: DataFrame, decision: float, penalty: float = 1e-3) -> Ranker | None:
    """Newton's method on the logistic loss of the feature differences of all pairs; ``labelled``: label, x."""
    stats = labelled.agg(
        F.count_if(F.col("label") == 1).alias("good"),
        F.count_if(F.col("label") == 0).alias("bad"),
        *[f(F.get("x", F.lit(i))).alias(f"{n}{i}") for n, f in (("mean", F.avg), ("scale", F.stddev_pop)) for i in range(FEATURES)],
    ).first()
    if not stats.good or not stats.bad:
        return None
    mean, scale = (_settled(np.array([stats[f"{n}{i}"] for i in range(FEATURES)])) for n in ("mean", "scale"))
    pairs = stats.good * stats.bad
    at = lambda w, cut: Ranker(mean, np.maximum(scale, 1e-6), w, cut, decision)
    w = np.zeros(expanded(mean[None]).shape[1])
    for _ in range(25):
        sums = grid_sums(labelled, at(w, 0.0))
        slope, cross, weight = pair_sums(sums[1], sums[0])
        gradient = -slope / pairs + penalty * w
        curvature = (second_moments(labelled, at(w, 0.0), weight) - cross - cross.T) / pairs + penalty * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    model = at(_settled(w, 7), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(_vectors(batch.column(1))))], ["value"])

    raw = stored(in_python(labelled, run, "value double"), "quality-raw")
    return at(model.weights, sum(neighbours(raw, stats.bad)) / 2)


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, held_out and the features of every whole text, as ``x``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column(2)
            found = [features(texts[i].as_py(), hashes) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "held_out", "x"]
            )

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return in_python(texts, run, "doc_id long, held_out boolean, x array<double>")


def labelled_features(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """label, x of every labelled id outside the held-out fold."""
    label = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("label"))
    )
    own = rows.where(F.col("doc_id").isNotNull() & ~F.col("held_out")).groupBy("doc_id").agg(F.min("x").alias("x"))
    return own.join(label, "doc_id").select("label", "x")


def rank_quality(documents: DataFrame, labels: DataFrame, decision: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    rows = stored(measured(documents), "quality-features")
    model = fit(stored(labelled_features(rows, labels), "quality-labelled"), decision)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(_vectors(batch.column(2))) if model else np.full(len(batch), 0.5)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array((scores >= decision).astype(np.int32)),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return in_python(rows, run, "doc_id long, held_out boolean, score double, predicted int")
