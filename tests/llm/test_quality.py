"""Line rules against a plain loop; the ranker against held-out labels."""

import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from custodia.llm.line_rules import judge_lines
from custodia.llm.quality_ranker import FEATURES, expanded, fit, neighbours, rank_quality
from custodia.llm.queries import QUERIES
from tests.llm.helpers import ROWS, clashing, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    words = WORD.findall(text)
    n = len(words)
    at = defaultdict(list)
    for i in range(n - 7):
        at[tuple(words[i : i + 8])].append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered))


def normal(line):
    return " ".join("".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(line))


def frequent_lines(rows, few, share):
    """Per host the lines of more than ``few`` and more than ``share`` of its distinct texts."""
    texts = defaultdict(set)
    for _, text, source in rows:
        texts[source or ""].add(text or "")
    frequent = {}
    for host, own in texts.items():
        holders = defaultdict(int)
        for text in own:
            for line in {normal(x) for x in text.split("\n")} - {""}:
                holders[line] += 1
        frequent[host] = {x for x, c in holders.items() if c > max(few, share * len(own))}
    return frequent


def judged(rows, few=3, share=0.05, depleted=0.8):
    """(doc_id, counts, base_failed, kept, removed) of (doc_id, text, source) rows."""
    frequent = frequent_lines(rows, few, share)
    out = []
    for doc_id, text, source in rows:
        counts = measured(text or "")
        n = counts[0]
        removed = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if normal(x) in frequent[source or ""])
        failed = n < 20 or 100 * counts[4] > 30 * n
        out.append((doc_id, *counts, failed, not failed and not removed > depleted * n, removed))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


def test_line_rules(spark):
    shared = "the same  LINE of boilerplate words that every page of this host shows to its readers again and again today"
    more = [(100 + i, f"{shared}\nown words {i}" if i % 2 else f"{shared.lower()}\n" + " ".join(f"w{i}x{k}" for k in range(60)), "en", "h", 0) for i in range(30)]
    rows = [*ROWS, *more, *[(200 + i, more[0][1], "en", "z", 0) for i in range(30)]]
    got = judge_lines(clashing(documents(spark, rows), "host", "line", "lines", "removed_words"), few=5, share=0.1)
    got = sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr)
    assert got == judged([(r[0], r[1], r[3]) for r in rows], 5, 0.1)
    assert any(not r[7] and not r[6] for r in got)


def test_blank_documents_count_as_documents(spark):
    """Ten pages of a thousand with a menu: no habit of the host, though the others hold no line of words."""
    menu = [(i, f"Menu of the page\n{' '.join(f'w{i}x{k}' for k in range(30))}", "en", "h", 0) for i in range(10)]
    blank = [(100 + i, " " * i + "\n", "en", "h", 0) for i in range(1000)]
    for rows, removed in ((menu + blank, 0), (menu + blank[:150], 40)):
        got = judge_lines(documents(spark, rows)).collect()
        assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr) == judged([(r[0], r[1], r[3]) for r in rows])
        assert sum(r.removed_words for r in got) == removed


def test_the_rule_is_the_same_at_every_size(spark):
    """A line of a tenth of the pages goes from a host of 50 and from one of 500; one of three pages stays."""
    page = lambda i, line: f"{line}\n{' '.join(f'w{i}x{k}' for k in range(25))}"
    rows = []
    for host, n in (("small", 50), ("large", 500)):
        for i in range(n):
            rows.append((len(rows), page(f"{host}{i}", "often seen here" if i % 10 == 0 else "only thrice" if i in (1, 2, 3) else "own " + str(i)), "en", host, 0))
    got = {r.doc_id: r.removed_words for r in judge_lines(documents(spark, rows)).collect()}
    assert {r[0] for r in rows if got[r[0]]} == {r[0] for r in rows if r[1].startswith("often")}


def test_empty(spark):
    assert judge_lines(documents(spark, [])).count() == 0


def test_line_rules_of_the_table(spark):
    base = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{base}/documents.parquet").collect()]
    got = sorted((tuple(r[c] for c in COLUMNS) for r in QUERIES["op7_line_frequency"](spark, base).collect()), key=repr)
    assert got == judged(rows)
    assert sum(r[-1] > 0 for r in got) > 50  # lines of many hosts are taken out


def test_ranker_on_held_out_labels(spark):
    base = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{base}/labels.parquet").collect()}
    got = QUERIES["op2_pairwise_quality"](spark, base).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out and labels.get(r.doc_id) is not None]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_ranker_takes_awkward_rows(spark):
    df = clashing(documents(spark), "label", "x", "score")
    labels = spark.createDataFrame([(1, 1, 0), (13, 0, 0), (13, 1, 0), (None, 1, 1), (5, None, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    got = rank_quality(df, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    none = labels.where(F.lit(False))
    assert {r.score for r in rank_quality(df, none).collect()} == {0.5}
    assert rank_quality(documents(spark, []), labels).count() == 0


def test_scores_ignore_all_but_the_text(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    by_text = defaultdict(set)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rank_quality(docs, labels).collect():
        by_text[texts[r.doc_id]].add(r.score)
    assert all(len(s) == 1 for s in by_text.values())


def test_fit_takes_all_rows_and_all_pairs(spark):
    """Weights and decision point as from a plain loop over every pair of a good and a bad row."""
    rng = np.random.default_rng(3)
    label = rng.choice([0, 1, 2], 400, p=[0.3, 0.6, 0.1])
    x = rng.normal(size=(400, FEATURES)) + 0.6 * (label == 1)[:, None] * (np.arange(FEATURES) % 3 == 0)
    x[::7] = x[3]  # repeated rows
    model = fit(spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(label, x)], "label int, x array<double>"), 0.7)

    wide = expanded(np.clip((x - x.mean(axis=0)) / x.std(axis=0), -8, 8))
    d = (wide[label == 1][:, None] - wide[label == 0][None]).reshape(-1, wide.shape[1])
    w = np.zeros(d.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(d @ w))
        curvature = (d.T * (p * (1 - p))) @ d / len(d) + 1e-3 * np.eye(len(w))
        w -= np.linalg.solve(curvature, -(d.T @ p) / len(d) + 1e-3 * w)
    raw, bad = np.sort(wide @ w), int((label == 0).sum())
    assert np.abs(model.weights - w).max() < 1e-5
    assert abs(model.cut - (raw[bad - 1] + raw[bad]) / 2) < 1e-4


def test_every_labelled_row_counts(spark):
    """More rows than any sample held before, all but one alike: the odd one moves the mean."""
    rows = spark.range(30_000).selectExpr("CAST(id % 2 AS INT) AS label", f"array_repeat(CAST(id % 2 AS DOUBLE), {FEATURES}) AS x")
    odd = spark.range(1).selectExpr("1 AS label", f"array_repeat(30001D, {FEATURES}) AS x")
    assert np.allclose(fit(rows.union(odd), 0.7).mean, (15_000 + 30_001) / 30_001)


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.normal(size=500), np.full(40, 0.25), 1e9 + rng.random(30), [-1e12]])
    df = spark.createDataFrame([(float(v),) for v in values], "value double").cache()
    values.sort()
    at = int(np.searchsorted(values, 0.25))
    for rank in (1, at, at + 1, at + 39, at + 40, 545, len(values) - 1):
        assert neighbours(df, rank) == (values[rank - 1], values[rank])
    df.unpersist()
