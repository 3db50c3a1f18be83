"""The Jaccard join against all pairs, with wide shingles, long chains, chunked groups and awkward rows."""

import random

import pytest

from custodia.llm import jaccard_join as jj
from custodia.llm.components import components
from custodia.llm.queries import QUERIES
from tests.llm.helpers import ROWS, clashing, documents


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def brute(rows, similarity=75):
    """Per row: size of its set, and the lowest id of its component."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and label[i] != label[j] and 100 * len(a & b) >= similarity * len(a | b):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    lowest = {}
    for (doc_id, _), x in zip(rows, label):
        if doc_id is not None:
            lowest[x] = min(lowest.get(x, doc_id), doc_id)
    return sorted(((d, len(s), lowest.get(x) if s else d) for (d, _), s, x in zip(rows, sets, label)), key=repr)


def check(spark, rows, **more):
    frame = documents(spark, [(d, t, "en", "a", 0) for d, t in rows])
    got = jj.jaccard_components(clashing(frame, "class", "n", "group", "first", "packed"), **more).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, more.get("similarity", 75))
    return got


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def corpus(seed):
    """Random texts, a cluster wider than narrow blocks, a chain, a passage in many texts, subsets and copies."""
    rng = random.Random(seed)
    text = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    passage = text(40)
    rows = [text(rng.randrange(1, 120)) for _ in range(60)]
    rows += [text(rng.randrange(10, 80)) + passage + text(rng.randrange(10, 80)) for _ in range(40)]
    base = text(150)
    rows += [edited(rng, base, rng.randrange(0, 6)) for _ in range(50)]
    link = text(100)
    for _ in range(12):
        rows.append(link)
        link = edited(rng, link, 2)
    rows += [base[: rng.randrange(100, 150)] for _ in range(10)] + [base, base, passage, passage[:30]]
    rng.shuffle(rows)
    return [(i * 3, " ".join(w).upper() if i % 5 == 0 else " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("more", [{}, {"group_shingles": 900, "region": 0.5}, {"region": 0.0, "similarity": 60}])
def test_against_all_pairs(spark, more):
    check(spark, corpus(len(more)), **more)


def brute_links(rows, similarity=75):
    sets = [shingles(t) for _, t in rows]
    counts = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= similarity * len(a | b):
                counts[i] += 1
                counts[j] += 1
    return sorted(((d, len(s), n) for (d, _), s, n in zip(rows, sets, counts)), key=repr)


@pytest.mark.parametrize("more", [{}, {"group_shingles": 900, "region": 0.5}, {"region": 0.0, "similarity": 60}])
def test_numbers_of_links(spark, more):
    """Also of a group of near copies that all link with each other, and of exact copies."""
    rows = corpus(7 + len(more)) + [(10_000 + r[0], r[1]) for r in corpus(7 + len(more))[:20]]
    frame = documents(spark, [(d, t, "en", "a", 0) for d, t in rows])
    got = jj.jaccard_components(clashing(frame, "class", "links", "documents", "side"), count_links=True, **more).collect()
    want = brute_links(rows, more.get("similarity", 75))
    assert sorted(((r.doc_id, r.n_shingles, r.n_links) for r in got), key=repr) == want and max(n for *_, n in want) > 40
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, more.get("similarity", 75))
    odd = jj.jaccard_components(documents(spark), count_links=True).select("doc_id", "n_shingles", "n_links")
    assert sorted(map(tuple, odd.collect()), key=repr) == brute_links([(r[0], r[1]) for r in ROWS])
    assert jj.jaccard_components(documents(spark, []), count_links=True).count() == 0


def test_awkward_rows(spark):
    check(spark, [(r[0], r[1]) for r in ROWS])
    assert jj.jaccard_components(documents(spark, [])).count() == 0


def test_first_of_each(spark):
    got = jj.first_of_each(clashing(documents(spark), "class")).collect()
    kept = sorted(((r.doc_id, r.text) for r in got), key=repr)
    assert [d for d, _ in kept].count(8) == 0 and (6, ROWS[5][1]) in kept
    assert {(2, ""), (3, None), (11, " \t\n ")} <= set(kept)
    assert len(kept) == len({r[:2] for r in ROWS}) - 2
    assert jj.first_of_each(documents(spark, [])).count() == 0


def test_table(spark, base):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{base}/documents.parquet").collect()]
    got = QUERIES["op4_signature_trees"](spark, base).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 103), (103, 101), (200, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_star_of_very_many_links(spark, monkeypatch):
    """One centre with 300,000 links and a chain to another star; rows of the hot keys go to many tasks."""
    from custodia.llm import common

    monkeypatch.setattr(common, "_HOT_ROWS", 5_000)
    star = spark.range(10, 300_000).selectExpr("5L AS a", "id AS b")
    more = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (1_000_000, 1_000_001)], "a long, b long")
    got = components(star.unionAll(more)).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in got} == {2: 299_990 + 4, 1_000_000: 2}


@pytest.mark.parametrize("limit", [3, 10**6])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join(spark, monkeypatch, limit, how):
    from custodia.llm import common

    monkeypatch.setattr(common, "_HOT_ROWS", limit)
    many = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 90), (3, 91), (None, 92)] + [(4, i) for i in range(9)], "k long, x long")
    one = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d"), (5, "e")], "k long, v string")
    got = sorted(map(repr, map(tuple, common.spread_join(many, one, "k", "x", how).select("k", "x", "v").collect())))
    assert got == sorted(map(repr, map(tuple, many.join(one, "k", how).select("k", "x", "v").collect())))
