"""Fingerprints against plain sets, and the order of documents against sorting them."""

import hashlib
import random

from pyspark.sql import functions as F

from custodia.llm import fingerprints as fp
from custodia.llm.queries import QUERIES
from tests.llm.helpers import ROWS, clashing, documents




def check_edits(spark, rows):
    got = fp.fingerprint_documents(documents(spark, rows)).collect()
    keys = documents(spark, rows).selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS k").distinct().collect()
    order = sorted(keys, key=lambda r: (r.doc_id if r.doc_id is not None else -(2**63), r.k), reverse=True)
    assert len(got) == len(order)
    want = []
    for i, r in enumerate(order):
        following = order[(i + 1) % len(order)].text
        k = len(r.text) // 3
        edited = r.text[: len(r.text) - k] + following[:k]
        want.append((r.doc_id, len(r.text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((g.doc_id, g.n_chars, g.edited_sha256) for g in got), key=repr) == sorted(want, key=repr)
    return got


def test_edited_texts(spark):
    got = check_edits(spark, ROWS)
    assert all(0 <= x <= 1 for g in got for x in (g.near_edited, g.near_next, g.resemblance_edited, g.resemblance_next))


def test_many_ranges(spark):
    rows = [(i * i % 7919, f"text {i} " * (i % 5), "en", "a", 0) for i in range(1500)]
    check_edits(spark, rows)


def test_single_and_empty(spark):
    (one,) = fp.fingerprint_documents(documents(spark, [(4, "abc def ghi", "en", "a", 1)])).collect()
    assert one.near_next == 1.0
    assert fp.fingerprint_documents(documents(spark, [])).count() == 0


def test_clashing_columns(spark):
    df = clashing(documents(spark), "k1", "p1", "sketch", "head", "edited", "n")
    assert fp.fingerprint_documents(df).count() == len(set(ROWS))


def shingles(text):
    words = [w for w in text.lower().split() if w]
    n = len(words)
    return {tuple(words[i : i + 5]) for i in range(max(n - 4, 1))} if n else set()


def test_estimates_are_near_the_truth(spark):
    rng = random.Random(3)
    pairs = []
    for i in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([400, 1000, 3000]))]
        cut = rng.randrange(len(words))
        pairs.append((i, " ".join(words), " ".join([*words[:cut], *(f"x{rng.randrange(9000)}" for _ in range(rng.randrange(2000)))])))
    a, b = fp.sketch(F.col("a"), 0.125, 16), fp.sketch(F.col("b"), 0.125, 16)
    df = spark.createDataFrame(pairs, "id long, a string, b string").select("a", "b", a.alias("x"), b.alias("y"))
    got = df.select("a", "b", fp.containment(F.col("x"), F.col("y"), 0.125, 16).alias("c"),
                    fp.resemblance(F.col("x"), F.col("y"), 0.125, 16).alias("r")).collect()
    errors = []
    for r in got:
        s, t = shingles(r.a), shingles(r.b)
        errors.append((abs(r.c - len(s & t) / len(s)), abs(r.r - len(s & t) / len(s | t))))
    assert sum(e[0] for e in errors) / len(errors) < 0.05
    assert sum(e[1] for e in errors) / len(errors) < 0.05


def test_merge_equals_the_sketch_of_the_union(spark):
    a, b = "one two three four five six seven eight " * 3, "nine ten eleven twelve thirteen fourteen " * 40
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        fp.merged(fp.sketch(F.col("a"), 0.3, 4), fp.sketch(F.col("b"), 0.3, 4), 0.3, 4).alias("m"),
        fp.reduced(F.concat(fp.shingle_hashes(F.col("a")), fp.shingle_hashes(F.col("b"))), 0.3, 4).alias("w"),
    ).first()
    assert row.m == row.w


def test_table(spark, base):
    rows = spark.read.parquet(f"{base}/documents.parquet").collect()
    order = sorted(rows, key=lambda r: -r.doc_id)
    following = {r.doc_id: order[(i + 1) % len(order)].text for i, r in enumerate(order)}
    texts = {r.doc_id: r.text for r in rows}
    got = QUERIES["op1_scaled_fingerprints"](spark, base).collect()
    by_text = {}
    apart = near = 0
    for g in got:
        text, k = texts[g.doc_id], len(texts[g.doc_id]) // 3
        assert g.edited_sha256 == hashlib.sha256((text[: len(text) - k] + following[g.doc_id][:k]).encode()).hexdigest()
        assert by_text.setdefault(text, g.fingerprint) == g.fingerprint
        if text == following[g.doc_id]:
            assert g.near_next == g.near_edited == 1.0
        elif not shingles(text) & shingles(following[g.doc_id]) and len(text) > 400:
            apart += 1
            near += g.near_edited > 0.4 and g.near_next < 0.1
    assert len(got) == len(rows) and near >= 0.97 * apart
