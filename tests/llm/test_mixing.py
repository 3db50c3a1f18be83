"""Poisson replication: exact draws, rates that add up, hot and tiny sources."""

import math
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from custodia.llm.mixing import STEP, poisson_mix, repetition_rates
from tests.llm.helpers import ROWS, clashing, documents


def drawn(name: str, rate: float, seed: str = "mix") -> int:
    """The draw by the textbook: count cumulative probabilities at or below the uniform value."""
    draws = max(math.ceil(rate / STEP), 1)
    total = 0
    for j in range(1, draws + 1):
        digest = md5(f"{seed}{name}:{j}".encode()).hexdigest()[:13]
        u = (int(digest, 16) + 0.5) / 2**52
        p = c = math.exp(-rate / draws)
        k = 0
        while c <= u and c < 1.0 and k < 400:
            k += 1
            p *= rate / draws / k
            c += p
        total += k
    return total


def test_draws_equal_the_textbook(spark):
    rates = {r.mix_source: r.rate for r in repetition_rates(documents(spark), 0.5).collect()}
    sizes = {s: sum(r[3] == s for r in ROWS) for s in rates}
    assert math.isclose(sum(rates[s] * sizes[s] for s in rates), len(ROWS))
    got = poisson_mix(clashing(documents(spark), "copy", "mix_rate2"), 0.5)
    counts = {}
    for r in got.collect():
        counts[r.doc_id, r.text, r.source] = counts.get((r.doc_id, r.text, r.source), 0) + 1
    for doc_id, text, _, source, _ in set(ROWS):
        name = str(doc_id) if doc_id is not None else "text:" + md5((text or "").encode()).hexdigest()
        times = ROWS.count(next(r for r in ROWS if r[:2] == (doc_id, text)))
        assert counts.get((doc_id, text, source), 0) == times * drawn(name, rates[source])


def test_given_weights_and_large_rates(spark):
    df = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") < 4, "rare").otherwise("hot").alias("source"), F.lit(1).cast("long").alias("n_chars"),
    )
    got = {r.source: r["count"] for r in poisson_mix(df, weights={"rare": 3.0, "hot": 1.0, "absent": 0.0}).groupBy("source").count().collect()}
    assert abs(got["rare"] - 1500) < 5 * 1500**0.5
    assert abs(got["hot"] - 500) < 5 * 500**0.5


def test_copies_are_numbered_and_rerun_alike(spark):
    df = documents(spark)
    first = poisson_mix(df, 0.2).collect()
    assert first and sorted(map(repr, first)) == sorted(map(repr, poisson_mix(df.repartition(3), 0.2).collect()))
    assert all(r.copy >= 1 for r in first)


def test_texts_move_once(spark, base):
    """Rates meet the texts by broadcast; the only exchange that texts pass is the global shuffle."""
    import re

    from tests.test_plans import plan

    text = plan(poisson_mix(spark.read.parquet(f"{base}/documents.parquet")))
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[[^\n]*\n(?:Arguments: )?[^\n]*", text)
    assert len(exchanges) == 1 and "mix_order" in exchanges[0], exchanges
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_rates_beyond_a_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = sorted(map(repr, poisson_mix(documents(spark), 0.5).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(repr, poisson_mix(documents(spark), 0.5).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty(spark):
    assert poisson_mix(documents(spark, [])).count() == 0


@pytest.mark.parametrize("weights", [{"a": 0.0}])
def test_no_weight_no_rows(spark, weights):
    assert poisson_mix(documents(spark), weights=weights).count() == 0
