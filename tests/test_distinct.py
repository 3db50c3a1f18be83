"""Distinct counts by bitmaps and by pairs against plain sets, and what their plans shuffle."""

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from custodia.operators import audit
from custodia.operators import coverage as cov
from custodia.operators.distinct import distinct_counts, is_dense, mark_dense
from custodia.sources import fixtures as fx
from custodia.workload import QUERIES
from tests.test_plans import plan


def _rows():
    pick = random.Random(6)
    ids = [None, 0, 1, -1, 32767, 32768, 32769, -32768, 2**40, *range(100, 160)]
    return [(pick.choice(["hot", "hot", "b", None]), pick.choice(ids), f"u{pick.randrange(9)}", i) for i in range(600)]


@pytest.mark.parametrize("dense", [True, False])
def test_counts(spark, dense):
    rows = _rows()
    df = spark.createDataFrame(rows, "g string, id bigint, who string, t int")
    df = mark_dense(df, "id") if dense else df
    assert is_dense(df.filter("t >= 0").select("id", "g"), "id") is dense
    got = distinct_counts(df, ["g"], {"ids": "id", "users": "who"}, {"last": ("max", F.col("t")), "n": ("count", F.col("id"))})
    want = {
        (
            g,
            len({r[1] for r in rows if r[0] == g and r[1] is not None}),
            max(r[3] for r in rows if r[0] == g),
            sum(r[1] is not None for r in rows if r[0] == g),
            len({r[2] for r in rows if r[0] == g}),
        )
        for g in ("hot", "b", None)
    }
    assert {tuple(r) for r in got.select("g", "ids", "last", "n", "users").collect()} == want
    assert distinct_counts(df.limit(0), ["g"], {"ids": "id"}).count() == 0
    nothing = distinct_counts(df.filter("id IS NULL"), ["g"], {"ids": "id"})
    assert {r.ids for r in nothing.collect()} == {0}


def test_distinct_days(spark):
    rows = [("a", "2024-01-01", 1), ("a", "2024-01-01", 70_000), ("a", "1969-12-31", 3), ("a", None, 4), ("b", None, 5), ("c", "2038-05-05", 6)]
    df = mark_dense(spark.createDataFrame(rows, "g string, d string, id bigint").withColumn("d", F.to_date("d")), "id")
    got = distinct_counts(df, ["g"], {"n": "id"}, {"days": ("days", F.col("d"))})
    assert {tuple(r) for r in got.select("g", "n", "days").collect()} == {("a", 4, 2), ("b", 1, 0), ("c", 1, 1)}


def test_only_integers_are_dense(spark):
    with pytest.raises(ValueError):
        mark_dense(spark.createDataFrame([("a",)], "id string"), "id")
    df = spark.range(3).select("id", F.col("id").cast("string").alias("text"))
    marked = mark_dense(df, "id").select("id", F.col("id").cast("string").alias("as_text"))
    assert is_dense(marked, "id") and not is_dense(marked, "as_text") and not is_dense(df, "text")


def test_no_ids_are_shuffled(spark, base):
    """What the exchanges hold: groups, buckets and bitmaps, no query ids."""
    access, queries = fx.access_history(spark, base), fx.query_history(spark, base)
    for job in (audit.direct_access(access, fx.as_of()), audit.active_roles(queries, fx.as_of())):
        text = plan(job)
        keys = re.findall(r"Arguments: hashpartitioning\(([^)]*)", text)
        assert keys and not any("query_id" in k for k in keys)
        assert "bitmap_construct_agg" in text and "Expand" not in text


def test_rows_moved(spark):
    """Ten thousand ids of one group in four tasks: one row per task, not one per id."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = mark_dense(spark.range(1, 10_001, numPartitions=4).withColumn("g", F.lit("hot")), "id")
        job = distinct_counts(df, ["g"], {"n": "id"})
        assert job.collect()[0]["n"] == 10_000
        node = job._jdf.queryExecution().executedPlan()
        written = []

        def walk(x):
            if "ShuffleExchange" in x.nodeName() or x.nodeName() == "Exchange":
                written.append(x.metrics().apply("shuffleRecordsWritten").value())
            children = x.children()
            for i in range(children.size()):
                walk(children.apply(i))

        walk(node)
        assert written and max(written) <= 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", ["top_sensitive_users", "top_sensitive_users_logged", "sensitive_access"])
def test_users_have_no_bitmaps(spark, base, name):
    """Users grow with the log: a bitmap of 4 KB per user and bucket would hold a few ids."""
    assert "bitmap" not in plan(QUERIES[name](spark, base))


def test_figures_of_users(spark):
    """Repeated and missing ids, times, users and amounts; days far apart."""
    pick = random.Random(8)
    times = [None, *(datetime(y, 1, d, 23, 59) for y in (2024, 2199) for d in (1, 2, 30))]
    rows = [
        (pick.choice([None, 1, 2, 40_000, 2**40]), pick.choice(["a", "b", None]), pick.choice(["r", None]), pick.choice(times), pick.choice([None, 7, 1000]))
        for _ in range(300)
    ]
    rows += [(5, "z", "r", times[1], None)]
    df = spark.createDataFrame(rows, "query_id bigint, user_name string, role_name string, start_time timestamp_ntz, total_elapsed_time bigint")
    df = df.selectExpr("*", "total_elapsed_time AS bytes_scanned", "'SUCCESS' AS execution_status", "'select LAKE.X' AS query_text")
    got = cov.top_sensitive_users(mark_dense(df, "query_id"), ["lake.x"], fx.as_of()).collect()
    groups = {}
    for r in rows:
        if r[3] is not None:
            groups.setdefault(r[1:3], []).append(r)
    want = set()
    for who, own in groups.items():
        known = [r[4] for r in own if r[4] is not None]
        mean = round(sum(known) / len(known) / 1000, 3) if known else None
        days = {r[3].date() for r in own}
        want.add((*who, len({r[0] for r in own} - {None}), len(days), mean, min(r[3] for r in own), max(r[3] for r in own)))
    columns = ("user_name", "role_name", "total_queries", "active_days", "avg_query_seconds", "first_access", "last_access")
    assert {tuple(r[c] for c in columns) for r in got} == want and len(got) == len(want) == 7
