import math

import pytest
from pyspark.sql import functions as F

from custodia.functions.keyed import laplace, uniform
from custodia.operators.governance import DATA_USER, GOVERNOR, Governance, PolicyError
from custodia.operators.privacy import (
    Ledger,
    PrivacyPolicy,
    PrivateTable,
    Range,
    SessionBudget,
    interval_half_width,
)
from custodia.session import fresh_path


@pytest.fixture()
def orders(spark):
    # 150 rows of a, 100 of b, 99 of c; keys 0..9
    return spark.range(349).selectExpr(
        "CASE WHEN id < 150 THEN 'a' WHEN id < 250 THEN 'b' ELSE 'c' END AS g", "id % 10 AS k", "CAST(id AS DOUBLE) AS v"
    )


def _protected(orders, **register):
    gov = Governance()
    gov.register("orders", orders, register.get("tags", {}))
    gov.limit_aggregation("orders", 100)
    return gov


def test_rows_are_refused(orders):
    gov = _protected(orders)
    table = gov.table("orders", DATA_USER)
    for attempt in (table.to_df, lambda: table.select("g"), lambda: table.exclude("g")):
        with pytest.raises(PolicyError):
            attempt()
    assert gov.table("orders", GOVERNOR).to_df().count() == 349
    gov.limit_aggregation("orders", None)
    assert gov.table("orders", DATA_USER).to_df().count() == 349


def test_small_groups_are_dropped(orders):
    out = _protected(orders).table("orders", DATA_USER).aggregate(["g"], n=("count", "*"), s=("sum", "v"), a=("avg", "v"))
    assert {r["g"]: (r["n"], r["s"]) for r in out.collect()} == {"a": (150, sum(range(150))), "b": (100, sum(range(150, 250)))}


def test_small_groups_pool(spark, orders):
    table = _protected(orders).table("orders", DATA_USER)
    assert {r["g"] for r in table.aggregate(["g"], merge_small=True, n=("count", "*")).collect()} == {"a", "b"}
    fine = orders.withColumn("g", F.when(F.col("g") == "a", F.concat("g", (F.col("k") % 2).cast("string"))).otherwise(F.col("g")))
    pooled = _protected(fine).table("orders", DATA_USER).aggregate(["g"], merge_small=True, n=("count", "*"))
    assert {(r["g"], r["n"]) for r in pooled.collect()} == {("b", 100), (None, 249)}
    with pytest.raises(PolicyError):
        table.aggregate(["g"], merge_small=True, a=("avg", "v"))


@pytest.mark.parametrize("function", ["max", "min", "collect_list", "first"])
def test_row_revealing_aggregates_are_refused(orders, function):
    with pytest.raises(PolicyError):
        _protected(orders).table("orders", DATA_USER).aggregate(["g"], x=(function, "v"))


def test_join_counts_protected_rows(spark, orders):
    dims = spark.createDataFrame([(i, f"d{i % 2}") for i in range(10)], "key bigint, d string")
    table = _protected(orders).table("orders", DATA_USER).join_dimension(dims, "k", "key")
    specs = {"n": ("count", "*"), "s": ("sum", "v"), "a": ("avg", "v")}
    got = {(r["g"], r["d"]): tuple(r)[2:] for r in table.aggregate(["g", "d"], **specs).collect()}
    assert got == {}  # 75, 50 and 49 rows each
    got = {r["d"]: r for r in table.aggregate(["d"], **specs).collect()}
    assert {d: r["n"] for d, r in got.items()} == {"d0": 175, "d1": 174}
    assert got["d0"]["a"] == pytest.approx(sum(range(0, 349, 2)) / 175)
    distinct = table.aggregate(["d"], keys=("count_distinct", "k"))  # cannot be split into steps
    assert {(r["d"], r["keys"]) for r in distinct.collect()} == {("d0", 5), ("d1", 5)}


POLICY = PrivacyPolicy(
    "id", "analysts", weekly_budget=3.0, ranges={"v": Range(0.0, 100.0)}, groups={"g": ("x", "y", "empty")}
)


@pytest.fixture()
def people(spark):
    # entity 0 owns a third of all rows; one entity is in a group outside the domain
    return spark.sql(
        """SELECT CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS id,
             CASE WHEN id = 1 THEN 'unlisted' WHEN id % 2 = 0 THEN 'x' ELSE 'y' END AS g,
             CASE WHEN id = 2 THEN 1e9 WHEN id = 4 THEN NULL ELSE 50.0 END AS v FROM range(300)"""
    )


def _table(people, role=DATA_USER, secret="s", **kw):
    return PrivateTable(people, POLICY, role, secret=secret, **{"ledger": SessionBudget(POLICY), **kw})


def test_dp_rows_are_refused(people):
    with pytest.raises(PolicyError):
        _table(people).to_df()
    assert _table(people, role=GOVERNOR).to_df().count() == 300
    with pytest.raises(PolicyError):
        _table(people).count("q", "v")  # no group domain
    with pytest.raises(PolicyError):
        _table(people).average("q", "g", "id")  # no range


def test_dp_groups_are_the_domain_and_entities_count_once(people):
    rows = {r["g"]: r for r in _table(people).count("q", "g").collect()}
    assert set(rows) == {"x", "y", "empty"}
    # 201 entities: 0, and the 200 ids not divisible by 3, of which id 1 is outside the domain
    exact = {"x": 101, "y": 99, "empty": 0}
    for g, r in rows.items():
        assert r["count_low"] <= r["noisy_count"] <= r["count_high"]
        assert abs(r["noisy_count"] - exact[g]) < 25


def test_dp_noise_is_reproducible_per_secret_and_query(people):
    get = lambda q, secret: [r["noisy_count"] for r in _table(people, secret=secret).count(q, "g").orderBy("g").collect()]
    assert get("q1", "s") == get("q1", "s")
    assert get("q1", "s") != get("q2", "s") and get("q1", "s") != get("q1", "t")
    fresh = lambda: PrivateTable(people, POLICY, DATA_USER).secret
    assert fresh() != fresh()


def test_dp_needs_a_budget(people):
    with pytest.raises(PolicyError):
        _table(people, ledger=None).count("q", "g")
    assert _table(people, role=GOVERNOR, ledger=None).count("q", "g").count() == 3
    table = _table(people)
    for i in range(3):
        table.count(f"q{i}", "g")
    with pytest.raises(PolicyError):
        table.average("q", "g", "v")


def test_noise_of_different_queries_does_not_cancel(people):
    """Exact counts and their noise under one id and secret: no two of these queries share a draw."""
    exact = {"x": 101, "y": 99, "empty": 0}
    queries = {
        "count": lambda t: t.count("q", "g"),
        "of value": lambda t: t.count("q", "g", "v"),
        "where": lambda t: t.count("q", "g", where="id >= 0"),
        "other where": lambda t: t.count("q", "g", where="id > -1"),
        "alpha": lambda t: t.count("q", "g", alpha=0.1),
        "average": lambda t: t.average("q", "g", "v"),
    }
    noise = {}
    for name, run in queries.items():
        noise[name] = {r["g"]: r["noisy_count"] - exact[r["g"]] for r in run(_table(people)).collect()}
    names = list(noise)
    for i, a in enumerate(names):
        for b in names[:i]:
            for g in ("y", "empty"):  # group x has an entity without a value
                for combined in (noise[a][g] - noise[b][g], noise[a][g] - 2 * noise[b][g], 2 * noise[a][g] - noise[b][g]):
                    assert abs(combined) > 0.01, (a, b, g)


def test_published_intervals_cover_the_truth(people):
    exact, inside = {"x": 101, "y": 99, "empty": 0}, []
    cached = people.cache()
    for i in range(40):
        for r in _table(cached, secret=f"s{i}").count("q", "g").collect():
            inside.append(r["count_low"] <= exact[r["g"]] <= r["count_high"])
    assert sum(inside) / len(inside) == pytest.approx(0.95, abs=0.06)


def test_repeated_dimension_keys_do_not_inflate(spark, orders):
    single = orders.withColumn("k", F.col("v"))  # one row per key
    dims = spark.range(349 * 200).selectExpr("CAST(id % 349 AS DOUBLE) AS key", "CAST(id % 349 AS STRING) AS d")
    table = _protected(single).table("orders", DATA_USER).join_dimension(dims, "k", "key")
    assert table.aggregate(["d"], n=("count", "*"), s=("sum", "v")).count() == 0
    assert table.aggregate(["d"], n=("count_distinct", "v")).count() == 0
    whole = table.aggregate(["g"], n=("count", "*")).collect()
    assert {(r["g"], r["n"]) for r in whole} == {("a", 150), ("b", 100)}


def test_dp_average_is_clamped(people):
    rows = {r["g"]: r for r in _table(people).average("q", "g", "v").collect()}
    assert all(0.0 <= r["noisy_avg"] <= 100.0 for r in rows.values())
    # the 1e9 counts as 100, so the sum stays near 100 * 50
    assert abs(rows["x"]["noisy_sum"] - 5050) < 4000


def test_interval_coverage(spark):
    half = interval_half_width(1.0, 0.05)
    noise = spark.range(20000).select(laplace(F.col("id").cast("string"), 1.0, "k").alias("x"))
    inside, mean, spread = noise.agg(
        F.avg((F.abs("x") <= half).cast("double")), F.avg("x"), F.avg(F.abs("x"))
    ).first()
    assert inside == pytest.approx(0.95, abs=0.01)
    assert mean == pytest.approx(0.0, abs=0.05) and spread == pytest.approx(1.0, abs=0.05)
    assert half == pytest.approx(math.log(20))


def test_uniform_is_inside_the_open_interval(spark):
    low, high, mean = (
        spark.range(20000).select(uniform(F.col("id").cast("string")).alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    )
    assert 0.0 < low < 0.01 and 0.99 < high < 1.0 and mean == pytest.approx(0.5, abs=0.02)


def test_budget(spark, people):
    ledger = Ledger(spark, fresh_path(spark, "ledger"), POLICY, "2024-01-30 12:00:00")
    table = _table(people, ledger=ledger)
    for i in range(3):
        assert ledger.spent_this_week() == float(i)
        table.count(f"q{i}", "g", user="u")
    with pytest.raises(PolicyError):
        table.count("q4", "g", user="u")
    assert ledger.at("2024-02-04 23:59:00").spent_this_week() == 3.0  # Sunday of the same week
    assert ledger.at("2024-02-05 00:00:00").spent_this_week() == 0.0  # Monday: reset
    assert ledger.charges().count() == 3


def test_interleaved_charges_never_overspend(spark, monkeypatch):
    """Between reading and claiming, another writer charges; the slower one reads again."""
    from custodia.sources.claims import Claims

    path, time = fresh_path(spark, "ledger"), "2024-01-30 12:00:00"
    slow, fast = (Ledger(spark, path, POLICY, time) for _ in range(2))  # the budget is 3
    put, pending = Claims.put, ["x", "y"]

    def late(self, number, record):
        if record["user_name"] == "slow" and pending:
            pending.pop()
            fast.charge("fast", 1.0)
        return put(self, number, record)

    monkeypatch.setattr(Claims, "put", late)
    slow.charge("slow", 1.0)
    assert slow.spent_this_week() == 3.0 and not pending
    with pytest.raises(PolicyError):
        fast.charge("fast", 0.5)
    pending.append("z")
    assert sorted(r.user_name for r in slow.charges().collect()) == ["fast", "fast", "slow"]


def test_many_writers_share_one_budget(spark):
    from concurrent.futures import ThreadPoolExecutor
    from dataclasses import replace

    policy = replace(POLICY, weekly_budget=20.0)
    path = fresh_path(spark, "ledger")

    def spend(user):
        mine, paid = Ledger(spark, path, policy, "2024-01-30 12:00:00"), 0
        for _ in range(5):
            try:
                mine.charge(f"u{user}", 0.7)
                paid += 1
            except PolicyError:
                pass
        return paid

    with ThreadPoolExecutor(8) as pool:
        paid = sum(pool.map(spend, range(8)))
    ledger = Ledger(spark, path, policy, "2024-01-30 12:00:00")
    assert paid == 28 == ledger.charges().count() and ledger.spent_this_week() == pytest.approx(19.6)


def test_a_charge_that_arrives_too_late_is_refused(spark, monkeypatch):
    from custodia.sources.claims import Claims

    path, time = fresh_path(spark, "ledger"), "2024-01-30 12:00:00"
    slow, fast = (Ledger(spark, path, POLICY, time) for _ in range(2))
    put, pending = Claims.put, ["x"]

    def late(self, number, record):
        if record["user_name"] == "slow" and pending:
            pending.pop()
            fast.charge("fast", 2.5)
        return put(self, number, record)

    monkeypatch.setattr(Claims, "put", late)
    with pytest.raises(PolicyError):
        slow.charge("slow", 1.0)
    assert slow.spent_this_week() == 2.5


def test_secret_does_not_reach_a_result_schema(people):
    assert _table(people).count("q", "g").columns == ["g", "noisy_count", "count_low", "count_high"]
