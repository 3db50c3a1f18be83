import pytest
from pyspark.sql import functions as F

from custodia.operators import quality as dq
from custodia.session import fresh_path
from custodia.sources import generators as gen
from custodia.sources import snapshots
from custodia.sources.fixtures import as_of


@pytest.fixture(scope="module")
def leads(spark):
    return gen.leads(gen.ids(spark, 3000), "id", as_of()).cache()


@pytest.fixture(scope="module")
def dirty(spark, leads):
    return snapshots.insert_rows(leads, gen.garbage_leads(spark.range(3001, 3201), "id", as_of()))


def _values(report):
    return {r["expectation"]: (r["value"], r["status"]) for r in report.collect()}


CLEAN = {
    "no_null_emails": (115, "FAIL"),
    "no_blank_phones": (103, "FAIL"),
    "no_duplicate_emails": (71, "FAIL"),
    "minimum_lead_volume": (3000, "PASS"),
    "no_invalid_statuses": (63, "FAIL"),
    "no_out_of_range_deals": (37, "FAIL"),
}


def test_planted_defects(leads):
    assert _values(dq.report(leads, gen.lead_expectations())) == CLEAN


def test_regression_and_cleanup(leads, dirty):
    after = _values(dq.report(dirty, gen.lead_expectations()))
    assert {k: v for k, (v, _) in after.items()} == {
        "no_null_emails": 315,
        "no_blank_phones": 303,
        "no_duplicate_emails": 71,
        "minimum_lead_volume": 3200,
        "no_invalid_statuses": 263,
        "no_out_of_range_deals": 237,
    }
    clean = snapshots.delete_where(dirty, F.col("lead_id") > 3000)
    assert _values(dq.report(clean, gen.lead_expectations())) == CLEAN


def test_defect_rows_match_counts(leads):
    found = {r["defect"]: r["count"] for r in gen.lead_defects(leads).groupBy("defect").count().collect()}
    assert found == {"null_email": 115, "blank_phone": 103, "duplicate_email": 71, "invalid_status": 63, "out_of_range_deal": 37}


def test_metrics_and_nulls(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("a",), ("a",), (None,)], "x string")
    metrics = [
        dq.null_count("n", "x"),
        dq.blank_count("b", "x"),
        dq.duplicate_count("d", "x"),
        dq.row_count("r"),
        dq.accepted_values("bad", "x", lambda c: c == "a"),
        dq.custom_metric("longest", "x", lambda c: F.max(F.length(c)), "MAX_LENGTH"),
    ]
    assert dq.measure(df, metrics).first().asDict() == {"n": 2, "b": 2, "d": 2, "r": 6, "bad": 2, "longest": 2}
    empty = dq.measure(df.filter("false"), metrics).first().asDict()
    assert empty == dict.fromkeys(["n", "b", "d", "r", "bad", "longest"], 0)


def test_by_group_includes_groups_without_duplicates(spark):
    df = spark.createDataFrame([("p", 1), ("p", 1), ("q", 1), ("q", None)], "g string, x int")
    out = dq.measure(df, [dq.row_count("r"), dq.duplicate_count("d", "x")], by=["g"])
    assert sorted(map(tuple, out.collect())) == [("p", 2, 2), ("q", 2, 0)]


def test_groups_of_nothing_but_nulls_have_rows(spark):
    df = spark.createDataFrame([("p", 1), ("p", 1), ("q", None), ("q", None)], "g string, x int")
    rows = dq.measure_rows(df, [dq.duplicate_count("d", "x"), dq.row_count("r"), dq.duplicate_count("d2", "x")], by=["g"])
    want = [("p", "d", 2), ("p", "d2", 2), ("p", "r", 2), ("q", "d", 0), ("q", "d2", 0), ("q", "r", 2)]
    assert sorted(map(tuple, rows.collect())) == want


def test_several_expectations_on_one_metric(spark):
    count = dq.row_count("rows")
    tests = [("=", 5), ("<>", 5), ("<", 6), ("<=", 4), (">", 5), (">=", 5)]
    report = dq.report(spark.range(5).toDF("x"), [dq.Expectation(f"rows {o} {n}", count, o, n) for o, n in tests])
    assert {k: s for k, (_, s) in _values(report).items()} == {
        "rows = 5": "PASS", "rows <> 5": "FAIL", "rows < 6": "PASS", "rows <= 4": "FAIL", "rows > 5": "FAIL", "rows >= 5": "PASS",
    }
    with pytest.raises(ValueError):
        dq.Expectation("bad", count, "~", 1)
    with pytest.raises(ValueError):
        dq.report(spark.range(1).toDF("x"), [dq.Expectation("a", count, "=", 1), dq.Expectation("b", dq.null_count("rows", "x"), "=", 1)])


def test_additive_metrics_share_the_scan_of_a_duplicate_count(spark, tmp_path):
    spark.range(10).toDF("x").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rows = dq.measure_rows(df, [dq.row_count("r"), dq.null_count("n", "x"), dq.duplicate_count("d", "x")])
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_history_appends_and_trends(spark):
    path = fresh_path(spark, "history")
    metrics = [dq.row_count("rows")]
    for day, n in (("2024-01-01", 5), ("2024-01-02", 7)):
        rows = dq.measure_rows(spark.range(n).toDF("id"), metrics)
        dq.append_history(dq.history_rows(rows, F.lit(day).cast("timestamp_ntz"), "L", "t"), path)
    got = dq.trend(spark.read.parquet(path), "L", "t").collect()
    assert [(str(r["measurement_time"])[:10], r["value"]) for r in got] == [("2024-01-02", 7), ("2024-01-01", 5)]
    assert dq.trend(spark.read.parquet(path), "L", "other").count() == 0


def test_registry(spark, leads):
    metrics = [e.metric for e in gen.lead_expectations()]
    rows = dq.registry(dq.measure_rows(leads, metrics), metrics, "leads").collect()
    assert len(rows) == 6 and {r["schedule"] for r in rows} == {"TRIGGER_ON_CHANGES"}


def test_employees_stay_in_their_domains(spark):
    e = gen.employees(gen.ids(spark, 2000), "id")
    row = e.agg(
        F.count("*"), F.count_distinct("department"), F.min("salary") >= 50000, F.max("salary") <= 200000, F.min("bonus") >= 0,
        F.max("bonus") <= 25000, F.min("age"), F.max("age"), F.min("years_at_company"), F.max("years_at_company"),
    ).first()
    assert tuple(row) == (2000, 6, True, True, True, True, 22, 65, 0, 25)


def test_generator_survives_very_large_ids(spark):
    big = spark.range(10**12, 10**12 + 5)
    assert gen.leads(big, "id", as_of()).filter(F.col("created_at").isNotNull()).count() == 5
