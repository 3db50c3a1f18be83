"""Log analytics against plain Python on a small, awkward log."""

import datetime

import pytest
from pyspark.sql import functions as F

from custodia.operators import audit, coverage, insights

T0 = datetime.datetime(2024, 1, 1)


def _src(*names):
    return [("id", n, "c") for n in names]


LOG = [
    # query, day, ddl, direct, base, modified
    (1, 0, None, ["a", "a"], ["a"], None),
    (2, 1, "CREATE", ["a", "b"], ["a", "z"], [("t", [("x", _src("a"), []), ("y", [], [])])]),
    (3, 2, None, ["v"], ["a", "a"], [("t", [("x", _src("a"), _src("z"))]), ("u", [])]),
    (4, 90, None, ["b"], ["b"], [("w", None)]),
    (5, 3, None, [], ["a"], []),
    (6, 3, None, None, None, None),
]


@pytest.fixture(scope="module")
def log(spark):
    wrap = lambda names: None if names is None else [(n,) for n in names]
    rows = [(q, T0 + datetime.timedelta(days=d), ddl, wrap(x), wrap(y), m) for q, d, ddl, x, y, m in LOG]
    return spark.createDataFrame(rows, audit.ACCESS_HISTORY_SCHEMA)


def as_of():
    """Query 4 lies on the day before, the others 86 days or more further back."""
    return F.lit("2024-04-01").cast("timestamp_ntz")


def _pairs(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


def test_direct(log):
    got = _pairs(audit.direct_access(log, as_of(), days=None), "object_name", "number_of_queries")
    assert got == {("a", 2), ("b", 2), ("v", 1)}
    assert _pairs(audit.direct_access(log, as_of(), days=60), "object_name", "number_of_queries") == {("b", 1)}
    assert _pairs(audit.direct_access(log, as_of(), None, "v"), "object_name") == {("v",)}


def test_one_row_per_query_gives_the_same(log):
    for job in (audit.direct_access, audit.read_write, audit.indirect_access):
        exact, fast = job(log, as_of(), None), job(log, as_of(), None, one_row_per_query=True)
        assert sorted(map(tuple, exact.collect())) == sorted(map(tuple, fast.collect()))


def test_read_write(log):
    columns = ("object_name", "query_type", "number_of_queries")
    assert _pairs(audit.read_write(log, as_of(), None), *columns) == {
        ("a", "read", 1), ("a", "write", 1), ("b", "write", 1), ("b", "read", 1), ("v", "read", 1),
    }
    assert ("v", "write", 1) in _pairs(audit.read_write(log, as_of(), None, dml_as_write=True), *columns)


def test_indirect(log):
    columns = ("object_name", "number_of_queries")
    assert _pairs(audit.indirect_access(log, as_of(), None), *columns) == {("a", 2), ("z", 1)}
    assert _pairs(audit.indirect_access(log, as_of(), None, strict=True), *columns) == {("a", 1), ("z", 1)}


def test_lineage(log):
    want = set()
    for *_, modified in LOG:
        for target, columns in modified or []:
            for column, direct, base in columns or [(None, None, None)]:
                for kind, sources in (("DIRECT", direct), ("BASE", base)):
                    for source in sources or [(None, None, None)]:
                        want.add((*source, kind, target, column))
    assert {tuple(r) for r in audit.column_lineage(log).collect()} == want
    assert ("id", "z", "c", "BASE", "t", "x") in want and (None, None, None, "DIRECT", "u", None) in want


def test_lineage_of_tagged_columns(spark, log):
    tags = spark.createDataFrame(
        [("s", "t", "x", "COLUMN", "LEVEL"), ("s", "t", "y", "COLUMN", "OTHER")],
        "object_schema string, object_name string, column_name string, domain string, tag_name string",
    )
    edges = audit.column_lineage(log)
    got = audit.sensitive_lineage(edges, tags, "s", "t", "t", ["LEVEL"])
    assert got.count() == got.distinct().count()
    assert {r["target_column_name"] for r in got.collect()} == {"x"}


def test_used_by_view(log):
    used = coverage.objects_used_by(log, "v", as_of(), None)
    assert _pairs(used, "object_name", "number_of_queries") == {("a", 1)}
    assert coverage.objects_used_by(log, "v", as_of(), 1).count() == 0


def test_role_effectiveness(spark):
    grants = spark.createDataFrame(
        [("busy", None)] * 30 + [("idle", None)] * 30 + [("rare", None)] * 21 + [("small", None)] * 20 + [("gone", T0)],
        "grantee_name string, deleted_on timestamp_ntz",
    )
    use = [("busy", i) for i in range(10)] + [("rare", i) for i in range(4)] + [("small", 1)]
    queries = spark.createDataFrame(
        [(r, q, T0) for r, q in use] + [("idle", 1, T0 - datetime.timedelta(days=40))],
        "role_name string, query_id int, start_time timestamp_ntz",
    )
    now = F.lit("2024-01-02").cast("timestamp_ntz")
    got = _pairs(audit.role_effectiveness(grants, queries, now), "role_name", "effectiveness_status")
    assert got == {("busy", "ACTIVE"), ("idle", "DORMANT"), ("rare", "OVER-PROVISIONED"), ("small", "ACTIVE")}


def test_login_status(spark):
    now = F.lit("2024-03-01").cast("timestamp_ntz")
    at = lambda days: datetime.datetime(2024, 3, 1) - datetime.timedelta(days=days)
    rows = [("a", at(7), "YES"), ("b", at(8), "YES"), ("b", at(1), "NO"), ("c", at(31), "YES"), ("d", at(61), "YES")]
    logins = spark.createDataFrame(rows, "user_name string, event_timestamp timestamp_ntz, is_success string")
    got = _pairs(audit.login_activity(logins, now), "user_name", "activity_status", "login_count")
    assert got == {("a", "ACTIVE", 1), ("b", "RECENT", 1), ("c", "STALE", 1)}


def test_login_spike_uses_calendar_days(spark):
    day = lambda n: T0 + datetime.timedelta(days=n)
    rows = [("u", day(0), "NO")] * 7 + [("u", day(1), "NO")] * 2 + [("u", day(6), "NO")] * 4 + [("u", day(20), "NO")] * 3
    logins = spark.createDataFrame(rows, "user_name string, event_timestamp timestamp_ntz, is_success string")
    got = {(r["day"].day, r["failures"], r["trailing_mean"]) for r in insights.login_spikes(logins).collect()}
    assert got == {(1, 7, 0.0), (7, 4, 1.2857), (21, 3, 0.0)}


def test_coverage_counts_policy_only_tables(spark):
    tables = spark.createDataFrame([("s", "BASE TABLE")] * 4 + [("s", "VIEW"), ("empty", "VIEW")], "table_schema string, table_type string")
    tags = spark.createDataFrame(
        [("L", "s", "t1", "TABLE"), ("L", "s", "t1", "COLUMN"), ("L", "s", "t2", "COLUMN"), ("X", "s", "t3", "TABLE")],
        "object_database string, object_schema string, object_name string, domain string",
    )
    policies = spark.createDataFrame([("L.s.t1", "TABLE"), ("L.s.t1", "TABLE"), ("L.s.t5", "TABLE"), ("X.s.t3", "TABLE")], "ref_entity_name string, ref_entity_domain string")
    got = {r["table_schema"]: r for r in coverage.governance_coverage(tables, tags, policies, "L").collect()}
    assert (got["s"]["tagged_tables"], got["s"]["tables_with_tagged_columns"], got["s"]["protected_tables"]) == (1, 2, 2)
    assert (got["s"]["pct_protected"], got["s"]["governance_grade"]) == (40.0, "Fair")
    assert (got["empty"]["protected_tables"], got["empty"]["governance_grade"]) == (0, "Needs Improvement")


def test_schema_drift(spark):
    schema = "table_name string, column_name string, data_type string"
    before = spark.createDataFrame([("t", "a", "INT"), ("t", "b", "INT"), ("t", "c", "INT")], schema)
    after = spark.createDataFrame([("t", "a", "INT"), ("t", "b", "STRING"), ("t", "d", "INT")], schema)
    assert _pairs(insights.schema_drift(before, after), "column_name", "change") == {("b", "TYPE_CHANGED"), ("c", "DROPPED"), ("d", "ADDED")}


def test_dependencies_one_hop(spark):
    schema = ", ".join(f"{s}_{p} string" for s in ("referencing", "referenced") for p in ("database", "schema", "object_name", "object_domain"))
    deps = spark.createDataFrame([("L", "s", "v", "VIEW", "L", "s", "t", "TABLE"), ("L", "s", "w", "VIEW", "L", "s", "v", "VIEW")], schema)
    assert _pairs(audit.downstream(deps, ("L", "s", "t")), "dependent_object") == {("L.s.v",)}
    assert _pairs(audit.upstream(deps, ("L", "s", "w")), "source_object") == {("L.s.v",)}
