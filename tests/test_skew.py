"""Results stay whole and equal when one key holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from custodia.operators import audit, coverage
from custodia.operators import quality as dq
from custodia.operators.governance import DATA_USER, FULL_CLEAR, Governance, grouped_by_key
from custodia.operators.row_filters import MappingFilter, ParentFilter
from custodia.plans.semantic import Dimension, Fact, LogicalTable, MetricDef, Relationship, SemanticModel

N = 60_000


@pytest.fixture(scope="module", params=["broadcast", "shuffle"])
def mode(request, spark):
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _orders(spark):
    return spark.range(N).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 1000 END AS customer", "CAST(id % 11 AS DOUBLE) AS total")


def _expected(states):
    revenue, count = {}, {}
    for i in range(N):
        customer = 7 if i % 3 == 0 else i % 1000
        state = f"S{customer % 5}"
        if state in states:
            revenue[state] = revenue.get(state, 0) + i % 11
            count[state] = count.get(state, 0) + 1
    return {s: (float(revenue[s]), count[s]) for s in revenue}


MODEL = SemanticModel(
    "m",
    (LogicalTable("customers", "key"), LogicalTable("orders", "id")),
    Relationship("orders", "customer", "customers"),
    (Fact("t", "orders", "total"),),
    (Dimension("state", "customers", "state"),),
    (MetricDef("revenue", "orders", "sum", "t"), MetricDef("n", "orders", "count", "id")),
)


def test_governed_semantic_query(spark, mode):
    customers = spark.range(1000).selectExpr("id AS key", "concat('S', id % 5) AS state")
    mapping = spark.createDataFrame([(DATA_USER, "S1"), (DATA_USER, "S2")], "role string, visible_value string")
    gov = Governance()
    gov.register("customers", customers, {})
    gov.register("orders", _orders(spark), {})
    states = MappingFilter("s", "state", mapping, FULL_CLEAR)
    gov.add_row_filter("customers", states)
    gov.add_row_filter("orders", ParentFilter("p", "customer", gov.raw("customers"), "key", states, FULL_CLEAR))
    out = MODEL.query(
        lambda t: gov.table(t, DATA_USER).to_df(), ["state"], ["revenue", "n"],
        lambda t, *grouping: grouped_by_key(gov, t, DATA_USER, *grouping),
    )
    assert {r["state"]: (r["revenue"], r["n"]) for r in out.collect()} == _expected({"S1", "S2"})


def test_k_anonymous_join(spark, mode):
    customers = spark.range(1000).selectExpr("id AS key", "concat('S', id % 5) AS state")
    gov = Governance()
    gov.register("orders", _orders(spark), {})
    gov.limit_aggregation("orders", 100)
    out = gov.table("orders", DATA_USER).join_dimension(customers, "customer", "key").aggregate(
        ["state"], revenue=("sum", "total"), n=("count", "*")
    )
    assert {r["state"]: (r["revenue"], r["n"]) for r in out.collect()} == _expected({f"S{i}" for i in range(5)})


def test_duplicates_of_one_value(spark, mode):
    out = dq.measure(_orders(spark), [dq.duplicate_count("d", "customer"), dq.row_count("r")]).first()
    assert tuple(out) == (N, N)


def test_one_object_in_a_third_of_the_log(spark, mode):
    log = spark.range(N).selectExpr(
        "id AS query_id",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, CAST(id % 1000 AS INT)) AS query_start_time",
        "array(named_struct('objectName', CASE WHEN id % 3 = 0 THEN 'L.s.hot' ELSE concat('L.s.t', id % 50) END)) AS direct_objects_accessed",
    )
    queries = log.selectExpr("query_id", "'u' AS user_name", "'r' AS role_name", "query_start_time AS start_time")
    now = F.lit("2024-01-02").cast("timestamp_ntz")
    direct = {r["object_name"]: r["number_of_queries"] for r in audit.direct_access(log, now).collect()}
    assert direct["L.s.hot"] == N // 3 and sum(direct.values()) == N
    tags = spark.createDataFrame(
        [("L", "s", "hot", "COLUMN", "SEMANTIC_CATEGORY", "EMAIL"), ("L", "s", "t1", "COLUMN", "SEMANTIC_CATEGORY", "EMAIL")],
        "object_database string, object_schema string, object_name string, domain string, tag_name string, tag_value string",
    )
    row = coverage.sensitive_access(queries, log, tags, "L", ["EMAIL"], now).collect()
    assert len(row) == 1 and row[0]["tables_accessed"] == "L.s.hot, L.s.t1"
    assert row[0]["query_count"] == N // 3 + direct["L.s.t1"]
