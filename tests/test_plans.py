"""What the plans must look like: pushed filters, pruned columns, no Python workers, no nested loops."""

import re

import pytest
from pyspark.sql import functions as F

from custodia.operators.governance import DATA_USER, GOVERNOR, Governance
from custodia.operators.insights import first_per_group, fixed_sample
from custodia.operators.privacy import PrivateTable, SessionBudget
from custodia.sources.tables import read_table
from custodia.workload import QUERIES
from custodia.workload.privacy import ORDER_POLICY
from custodia.workload.scenario import governance


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are when no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_query_needs_python_workers_or_nested_loops(spark, base, name):
    text = plan(QUERIES[name](spark, base), "simple")
    for bad in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert bad not in text, bad


def test_privileged_role_has_no_policy_in_its_plan(spark, base):
    gov = governance(spark, base)
    clear, limited = (plan(gov.table("customers", r).to_df()) for r in (GOVERNOR, DATA_USER))
    assert "LeftSemi" in limited and "REDACTED" in limited
    assert "LeftSemi" not in clear and "REDACTED" not in clear


def test_filter_on_masked_column_is_not_pushed_raw(spark, base):
    gov = Governance()
    gov.register("c", read_table(spark, base, "customer"), {"c_name": "PII", "c_acctbal": "RESTRICTED"})
    df = gov.table("c", DATA_USER).to_df()
    assert "Customer#1" not in plan(df.filter("c_name = 'Customer#1'"))
    pushed = re.findall(r"PushedFilters: \[(.*?)\]", plan(df.filter("c_acctbal > 100 AND c_mktsegment = 'BUILDING'")))
    assert "EqualTo(c_mktsegment,BUILDING)" in pushed[0] and "GreaterThan(c_acctbal" not in pushed[0]


def test_hidden_columns_are_not_read(spark, base):
    gov = Governance()
    gov.register("c", read_table(spark, base, "customer"), {"c_name": "PII"})
    schemas = re.findall("ReadSchema: (.*)", plan(gov.table("c", DATA_USER).to_df().select("c_custkey", "c_name")))
    assert schemas == ["struct<c_custkey:bigint>"]  # the constant mask does not need the name


def test_time_window_reaches_the_scan(spark, base):
    assert "GreaterThanOrEqual(ts,2023-12-02" in plan(QUERIES["audit_read_write"](spark, base))


@pytest.mark.parametrize("name", ["sensitive_access", "after_hours_access", "top_sensitive_users_logged"])
def test_time_window_reaches_both_logs(spark, base, name):
    text = plan(QUERIES[name](spark, base))
    scans = [part for part in text.split("\n\n") if "Scan parquet" in part and "events.parquet" in part]
    assert len(scans) == 2 and all("GreaterThanOrEqual(ts,20" in s for s in scans)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_exchange_of_fixed_size(spark, base, name):
    """Nothing that AQE may neither coalesce nor split."""
    assert "REPARTITION_BY_NUM" not in plan(QUERIES[name](spark, base), "simple")


def test_orders_are_summed_per_customer_before_joins(spark, base, no_broadcast):
    for name in ("semantic_governed", "kanon_join_aggregate", "customer_order_summary"):
        text = plan(QUERIES[name](spark, base), "simple")
        # on the orders' branch the first shuffle carries partial aggregates, not rows
        branch = text.split("\n")
        scan = next(i for i, line in enumerate(branch) if "FileScan" in line and "o_totalprice" in line)
        above = [line for line in branch[:scan] if "Exchange" in line or "HashAggregate" in line or "Join" in line]
        assert "partial_" in above[-1] and "Exchange" in above[-2] and "o_custkey" in above[-2], name


def test_top_k_and_group_limit(spark, base):
    orders = read_table(spark, base, "orders")
    assert "TakeOrderedAndProject" in plan(fixed_sample(orders, F.col("o_orderkey"), 10, "s"))
    assert "TakeOrderedAndProject" in plan(QUERIES["top_customers"](spark, base))
    text = plan(first_per_group(orders, ["o_orderstatus"], ["o_orderkey"]), "simple")
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_entities_are_reduced_before_the_shuffle(spark, base):
    table = PrivateTable(read_table(spark, base, "orders"), ORDER_POLICY, DATA_USER, secret="s")
    text = plan(table._per_entity("o_orderpriority", None, None), "simple")
    assert "partial_min(o_orderpriority" in text


def test_published_noise_carries_neither_secret_nor_data(spark, base):
    budget = SessionBudget(ORDER_POLICY)
    table = PrivateTable(read_table(spark, base, "orders"), ORDER_POLICY, DATA_USER, secret="very-secret", ledger=budget)
    text = plan(table.count("q", "o_orderpriority"), "extended")
    assert "very-secret" not in text and "parquet" not in text.lower()
    assert "very-secret" not in repr(table)


def test_quality_reads_the_table_once_for_the_first_duplicate_metric(spark, base):
    assert plan(QUERIES["dq_orders"](spark, base), "simple").count("FileScan") == 1
