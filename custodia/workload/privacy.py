"""k-anonymous and differentially private aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.operators.governance import DATA_USER, GOVERNOR, Governance
from custodia.operators.privacy import (
    DEFAULT_ALPHA,
    PrivacyPolicy,
    PrivateTable,
    Range,
    SessionBudget,
    interval_half_width,
    remaining_aggregates,
    signature,
    weekly_spend,
)
from custodia.sources import fixtures as fx
from custodia.sources import generators as gen
from custodia.sources.tables import read_table
from custodia.workload import duck
from custodia.workload.registry import query

K = 100
SECRET = "keyed-noise-for-checks"  # checks need repeatable noise; real queries draw a fresh secret

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "NOT_PRESENT")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

PEOPLE_POLICY = PrivacyPolicy(
    "c_custkey",
    "analysts",
    ranges={"c_acctbal": Range(-1000.0, 10000.0)},
    groups={"c_mktsegment": SEGMENTS},
)
EMPLOYEE_POLICY = PrivacyPolicy(
    "employee_id",
    "analysts",
    ranges={"salary": Range(50000.0, 200000.0), "bonus": Range(0.0, 25000.0), "age": Range(22.0, 65.0)},
    groups={"department": gen.DEPARTMENTS},
)
ORDER_POLICY = PrivacyPolicy("o_custkey", "analysts", groups={"o_orderpriority": PRIORITIES})
_RANGE = "c_acctbal > 1000 AND c_acctbal < 5000"


def _private(df: DataFrame, policy: PrivacyPolicy, role: str = DATA_USER) -> PrivateTable:
    return PrivateTable(df, policy, role, secret=SECRET, ledger=SessionBudget(policy))


def _domain(column: str, values) -> str:
    return f"(SELECT unnest({duck.strings(values)}) AS {column})"


def _noise(query: str, metric: str, group: str, scale: float) -> str:
    return duck.laplace(f"'{query}|' || {group} || '|{metric}'", scale, SECRET + "|")


def _dp_count(entities: str, policy: PrivacyPolicy, group: str, query_id: str, value=None, where=None) -> str:
    half, domain = interval_half_width(1.0), policy.groups[group]
    query = signature(policy, "count", query_id, group, value, where, DEFAULT_ALPHA)
    x = f"coalesce(n, 0) + {_noise(query, 'count', 'd.' + group, 1.0)}"
    return f"""SELECT {group}, round(x, 2) AS noisy_count, round(x - {half!r}::DOUBLE, 2) AS count_low, round(x + {half!r}::DOUBLE, 2) AS count_high
    FROM (SELECT d.{group}, {x} AS x FROM {_domain(group, domain)} d LEFT JOIN
      (SELECT {group}, count(*) AS n FROM ({entities}) GROUP BY {group}) g ON g.{group} = d.{group})"""


@query(
    """SELECT n_name AS state, o_orderpriority, sum(1)::BIGINT AS orders, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1, 2 HAVING count(*) >= 100"""
)
def kanon_aggregate(spark: SparkSession, base: str) -> DataFrame:
    """Orders per state and priority; groups below 100 rows are suppressed."""
    gov = Governance()
    gov.register("orders", read_table(spark, base, "orders"))
    gov.limit_aggregation("orders", K)
    states = fx.people(spark, base).select("c_custkey", "state")
    out = (
        gov.table("orders", DATA_USER)
        .join_dimension(states, on="o_custkey", key="c_custkey")
        .aggregate(["state", "o_orderpriority"], orders=("count", "*"), total=("sum", "o_totalprice"))
    )
    return out.withColumn("total", F.round("total", 2))


@query(
    """SELECT n_name AS state, c_mktsegment, count(*) AS count_order, round(sum(o_totalprice), 2) AS order_total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY ALL HAVING count(*) >= 100"""
)
def kanon_join_aggregate(spark: SparkSession, base: str) -> DataFrame:
    """The protected table joined to a dimension; what is counted are rows of the protected table."""
    gov = Governance()
    gov.register("orders", read_table(spark, base, "orders"))
    gov.limit_aggregation("orders", K)
    customers = fx.people(spark, base).select("c_custkey", "state", "c_mktsegment")
    return (
        gov.table("orders", DATA_USER)
        .join_dimension(customers, on="o_custkey", key="c_custkey")
        .aggregate(["state", "c_mktsegment"], count_order=("count", "o_orderkey"), order_total=("sum", "o_totalprice"))
        .withColumn("order_total", F.round("order_total", 2))
        .orderBy(F.desc("order_total"))
    )


@query(
    """WITH keyed AS (SELECT c_custkey % 50 AS bucket, min(c_mktsegment) AS segment FROM customer GROUP BY 1)
    SELECT segment, count(*) AS count_order, round(sum(o_totalprice), 2) AS order_total, count(DISTINCT o_custkey) AS customers
    FROM orders JOIN keyed ON o_custkey % 50 = bucket GROUP BY segment HAVING count(*) >= 100"""
)
def kanon_repeated_keys(spark: SparkSession, base: str) -> DataFrame:
    """A dimension with many rows per key: each protected row still counts once."""
    gov = Governance()
    gov.register("orders", read_table(spark, base, "orders").withColumn("bucket", F.expr("o_custkey % 50")))
    gov.limit_aggregation("orders", K)
    segments = read_table(spark, base, "customer").selectExpr("c_custkey % 50 AS key", "c_mktsegment AS segment")
    table = gov.table("orders", DATA_USER).join_dimension(segments, on="bucket", key="key")
    summed = table.aggregate(["segment"], count_order=("count", "o_orderkey"), order_total=("sum", "o_totalprice"))
    counted = table.aggregate(["segment"], customers=("count_distinct", "o_custkey"))
    return summed.withColumn("order_total", F.round("order_total", 2)).join(counted, "segment")


@query(
    """WITH g AS (SELECT o_orderdate::DATE AS day, count(*) AS orders, sum(o_totalprice) AS total FROM orders GROUP BY 1)
    SELECT CASE WHEN orders >= 100 THEN day END AS day, sum(orders)::BIGINT AS orders, round(sum(total), 2) AS total
    FROM g GROUP BY CASE WHEN orders >= 100 THEN day END HAVING sum(orders) >= 100"""
)
def kanon_merge_small(spark: SparkSession, base: str) -> DataFrame:
    """Small groups pooled under a NULL key instead of dropped."""
    gov = Governance()
    gov.register("orders", read_table(spark, base, "orders").withColumn("day", F.to_date("o_orderdate")))
    gov.limit_aggregation("orders", K)
    out = gov.table("orders", DATA_USER).aggregate(
        ["day"], merge_small=True, orders=("count", "*"), total=("sum", "o_totalprice")
    )
    return out.withColumn("total", F.round("total", 2))


@query(_dp_count("SELECT c_custkey, c_mktsegment FROM customer", PEOPLE_POLICY, "c_mktsegment", "q-count", "c_acctbal"))
def dp_count(spark: SparkSession, base: str) -> DataFrame:
    customers = read_table(spark, base, "customer")
    return _private(customers, PEOPLE_POLICY).count("q-count", "c_mktsegment", "c_acctbal")


@query(
    _dp_count(
        f"SELECT c_custkey, c_mktsegment FROM customer WHERE {_RANGE}",
        PEOPLE_POLICY,
        "c_mktsegment",
        "q-range",
        "c_acctbal",
        _RANGE,
    )
)
def dp_count_range(spark: SparkSession, base: str) -> DataFrame:
    customers = read_table(spark, base, "customer")
    return _private(customers, PEOPLE_POLICY).count("q-range", "c_mktsegment", "c_acctbal", where=_RANGE)


@query(
    _dp_count(
        "SELECT o_custkey, min(o_orderpriority) AS o_orderpriority FROM orders GROUP BY o_custkey",
        ORDER_POLICY,
        "o_orderpriority",
        "q-orders",
    )
)
def dp_count_bounded(spark: SparkSession, base: str) -> DataFrame:
    """Customers have many orders; each counts once, in one group."""
    return _private(read_table(spark, base, "orders"), ORDER_POLICY).count("q-orders", "o_orderpriority")


_AVERAGE = signature(EMPLOYEE_POLICY, "average", "q-avg", "department", "salary", None, DEFAULT_ALPHA)
_N = f"coalesce(n, 0) + {_noise(_AVERAGE, 'count', 'd.department', 2.0)}"
_S = f"coalesce(s, 0.0::DOUBLE) + {_noise(_AVERAGE, 'sum', 'd.department', 400000.0)}"


@query(
    duck.with_tables(
        "employees",
        sql=f"""SELECT department, round(nn, 2) AS noisy_count, round(ns, 2) AS noisy_sum,
      round(least(greatest(ns / greatest(nn, 1.0::DOUBLE), 50000.0::DOUBLE), 200000.0::DOUBLE), 2) AS noisy_avg
    FROM (SELECT d.department, {_N} AS nn, {_S} AS ns FROM {_domain('department', gen.DEPARTMENTS)} d LEFT JOIN
      (SELECT department, count(salary) AS n, round(sum(least(greatest(salary, 50000), 200000)), 2) AS s
       FROM employees GROUP BY department) g ON g.department = d.department)""",
    )
)
def dp_avg(spark: SparkSession, base: str) -> DataFrame:
    employees = gen.employees(read_table(spark, base, "customer"), "c_custkey")
    return _private(employees, EMPLOYEE_POLICY).average("q-avg", "department", "salary")


@query(
    duck.with_tables(
        "employees",
        sql="""SELECT department, count(DISTINCT employee_id) AS headcount, round(avg(salary), 2) AS avg_salary,
    round(avg(bonus), 2) AS avg_bonus FROM employees GROUP BY department""",
    )
)
def dp_exempt_exact(spark: SparkSession, base: str) -> DataFrame:
    """An exempt role reads the rows and gets exact results."""
    employees = gen.employees(read_table(spark, base, "customer"), "c_custkey")
    rows = _private(employees, EMPLOYEE_POLICY, role=GOVERNOR).to_df()
    return (
        rows.groupBy("department")
        .agg(
            F.count_distinct("employee_id").alias("headcount"),
            F.round(F.avg("salary"), 2).alias("avg_salary"),
            F.round(F.avg("bonus"), 2).alias("avg_bonus"),
        )
        .orderBy(F.desc("avg_salary"))
    )


@query(
    """SELECT user_name, week, spent, CAST(floor(greatest(20.0 - spent, 0.0)) AS BIGINT) AS remaining FROM (
      SELECT 'user_' || user_id AS user_name, date_trunc('week', ts)::TIMESTAMP AS week,
        round(sum(CASE WHEN event_type = 'view' THEN 1.0 ELSE 0.5 END), 6)::DOUBLE AS spent
      FROM events GROUP BY 1, 2)"""
)
def dp_budget_remaining(spark: SparkSession, base: str) -> DataFrame:
    """Every event is a charge; what is left per user and week of a budget of 20."""
    charges = read_table(spark, base, "events").select(
        F.concat(F.lit("user_"), "user_id").alias("user_name"),
        F.when(F.col("event_type") == "view", 1.0).otherwise(0.5).alias("epsilon"),
        F.col("ts").alias("charged_at"),
    )
    policy = PrivacyPolicy("user_id", "analysts", weekly_budget=20.0)
    spend = weekly_spend(charges, ["user_name"])
    spend = spend.withColumn("week", F.col("week").cast("timestamp_ntz"))
    return remaining_aggregates(spend, policy).select("user_name", "week", "spent", "remaining")
