"""Loading, table changes, projection, joins, top-k and sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custodia.operators.insights import first_per_group as first_rows
from custodia.operators.insights import fixed_sample as sample_rows
from custodia.session import fresh_path
from custodia.sources import fixtures as fx
from custodia.sources import generators as gen
from custodia.sources import snapshots
from custodia.sources.tables import read_csv, read_table
from custodia.workload import duck
from custodia.workload.registry import query

_LEADS = "lead_id, lead_name, email, phone, company, status, deal_amount, lead_source, created_at"
_GOOD = duck.names(gen.STATUSES)

CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)


def leads_of(spark: SparkSession, base: str) -> DataFrame:
    """One lead per order."""
    ids = read_table(spark, base, "orders").select((F.col("o_orderkey") + 1).alias("i"))
    return gen.leads(ids, "i", fx.as_of())


def bad_leads_of(spark: SparkSession, base: str) -> DataFrame:
    """A bad load of one row per customer, with ids below zero."""
    ids = read_table(spark, base, "customer").select((-1 - F.col("c_custkey")).alias("i"))
    return gen.garbage_leads(ids, "i", fx.as_of())


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_load(spark: SparkSession, base: str) -> DataFrame:
    path = fresh_path(spark, "customer-csv")
    read_table(spark, base, "customer").select(CUSTOMER_SCHEMA.names).write.option("header", True).csv(path)
    return read_csv(spark, path, CUSTOMER_SCHEMA)


@query(duck.with_tables("leads", sql=f"SELECT {_LEADS} FROM leads"))
def leads_generate(spark: SparkSession, base: str) -> DataFrame:
    return leads_of(spark, base)


@query(
    duck.with_tables(
        "employees", sql="SELECT employee_id, department, salary, bonus, age, years_at_company FROM employees"
    )
)
def employees_generate(spark: SparkSession, base: str) -> DataFrame:
    return gen.employees(read_table(spark, base, "customer"), "c_custkey")


@query(
    "SELECT c_custkey, c_name, round(sum(o_totalprice), 2) AS total, count(*) AS orders "
    "FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name"
)
def ctas_snapshot(spark: SparkSession, base: str) -> DataFrame:
    orders = (
        read_table(spark, base, "orders")
        .groupBy("o_custkey")
        .agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count(F.lit(1)).alias("orders"))
    )
    customers = read_table(spark, base, "customer").select("c_custkey", "c_name")
    joined = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"))
    return snapshots.write_snapshot(joined.select("c_custkey", "c_name", "total", "orders"), "customer-totals")


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def snapshot_if_absent(spark: SparkSession, base: str) -> DataFrame:
    orders = read_table(spark, base, "orders")
    path = fresh_path(spark, "status-counts")
    snapshots.create_if_absent(orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), path)
    # the second attempt finds the table and must not replace it
    return snapshots.create_if_absent(orders.groupBy("o_orderstatus").agg(F.lit(0).cast("bigint").alias("n")), path)


@query(
    duck.with_tables(
        "leads", "bad_leads", sql=f"SELECT {_LEADS} FROM leads UNION ALL SELECT {_LEADS} FROM bad_leads"
    )
)
def leads_inject_bad(spark: SparkSession, base: str) -> DataFrame:
    return snapshots.insert_rows(leads_of(spark, base), bad_leads_of(spark, base))


@query(duck.with_tables("leads", sql=f"SELECT {_LEADS} FROM leads"))
def leads_delete(spark: SparkSession, base: str) -> DataFrame:
    dirty = snapshots.insert_rows(leads_of(spark, base), bad_leads_of(spark, base))
    return snapshots.delete_where(dirty, F.col("lead_id") < 0)


@query(duck.with_tables("feedback", sql="SELECT o_orderkey, o_custkey, feedback FROM feedback"))
def feedback_fill(spark: SparkSession, base: str) -> DataFrame:
    orders = read_table(spark, base, "orders").select("o_orderkey", "o_custkey")
    orders = snapshots.add_column_if_absent(orders, "feedback", T.StringType())
    return snapshots.update_where(
        orders, {"feedback": fx.feedback_text("o_orderkey")}, F.col("feedback").isNull()
    )


@query("SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS review FROM part")
def add_column(spark: SparkSession, base: str) -> DataFrame:
    parts = read_table(spark, base, "part").select("p_partkey", "p_name")
    once = snapshots.add_column_if_absent(parts, "review", T.StringType())
    return snapshots.add_column_if_absent(once, "review", T.StringType())


@query("SELECT c_custkey, c_name FROM customer ORDER BY md5(c_custkey || 'seed-1') LIMIT 100")
def fixed_sample(spark: SparkSession, base: str) -> DataFrame:
    customers = read_table(spark, base, "customer").select("c_custkey", "c_name")
    return sample_rows(customers, F.col("c_custkey"), 100, "seed-1")


_COUNTED = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _COUNTED))
def table_counts(spark: SparkSession, base: str) -> DataFrame:
    counts = [
        read_table(spark, base, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
        for t in _COUNTED
    ]
    return reduce(DataFrame.unionByName, counts)


@query(duck.with_tables("people", sql="SELECT * EXCLUDE (zip) FROM people WHERE job NOT IN ('Clerk', 'Cook')"))
def exclude_column(spark: SparkSession, base: str) -> DataFrame:
    return fx.people(spark, base).drop("zip").filter(~F.col("job").isin("Clerk", "Cook"))


@query(duck.with_tables("people", sql="SELECT DISTINCT c_custkey AS customer_id, optin FROM people"))
def consent_map(spark: SparkSession, base: str) -> DataFrame:
    return fx.people(spark, base).select(F.col("c_custkey").alias("customer_id"), "optin").distinct()


@query(
    duck.with_tables(
        "leads",
        sql=f"""
    SELECT lead_id, 'null_email' AS defect, email, phone, company, status, deal_amount FROM leads WHERE email IS NULL
    UNION ALL SELECT lead_id, 'blank_phone', email, phone, company, status, deal_amount FROM leads WHERE phone = ''
    UNION ALL SELECT lead_id, 'duplicate_email', email, phone, company, status, deal_amount FROM leads WHERE email = '{gen.DUPLICATE_EMAIL}'
    UNION ALL SELECT lead_id, 'invalid_status', email, phone, company, status, deal_amount FROM leads WHERE status NOT IN {_GOOD}
    UNION ALL SELECT lead_id, 'out_of_range_deal', email, phone, company, status, deal_amount FROM leads
      WHERE deal_amount < 0 OR deal_amount > 1000000""",
    )
)
def leads_spotcheck(spark: SparkSession, base: str) -> DataFrame:
    return gen.lead_defects(leads_of(spark, base)).orderBy("defect", "lead_id")


@query(
    duck.with_tables(
        "people",
        sql="""SELECT c_custkey, first_name, last_name, count(o_orderkey) AS orders_count, round(sum(o_totalprice), 2) AS order_total
    FROM people, orders WHERE c_custkey = o_custkey GROUP BY 1, 2, 3""",
    )
)
def customer_order_summary(spark: SparkSession, base: str) -> DataFrame:
    # summed per customer before the join: no hot join key, and one shuffle on the key serves both
    totals = (
        read_table(spark, base, "orders")
        .groupBy("o_custkey")
        .agg(F.count("o_orderkey").alias("orders_count"), F.round(F.sum("o_totalprice"), 2).alias("order_total"))
    )
    names = fx.people(spark, base).select("c_custkey", "first_name", "last_name")
    return names.join(totals, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")


@query(
    "SELECT c_custkey, c_name, round(sum(o_totalprice), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey "
    "GROUP BY 1, 2 ORDER BY revenue DESC, c_custkey LIMIT 10"
)
def top_customers(spark: SparkSession, base: str) -> DataFrame:
    top = (
        read_table(spark, base, "orders")
        .groupBy("o_custkey")
        .agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    )
    names = read_table(spark, base, "customer").select("c_custkey", "c_name")
    return (
        names.join(top, F.col("c_custkey") == F.col("o_custkey"))
        .select("c_custkey", "c_name", "revenue")
        .orderBy(F.desc("revenue"), "c_custkey")
        .limit(10)
    )


@query(
    duck.with_tables(
        "feedback",
        sql="SELECT o_orderkey % 10 AS template, o_orderkey, feedback FROM feedback "
        "QUALIFY row_number() OVER (PARTITION BY o_orderkey % 10 ORDER BY o_orderkey) = 1",
    )
)
def first_per_group(spark: SparkSession, base: str) -> DataFrame:
    notes = fx.feedback(spark, base).select((F.col("o_orderkey") % 10).alias("template"), "o_orderkey", "feedback")
    return first_rows(notes, ["template"], ["o_orderkey"])


@query(
    duck.with_tables(
        "people",
        sql="""SELECT count(*) AS total_customers, CAST(sum(CASE WHEN optin = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS opted_in
    FROM people""",
    )
)
def optin_counts(spark: SparkSession, base: str) -> DataFrame:
    return fx.people(spark, base).agg(
        F.count(F.lit(1)).alias("total_customers"), F.count_if(F.col("optin") == "Y").alias("opted_in")
    )
