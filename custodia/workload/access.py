"""Row filters, masks, projection limits and role-switched text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions.masks import mask
from custodia.functions.text import redact
from custodia.operators.governance import DATA_USER, GOVERNOR, Governance, switch_by_role
from custodia.sources import fixtures as fx
from custodia.sources.tables import read_table
from custodia.workload import duck
from custodia.workload.registry import query
from custodia.workload.scenario import customer_governance, governance, optin_filter, state_filter

_ROLES = (GOVERNOR, DATA_USER, "OUTSIDER")


def _by_role(build) -> DataFrame:
    """The same query for several roles, told apart by a column."""
    return reduce(DataFrame.unionByName, [build(r).withColumn("seen_by", F.lit(r)) for r in _ROLES])


@query(
    duck.with_tables(
        "people",
        sql="""SELECT c_custkey, optin, 'DATA_GOVERNOR' AS seen_by FROM people
    UNION ALL SELECT c_custkey, optin, 'DATA_USER' FROM people WHERE optin = 'Y'""",
    )
)
def row_filter_attribute(spark: SparkSession, base: str) -> DataFrame:
    people, optin = fx.people(spark, base), optin_filter()
    return _by_role(lambda role: optin.apply(people, role).select("c_custkey", "optin"))


@query(
    duck.with_tables(
        "people",
        "policy_map",
        sql="""SELECT c_custkey, state, 'DATA_GOVERNOR' AS seen_by FROM people
    UNION ALL SELECT c_custkey, state, 'DATA_USER' FROM people WHERE state IN (SELECT visible_value FROM policy_map)""",
    )
)
def row_filter_map(spark: SparkSession, base: str) -> DataFrame:
    gov = customer_governance(spark, base)
    return _by_role(lambda role: gov.table("customers", role).select("c_custkey", "state").to_df())


@query(
    duck.with_tables(
        "people",
        "policy_map",
        sql="""SELECT c_custkey, 'opt-in' AS policy FROM people WHERE optin = 'Y'
    UNION ALL SELECT c_custkey, 'none' FROM people
    UNION ALL SELECT c_custkey, 'state' FROM people WHERE state IN (SELECT visible_value FROM policy_map)""",
    )
)
def row_filter_swap(spark: SparkSession, base: str) -> DataFrame:
    """What the data user sees as one row filter is dropped and another added."""
    gov = Governance()
    gov.register("customers", fx.people(spark, base), {})
    see = lambda name: gov.table("customers", DATA_USER).select("c_custkey").to_df().withColumn("policy", F.lit(name))
    gov.add_row_filter("customers", optin_filter())
    first = see("opt-in")
    gov.drop_row_filter("customers")
    between = see("none")
    gov.add_row_filter("customers", state_filter(spark))
    return first.unionByName(between).unionByName(see("state"))


@query(duck.with_tables("visible_sales", sql="SELECT o_orderkey, o_custkey, o_totalprice FROM visible_sales"))
def row_filter_cascade(spark: SparkSession, base: str) -> DataFrame:
    return governance(spark, base).table("orders", DATA_USER).select("o_orderkey", "o_custkey", "o_totalprice").to_df()


@query(
    duck.with_tables(
        "visible",
        sql="""SELECT state, count(*) AS customers, 'DATA_GOVERNOR' AS seen_by FROM people GROUP BY state
    UNION ALL SELECT state, count(*), 'DATA_USER' FROM visible GROUP BY state""",
    )
)
def row_filter_group_counts(spark: SparkSession, base: str) -> DataFrame:
    gov = customer_governance(spark, base)
    return _by_role(
        lambda role: gov.table("customers", role).to_df().groupBy("state").agg(F.count(F.lit(1)).alias("customers"))
    )


@query(
    """SELECT c_custkey, '***PII-REDACTED***' AS pii, '***-' || right(c_name, 4) AS restricted,
    left(c_name, 1) || repeat('*', length(c_name) - 1) AS sensitive, c_name AS internal, c_name AS untagged FROM customer"""
)
def mask_string(spark: SparkSession, base: str) -> DataFrame:
    customers = read_table(spark, base, "customer")
    return _all_levels(customers, "c_custkey", "c_name")


def _all_levels(df: DataFrame, key: str, column: str) -> DataFrame:
    dtype = df.schema[column].dataType
    levels = {"pii": "PII", "restricted": "RESTRICTED", "sensitive": "SENSITIVE", "internal": "INTERNAL", "untagged": None}
    return df.select(key, *[mask(F.col(column), level, dtype).alias(name) for name, level in levels.items()])


@query(
    f"""SELECT l_orderkey, CAST(NULL AS DOUBLE) AS pii, round(l_extendedprice, -2)::DOUBLE AS restricted,
    {duck.hash_long('l_orderkey::VARCHAR')} AS sensitive, l_extendedprice AS internal FROM lineitem"""
)
def mask_number(spark: SparkSession, base: str) -> DataFrame:
    lines = read_table(spark, base, "lineitem")
    price, key = lines.schema["l_extendedprice"].dataType, lines.schema["l_orderkey"].dataType
    return lines.select(
        "l_orderkey",
        mask(F.col("l_extendedprice"), "PII", price).alias("pii"),
        mask(F.col("l_extendedprice"), "RESTRICTED", price).alias("restricted"),
        mask(F.col("l_orderkey"), "SENSITIVE", key).alias("sensitive"),
        mask(F.col("l_extendedprice"), "INTERNAL", price).alias("internal"),
    )


@query(
    duck.with_tables(
        "people",
        sql="""SELECT c_custkey, CAST(NULL AS DATE) AS pii, date_trunc('year', birth_date)::DATE AS restricted,
    date_trunc('month', birth_date)::DATE AS sensitive, birth_date AS internal, birth_date AS untagged FROM people""",
    )
)
def mask_date(spark: SparkSession, base: str) -> DataFrame:
    return _all_levels(fx.people(spark, base), "c_custkey", "birth_date")


@query(
    """SELECT event_id, CAST(NULL AS TIMESTAMP) AS pii, date_trunc('day', ts)::TIMESTAMP AS restricted,
    date_trunc('month', ts)::TIMESTAMP AS sensitive, ts AS internal, ts AS untagged FROM events"""
)
def mask_timestamp(spark: SparkSession, base: str) -> DataFrame:
    return _all_levels(read_table(spark, base, "events"), "event_id", "ts")


@query(duck.with_tables("visible", sql="SELECT * FROM visible"))
def governed_select(spark: SparkSession, base: str) -> DataFrame:
    """What may the data user see: mapped states only, every tagged column masked by its type."""
    return customer_governance(spark, base).table("customers", DATA_USER).to_df()


@query(duck.with_tables("people", sql="SELECT * FROM people"))
def governed_select_clear(spark: SparkSession, base: str) -> DataFrame:
    return customer_governance(spark, base).table("customers", GOVERNOR).to_df()


@query(
    duck.with_tables(
        "visible",
        sql="""SELECT visible.* EXCLUDE (zip) FROM visible JOIN (SELECT c_custkey, zip AS raw_zip FROM people) USING (c_custkey)
    WHERE raw_zip NOT IN ('10003', '10044')""",
    )
)
def projection_guard(spark: SparkSession, base: str) -> DataFrame:
    gov = customer_governance(spark, base)
    gov.limit_projection("customers", "zip")
    table = gov.table("customers", DATA_USER)
    return table.where_hidden_in("zip", ["10003", "10044"], negate=True).exclude("zip").to_df()


@query(
    duck.with_tables(
        "feedback",
        sql=f"""SELECT o_orderkey, feedback, 'DATA_GOVERNOR' AS seen_by FROM feedback
    UNION ALL SELECT o_orderkey, {duck.redact('feedback')}, 'DATA_USER' FROM feedback
    UNION ALL SELECT o_orderkey, {duck.redact('feedback')}, 'OUTSIDER' FROM feedback""",
    )
)
def role_switched_text(spark: SparkSession, base: str) -> DataFrame:
    notes = fx.feedback(spark, base).select(
        "o_orderkey", F.col("feedback").alias("original"), redact(F.col("feedback")).alias("redacted")
    )
    return _by_role(lambda role: switch_by_role(notes, role, "original", "redacted", "feedback"))


@query(duck.with_tables("masked", sql="SELECT * FROM masked"))
def governed_copy(spark: SparkSession, base: str) -> DataFrame:
    """A copy of the customers inherits tags, hence masks, but not the row filter."""
    gov: Governance = customer_governance(spark, base)
    gov.register_derived("customer_copy", gov.raw("customers").select("*"), ["customers"])
    return gov.table("customer_copy", DATA_USER).to_df()
