"""Data-quality metrics, report cards and history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.operators import quality as dq
from custodia.sources import fixtures as fx
from custodia.sources import generators as gen
from custodia.sources import snapshots
from custodia.sources.tables import read_table
from custodia.workload import duck
from custodia.workload.basics import bad_leads_of, leads_of
from custodia.workload.registry import query

_GOOD = duck.names(gen.STATUSES)
_DUPLICATES = "coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}) WHERE n > 1), 0)::BIGINT"


def _metrics_sql(table: str) -> str:
    return f"""SELECT count(*) AS total_rows, count(*) FILTER (email IS NULL) AS null_emails, count(*) FILTER (trim(phone) = '') AS blank_phones,
      {_DUPLICATES.format(t=table, c='email')} AS duplicate_emails, count(*) FILTER (status NOT IN {_GOOD}) AS invalid_statuses,
      count(*) FILTER (deal_amount < 0 OR deal_amount > 1000000) AS bad_deal_amounts FROM {table}"""


_MINIMUM = 1000


def _report_sql(table: str) -> str:
    rows = [
        ("no_null_emails", "NULL_COUNT", "null_emails", "= 0"),
        ("no_blank_phones", "BLANK_COUNT", "blank_phones", "= 0"),
        ("no_duplicate_emails", "DUPLICATE_COUNT", "duplicate_emails", "= 0"),
        ("minimum_lead_volume", "ROW_COUNT", "total_rows", f">= {_MINIMUM}"),
        ("no_invalid_statuses", "ACCEPTED_VALUES", "invalid_statuses", "= 0"),
        ("no_out_of_range_deals", "DEAL_AMOUNT_OUT_OF_RANGE", "bad_deal_amounts", "= 0"),
    ]
    return f"WITH m AS ({_metrics_sql(table)}) " + " UNION ALL ".join(
        f"SELECT '{e}' AS expectation, '{k}' AS metric, {c} AS value, CASE WHEN {c} {test} THEN 'PASS' ELSE 'FAIL' END AS status FROM m"
        for e, k, c, test in rows
    )


def _metrics() -> list[dq.Metric]:
    return [e.metric for e in gen.lead_expectations(_MINIMUM)]


def _dirty(spark: SparkSession, base: str) -> DataFrame:
    return snapshots.insert_rows(leads_of(spark, base), bad_leads_of(spark, base))


@query(duck.with_tables("leads", sql=_metrics_sql("leads")))
def dq_inline(spark: SparkSession, base: str) -> DataFrame:
    return dq.measure(leads_of(spark, base), _metrics())


@query(duck.with_tables("leads", sql=_report_sql("leads")))
def dq_report(spark: SparkSession, base: str) -> DataFrame:
    return dq.report(leads_of(spark, base), gen.lead_expectations(_MINIMUM))


@query(
    duck.with_tables(
        "leads", "bad_leads", sql=_report_sql("(SELECT * FROM leads UNION ALL BY NAME SELECT * FROM bad_leads)")
    )
)
def dq_report_after_inject(spark: SparkSession, base: str) -> DataFrame:
    return dq.report(_dirty(spark, base), gen.lead_expectations(_MINIMUM))


@query(duck.with_tables("leads", sql=_report_sql("leads")))
def dq_report_after_cleanup(spark: SparkSession, base: str) -> DataFrame:
    clean = snapshots.delete_where(_dirty(spark, base), F.col("lead_id") < 0)
    return dq.report(clean, gen.lead_expectations(_MINIMUM))


def _event_metrics() -> list[dq.Metric]:
    return [
        dq.row_count("rows"),
        dq.null_count("null_users", "user_id"),
        dq.out_of_range("large_values", "value", 0, 100),
        dq.duplicate_count("repeated_users", "user_id"),
    ]


@query(
    """WITH d AS (SELECT ts::DATE AS day, * FROM events),
    m AS (SELECT day, count(*) AS rows, count(*) FILTER (user_id IS NULL) AS null_users, count(*) FILTER (value < 0 OR value > 100) AS large_values
          FROM d GROUP BY day),
    r AS (SELECT day, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS repeated_users FROM (
          SELECT day, user_id, count(*) AS n FROM d WHERE user_id IS NOT NULL GROUP BY 1, 2) GROUP BY day)
    SELECT day::TIMESTAMP AS measurement_time, 'events' AS table_name, metric_name, value
    FROM (UNPIVOT (SELECT * FROM m JOIN r USING (day)) ON rows, null_users, large_values, repeated_users INTO NAME metric_name VALUE value)"""
)
def dq_history(spark: SparkSession, base: str) -> DataFrame:
    """Daily measurements of the events, newest first."""
    events = read_table(spark, base, "events").withColumn("day", F.to_date("ts"))
    measured = dq.measure_rows(events, _event_metrics(), by=["day"])
    history = dq.history_rows(measured, F.col("day"), fx.DATABASE, "events")
    return dq.trend(history, fx.DATABASE, "events")


@query(
    duck.with_tables(
        "leads",
        sql=f"""WITH m AS ({_metrics_sql('leads')}) """
        + " UNION ALL ".join(
            f"SELECT '{kind}' AS metric, 'leads' AS table_name, {column} AS column_name, 'TRIGGER_ON_CHANGES' AS schedule, "
            f"'STARTED' AS schedule_status, {value} AS latest_value FROM m"
            for kind, column, value in (
                ("NULL_COUNT", "'email'", "null_emails"),
                ("BLANK_COUNT", "'phone'", "blank_phones"),
                ("DUPLICATE_COUNT", "'email'", "duplicate_emails"),
                ("ROW_COUNT", "NULL", "total_rows"),
                ("ACCEPTED_VALUES", "'status'", "invalid_statuses"),
                ("DEAL_AMOUNT_OUT_OF_RANGE", "'deal_amount'", "bad_deal_amounts"),
            )
        ),
    )
)
def dq_registry(spark: SparkSession, base: str) -> DataFrame:
    measured = dq.measure_rows(leads_of(spark, base), _metrics())
    return dq.registry(measured, _metrics(), "leads")


@query(
    """SELECT count(*) AS total_rows, count(*) FILTER (o_custkey IS NULL) AS null_customers,
      count(*) FILTER (trim(o_orderpriority) = '') AS blank_priorities,
      (SELECT sum(CASE WHEN n > 1 THEN n ELSE 0 END) FROM (SELECT count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey))::BIGINT AS repeat_customers,
      count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) AS other_status,
      count(*) FILTER (o_totalprice < 1000 OR o_totalprice > 400000) AS unusual_totals FROM orders"""
)
def dq_orders(spark: SparkSession, base: str) -> DataFrame:
    """The same rules on another table."""
    return dq.measure(
        read_table(spark, base, "orders"),
        [
            dq.row_count("total_rows"),
            dq.null_count("null_customers", "o_custkey"),
            dq.blank_count("blank_priorities", "o_orderpriority"),
            dq.duplicate_count("repeat_customers", "o_custkey"),
            dq.accepted_values("other_status", "o_orderstatus", lambda c: c.isin("O", "F")),
            dq.out_of_range("unusual_totals", "o_totalprice", 1000, 400000),
        ],
    )
