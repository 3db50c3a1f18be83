"""Queries through the metrics layer, plain and governed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.operators.governance import DATA_USER, ENGINEER, GOVERNOR, grouped_by_key
from custodia.plans.order_analytics import CUSTOMER_ORDER_ANALYTICS as MODEL
from custodia.plans.trade_analytics import TRADE_ANALYTICS as TRADE
from custodia.sources.tables import read_table
from custodia.workload import duck
from custodia.workload.registry import query
from custodia.workload.scenario import governance


def _query(spark: SparkSession, base: str, role: str, dimensions, metrics, cascade: bool = True) -> DataFrame:
    gov = governance(spark, base, cascade)
    return MODEL.query(
        lambda t: gov.table(t, role).to_df(), dimensions, metrics, lambda t, *grouping: grouped_by_key(gov, t, role, *grouping)
    )


_JOINED = "FROM sales LEFT JOIN people ON o_custkey = c_custkey"


@query(
    duck.with_tables(
        "people",
        "sales",
        sql=f"""SELECT state AS location_state, round(sum(o_totalprice), 2) AS total_revenue, count(o_orderkey) AS total_orders
    {_JOINED} GROUP BY state""",
    )
)
def semantic_by_region(spark: SparkSession, base: str) -> DataFrame:
    out = _query(spark, base, GOVERNOR, ["location_state"], ["total_revenue", "total_orders"])
    return out.orderBy(F.desc("total_revenue"))


@query(
    duck.with_tables(
        "people",
        "sales",
        sql=f"""SELECT first_name || ' ' || last_name AS customer_name, company AS company_name, round(sum(o_totalprice), 2) AS total_revenue,
    count(o_orderkey) AS total_orders {_JOINED} GROUP BY 1, 2 ORDER BY total_revenue DESC, customer_name LIMIT 10""",
    )
)
def semantic_top_customers(spark: SparkSession, base: str) -> DataFrame:
    out = _query(spark, base, GOVERNOR, ["full name", "employer"], ["revenue", "order count"])
    return out.orderBy(F.desc("total_revenue"), "customer_name").limit(10)


@query(
    duck.with_tables(
        "sales",
        sql="""SELECT year(o_orderdate)::INT AS order_year, month(o_orderdate)::INT AS order_month, round(sum(o_totalprice), 2) AS total_revenue,
    round(avg(o_totalprice), 2) AS average_order_value FROM sales GROUP BY 1, 2""",
    )
)
def semantic_by_month(spark: SparkSession, base: str) -> DataFrame:
    out = _query(spark, base, GOVERNOR, ["order_year", "order_month"], ["total_revenue", "average_order_value"])
    return out.orderBy("order_year", "order_month")


@query(
    duck.with_tables(
        "sales",
        sql="""SELECT order_currency AS currency, round(sum(o_totalprice), 2) AS total_revenue, count(o_orderkey) AS total_orders,
    round(avg(o_totalprice), 2) AS average_order_value, round(sum(order_tax), 2) AS total_tax, max(o_totalprice) AS max_order,
    min(o_totalprice) AS min_order FROM sales GROUP BY 1""",
    )
)
def semantic_by_currency(spark: SparkSession, base: str) -> DataFrame:
    metrics = ["total_revenue", "total_orders", "AOV", "total_tax", "max_order", "min_order"]
    return _query(spark, base, GOVERNOR, ["currency"], metrics)


@query(
    duck.with_tables(
        "visible_sales",
        sql="""SELECT first_name || ' ' || last_name AS customer_name, email AS email_address, state AS location_state,
    round(sum(o_totalprice), 2) AS total_revenue FROM visible_sales LEFT JOIN visible ON o_custkey = c_custkey GROUP BY 1, 2, 3""",
    )
)
def semantic_governed(spark: SparkSession, base: str) -> DataFrame:
    """Row filters and masks of the base tables act with no setting of the model."""
    dims = ["customer_name", "email_address", "location_state"]
    return _query(spark, base, DATA_USER, dims, ["total_revenue"])


@query(
    duck.with_tables(
        "visible",
        "sales",
        sql="""SELECT state AS location_state, round(sum(o_totalprice), 2) AS total_revenue
    FROM sales LEFT JOIN visible ON o_custkey = c_custkey GROUP BY 1""",
    )
)
def semantic_without_cascade(spark: SparkSession, base: str) -> DataFrame:
    """Orders of hidden customers under a NULL state: what the cascading filter is there to stop."""
    return _query(spark, base, DATA_USER, ["location_state"], ["total_revenue"], cascade=False)


@query(
    duck.with_tables(
        "visible_sales",
        sql="""SELECT state AS location_state, round(sum(o_totalprice), 2) AS total_revenue, count(o_orderkey) AS total_orders
    FROM visible_sales LEFT JOIN visible ON o_custkey = c_custkey GROUP BY 1""",
    )
)
def semantic_governed_by_region(spark: SparkSession, base: str) -> DataFrame:
    return _query(spark, base, DATA_USER, ["location_state"], ["total_revenue", "total_orders"])


@query(
    duck.with_tables(
        "people",
        "sales",
        sql=f"""SELECT location_state, customer_count, total_revenue, total_orders FROM
      (SELECT state AS location_state, count(c_custkey) AS customer_count FROM people GROUP BY state)
      FULL JOIN (SELECT state AS location_state, round(sum(o_totalprice), 2) AS total_revenue, count(o_orderkey) AS total_orders
        {_JOINED} GROUP BY state) USING (location_state)""",
    )
)
def semantic_no_fanout(spark: SparkSession, base: str) -> DataFrame:
    """Customers are counted once, however many orders they have."""
    return _query(spark, base, ENGINEER, ["location_state"], ["customer_count", "total_revenue", "total_orders"])


def _trade(spark: SparkSession, base: str, dimensions, metrics, via=()) -> DataFrame:
    return TRADE.query(lambda t: read_table(spark, base, t), dimensions, metrics, via=via)


_LINES = """FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
_NET = "round(sum(l_extendedprice * (1 - l_discount)), 2) AS net_revenue"


@query(f"SELECT r_name AS region_name, {_NET}, round(avg(l_quantity), 4) AS average_quantity, count(*) AS line_count {_LINES} GROUP BY 1")
def trade_by_buyer_region(spark: SparkSession, base: str) -> DataFrame:
    """Four joins up from the line items, by way of the order."""
    metrics = ["turnover", "average_quantity", "line_count"]
    return _trade(spark, base, ["continent"], metrics, ["lineitem_to_orders"])


@query(
    f"""SELECT r_name AS region_name, n_name AS nation_name, {_NET} FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2"""
)
def trade_by_vendor_nation(spark: SparkSession, base: str) -> DataFrame:
    """The same dimensions by the other way."""
    return _trade(spark, base, ["region_name", "nation_name"], ["net_revenue"], ["lineitem_to_supplier"])


@query(f"SELECT c_mktsegment AS segment, year(o_orderdate)::INT AS order_year, l_returnflag AS return_flag, count(*) AS line_count {_LINES} GROUP BY 1, 2, 3")
def trade_by_segment_and_year(spark: SparkSession, base: str) -> DataFrame:
    """Dimensions of three tables on one way."""
    return _trade(spark, base, ["segment", "order_year", "return_flag"], ["line_count"])


@query(
    """SELECT s_name AS supplier_name, c_mktsegment AS segment, count(*) AS line_count FROM lineitem
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""
)
def trade_by_vendor_and_segment(spark: SparkSession, base: str) -> DataFrame:
    """Two ways at once, to different tables."""
    return _trade(spark, base, ["supplier_name", "segment"], ["line_count"])


@query(
    f"""SELECT nation_name, net_revenue, order_count, largest_order, buyer_count FROM
      (SELECT n_name AS nation_name, {_NET} {_LINES} GROUP BY 1)
      FULL JOIN (SELECT n_name AS nation_name, count(o_orderkey) AS order_count, max(o_totalprice) AS largest_order FROM orders
        LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) USING (nation_name)
      FULL JOIN (SELECT n_name AS nation_name, count(c_custkey) AS buyer_count FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1) USING (nation_name)"""
)
def trade_at_three_grains(spark: SparkSession, base: str) -> DataFrame:
    """Lines, orders and customers per nation, each counted at its own grain."""
    metrics = ["net_revenue", "order_count", "largest_order", "buyer_count"]
    return _trade(spark, base, ["country"], metrics, ["lineitem_to_orders"])


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}_to_{p}' AS relationship, (SELECT count(*) FROM {c}) AS child_rows,
      (SELECT count(*) FROM {c} WHERE {fk} IS NULL OR {fk} NOT IN (SELECT {pk} FROM {p})) AS without_parent,
      (SELECT count(*) FROM (SELECT {pk} FROM {p} GROUP BY 1 HAVING count(*) > 1)) AS repeated_keys"""
        for c, fk, p, pk in (
            ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("orders", "o_custkey", "customer", "c_custkey"),
            ("customer", "c_nationkey", "nation", "n_nationkey"),
            ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("supplier", "s_nationkey", "nation", "n_nationkey"),
            ("nation", "n_regionkey", "region", "r_regionkey"),
        )
    )
)
def trade_key_check(spark: SparkSession, base: str) -> DataFrame:
    """What the model claims of its keys, counted."""
    return TRADE.check_keys(lambda t: read_table(spark, base, t))


def _catalog_sql() -> str:
    rows = []
    for kind, table, name, definition, synonyms in MODEL.catalog():
        source = "people" if table == "customers" else "sales"
        item = next((i for i in [*MODEL.facts, *MODEL.dimensions] if i.name == name and kind != "METRIC"), None)
        expression = "NULL::BIGINT"
        if item is not None:
            duck_expression = (
                item.expression.replace("to_date(o_orderdate)", "o_orderdate::DATE")
                .replace("concat(first_name, ' ', last_name)", "first_name || ' ' || last_name")
            )
            expression = f"(SELECT count({duck_expression}) FROM {source})"
        quoted = definition.replace("'", "''")
        rows.append(
            f"SELECT '{kind}' AS kind, '{table}' AS logical_table, '{name}' AS name, '{quoted}' AS definition, "
            f"'{synonyms}' AS synonyms, {expression} AS n_values"
        )
    return " UNION ALL ".join(rows)


@query(duck.with_tables("people", "sales", sql=_catalog_sql()))
def semantic_catalog(spark: SparkSession, base: str) -> DataFrame:
    """Facts, dimensions and metrics with the number of values behind each."""
    gov = governance(spark, base)
    return MODEL.describe(lambda t: gov.table(t, GOVERNOR).to_df())
