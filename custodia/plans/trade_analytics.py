"""The trade model: line items up to regions, by the customer's way and by the supplier's."""

from custodia.plans.semantic import Dimension, Fact, LogicalTable, MetricDef, Relationship, SemanticModel

TRADE_ANALYTICS = SemanticModel(
    name="trade_analytics",
    tables=(
        LogicalTable("lineitem", "concat(l_orderkey, '-', l_linenumber)", ("lines",)),
        LogicalTable("orders", "o_orderkey"),
        LogicalTable("customer", "c_custkey", ("buyers",)),
        LogicalTable("supplier", "s_suppkey", ("vendors",)),
        LogicalTable("nation", "n_nationkey", ("countries",)),
        LogicalTable("region", "r_regionkey", ("continents",)),
    ),
    relationships=(
        Relationship("lineitem", "l_orderkey", "orders"),
        Relationship("orders", "o_custkey", "customer"),
        Relationship("customer", "c_nationkey", "nation"),
        Relationship("lineitem", "l_suppkey", "supplier"),
        Relationship("supplier", "s_nationkey", "nation"),
        Relationship("nation", "n_regionkey", "region"),
    ),
    facts=(Fact("net_price", "lineitem", "l_extendedprice * (1 - l_discount)", "After discount"),),
    dimensions=(
        Dimension("return_flag", "lineitem", "l_returnflag"),
        Dimension("order_year", "orders", "year(o_orderdate)", ("year",)),
        Dimension("segment", "customer", "c_mktsegment", ("market",)),
        Dimension("supplier_name", "supplier", "s_name", ("vendor",)),
        Dimension("nation_name", "nation", "n_name", ("country",)),
        Dimension("region_name", "region", "r_name", ("continent",)),
    ),
    metrics=(
        MetricDef("net_revenue", "lineitem", "sum", "net_price", ("turnover",), digits=2),
        MetricDef("average_quantity", "lineitem", "avg", "l_quantity", digits=4),
        MetricDef("line_count", "lineitem", "count", "l_orderkey"),
        MetricDef("order_count", "orders", "count", "o_orderkey"),
        MetricDef("largest_order", "orders", "max", "o_totalprice"),
        MetricDef("buyer_count", "customer", "count", "c_custkey"),
        MetricDef("vendor_count", "supplier", "count", "s_suppkey"),
    ),
)
