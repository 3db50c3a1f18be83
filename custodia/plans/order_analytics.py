"""The customer/order model: 15 dimensions, 7 metrics, 3 facts, one relationship."""

from custodia.plans.semantic import Dimension, Fact, LogicalTable, MetricDef, Relationship, SemanticModel

# Names and synonyms are fixed values: queries address them.
CUSTOMER_ORDER_ANALYTICS = SemanticModel(
    name="customer_order_analytics",
    tables=(
        LogicalTable("customers", "c_custkey", ("customer", "clients", "buyers")),
        LogicalTable("orders", "o_orderkey", ("sales orders", "transactions", "purchases")),
    ),
    relationships=(Relationship("orders", "o_custkey", "customers"),),
    facts=(
        Fact("order_amount_fact", "orders", "order_amount", "Before tax"),
        Fact("order_tax_fact", "orders", "order_tax", "Tax"),
        Fact("order_total_fact", "orders", "o_totalprice", "Including tax"),
    ),
    dimensions=(
        Dimension("customer_name", "customers", "concat(first_name, ' ', last_name)", ("full name", "name")),
        Dimension("first_name", "customers", "first_name"),
        Dimension("last_name", "customers", "last_name"),
        Dimension("email_address", "customers", "email", ("email", "contact email")),
        Dimension("phone", "customers", "phone", ("phone number", "contact number")),
        Dimension("location_state", "customers", "state", ("state", "region")),
        Dimension("location_city", "customers", "city", ("city", "town")),
        Dimension("company_name", "customers", "company", ("company", "employer", "organization")),
        Dimension("job_title", "customers", "job", ("job", "position", "role")),
        Dimension("customer_id", "customers", "c_custkey"),
        Dimension("order_id", "orders", "o_orderkey", ("order number",)),
        Dimension("order_date", "orders", "to_date(o_orderdate)", ("date", "order timestamp")),
        Dimension("order_year", "orders", "year(o_orderdate)"),
        Dimension("order_month", "orders", "month(o_orderdate)"),
        Dimension("currency", "orders", "order_currency", ("order currency",)),
    ),
    metrics=(
        MetricDef("customer_count", "customers", "count", "c_custkey"),
        MetricDef("total_revenue", "orders", "sum", "order_total_fact", ("total sales", "revenue"), digits=2),
        MetricDef("total_orders", "orders", "count", "o_orderkey", ("order count", "number of orders")),
        MetricDef("average_order_value", "orders", "avg", "order_total_fact", ("AOV", "avg order"), digits=2),
        MetricDef("total_tax", "orders", "sum", "order_tax_fact", digits=2),
        MetricDef("max_order", "orders", "max", "order_total_fact"),
        MetricDef("min_order", "orders", "min", "order_total_fact"),
    ),
)
