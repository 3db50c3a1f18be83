"""The governed scenario: customers and orders with their policies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from custodia.operators.governance import DATA_USER, FULL_CLEAR, IT_ADMIN, Governance
from custodia.operators.row_filters import AttributeFilter, MappingFilter, ParentFilter, roles
from custodia.sources import fixtures as fx


def optin_filter() -> AttributeFilter:
    return AttributeFilter("customer_optin", "optin", "Y", FULL_CLEAR | roles(IT_ADMIN), roles(DATA_USER))


def state_filter(spark: SparkSession) -> MappingFilter:
    return MappingFilter("customer_state", "state", fx.row_policy_map(spark), FULL_CLEAR)


def orders_filter(customers: DataFrame, states: MappingFilter) -> ParentFilter:
    return ParentFilter("orders_of_visible_customers", "o_custkey", customers, "c_custkey", states, FULL_CLEAR)


def customer_governance(spark: SparkSession, base: str) -> Governance:
    """Tagged customers, filtered by state."""
    gov = Governance()
    gov.register("customers", fx.people(spark, base), fx.PEOPLE_TAGS)
    gov.add_row_filter("customers", state_filter(spark))
    return gov


def governance(spark: SparkSession, base: str, cascade: bool = True) -> Governance:
    """Customers and their orders; with ``cascade`` the orders of hidden customers are hidden too."""
    gov = customer_governance(spark, base)
    gov.register("orders", fx.sales(spark, base), {})
    states = state_filter(spark)
    if cascade:
        gov.add_row_filter("orders", orders_filter(gov.raw("customers"), states))
    return gov
