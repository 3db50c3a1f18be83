import pytest

from custodia.operators.governance import DATA_USER, GOVERNOR, grouped_by_key
from custodia.plans.order_analytics import CUSTOMER_ORDER_ANALYTICS as MODEL
from custodia.plans.semantic import SemanticError
from custodia.plans.trade_analytics import TRADE_ANALYTICS as TRADE
from custodia.workload.scenario import governance


@pytest.fixture(scope="module")
def load(spark, base):
    gov = governance(spark, base)
    return lambda role: lambda t: gov.table(t, role).to_df()


def test_model_size():
    assert (len(MODEL.dimensions), len(MODEL.metrics), len(MODEL.facts)) == (15, 7, 3)
    assert len(MODEL.catalog()) == 25


def test_synonyms_and_unknown_names():
    resolve = lambda n: MODEL.resolve(n, type(MODEL.dimensions[0])).name
    assert resolve("full name") == resolve("customers.customer_name") == "customer_name"
    assert resolve("EMAIL") == "email_address"
    with pytest.raises(SemanticError):
        resolve("total_revenue")
    with pytest.raises(SemanticError):
        resolve("nonsense")


def test_one_table_queries_read_one_table(load):
    seen = []

    def spy(table):
        seen.append(table)
        return load(GOVERNOR)(table)

    MODEL.query(spy, ["currency"], ["total_orders"])
    MODEL.query(spy, ["location_city"], ["customer_count"])
    assert seen == ["orders", "customers"]


def test_multiplying_metric_is_refused(load):
    with pytest.raises(SemanticError):
        MODEL.query(load(GOVERNOR), ["order_year"], ["customer_count"])


def test_totals_without_dimensions(load, spark, base):
    row = MODEL.query(load(GOVERNOR), [], ["customer_count", "total_orders"]).first()
    assert row["customer_count"] == spark.read.parquet(f"{base}/customer.parquet").count()
    assert row["total_orders"] == spark.read.parquet(f"{base}/orders.parquet").count()


def test_governed_result_is_filtered_and_masked(load):
    rows = MODEL.query(load(DATA_USER), ["customer_name", "email_address", "location_state"], ["total_revenue"]).collect()
    assert rows and {r["location_state"] for r in rows} <= {"NATION_3", "NATION_7", "NATION_11"}
    assert {r["email_address"] for r in rows} == {"***PII-REDACTED***"}
    assert all("First" not in r["customer_name"] and r["customer_name"].startswith("F*") for r in rows)


def test_null_dimension_only_without_cascade(spark, base):
    for cascade in (True, False):
        gov = governance(spark, base, cascade)
        out = MODEL.query(
            lambda t, g=gov: g.table(t, DATA_USER).to_df(),
            ["location_state"],
            ["total_orders"],
            lambda t, *grouping, g=gov: grouped_by_key(g, t, DATA_USER, *grouping),
        )
        assert (None in {r["location_state"] for r in out.collect()}) is not cascade


def test_late_filter_changes_nothing(load, spark, base):
    gov = governance(spark, base)
    args = (["location_state", "order_year"], ["total_revenue", "average_order_value", "max_order", "min_order"])
    plain = MODEL.query(load(DATA_USER), *args)
    late = MODEL.query(load(DATA_USER), *args, lambda t, *grouping: grouped_by_key(gov, t, DATA_USER, *grouping))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, late.collect()))


def _tables(spark, base, seen=None):
    def load(table):
        if seen is not None:
            seen.append(table)
        return spark.read.parquet(f"{base}/{table}.parquet")

    return load


def test_ways_through_the_model():
    names = lambda a, b: [[r.name for r in p] for p in TRADE.paths(a, b)]
    assert names("orders", "region") == [["orders_to_customer", "customer_to_nation", "nation_to_region"]]
    assert len(names("lineitem", "region")) == 2 and names("nation", "orders") == [] and names("orders", "orders") == [[]]


def test_two_ways_are_refused_unless_one_is_named(spark, base):
    load = _tables(spark, base)
    for via in ((), ("nation_to_region",), ("lineitem_to_orders", "lineitem_to_supplier")):
        with pytest.raises(SemanticError, match="2 ways"):
            TRADE.query(load, ["region_name"], ["net_revenue"], via=via)
    with pytest.raises(SemanticError, match="no relationship"):
        TRADE.query(load, ["region_name"], ["net_revenue"], via=["nope"])
    one, two = (TRADE.query(load, ["nation_name"], ["line_count"], via=[v]) for v in ("orders_to_customer", "lineitem_to_supplier"))
    assert sorted(map(tuple, one.collect())) != sorted(map(tuple, two.collect()))


def test_no_way_from_one_to_many(spark, base):
    load = _tables(spark, base)
    with pytest.raises(SemanticError, match="would multiply"):
        TRADE.query(load, ["order_year"], ["buyer_count"])
    with pytest.raises(SemanticError, match="not related"):
        TRADE.query(load, ["supplier_name"], ["order_count"])


def test_a_join_multiplies_nothing(spark, base):
    """Totals over any dimension add up to the table's rows, however many joins there are; only needed tables are read."""
    lines = spark.read.parquet(f"{base}/lineitem.parquet").count()
    for dims, via, tables in (
        (["region_name"], ["lineitem_to_orders"], ["lineitem", "orders", "customer", "nation", "region"]),
        (["region_name", "supplier_name"], ["lineitem_to_supplier"], ["lineitem", "supplier", "nation", "region"]),
        (["supplier_name", "segment", "order_year"], [], ["lineitem", "supplier", "orders", "customer"]),
        (["return_flag"], [], ["lineitem"]),
    ):
        seen = []
        out = TRADE.query(_tables(spark, base, seen), dims, ["line_count"], via=via).collect()
        assert sum(r["line_count"] for r in out) == lines and sorted(seen) == sorted(tables)


def test_children_without_a_parent_keep_null(spark):
    tables = {
        "orders": spark.createDataFrame([(1, 10, 5.0), (2, None, 1.0), (3, 77, 2.0)], "o_orderkey int, o_custkey int, o_totalprice double"),
        "customer": spark.createDataFrame([(10, 4), (11, None)], "c_custkey int, c_nationkey int"),
        "nation": spark.createDataFrame([(4, 9, "X")], "n_nationkey int, n_regionkey int, n_name string"),
    }
    out = TRADE.query(tables.get, ["nation_name"], ["order_count", "largest_order", "buyer_count"])
    assert {tuple(r) for r in out.collect()} == {("X", 1, 5.0, 1), (None, 2, 2.0, 1)}


def test_a_model_names_its_relationships_once():
    from dataclasses import replace

    with pytest.raises(SemanticError):
        replace(TRADE, relationships=[*TRADE.relationships, TRADE.relationships[0]])


def test_groups_shrink_before_every_join(spark, base):
    from tests.test_plans import plan

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = TRADE.query(_tables(spark, base), ["region_name"], ["net_revenue"], via=["lineitem_to_orders"])
        joins = plan(out, "simple").count("SortMergeJoin")
        assert joins == 4 and plan(out, "simple").count("HashAggregate") >= 2 * 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
