import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from custodia.functions.masks import HIDDEN_TEXT
from custodia.operators.governance import (
    ADMIN,
    DATA_USER,
    ENGINEER,
    GOVERNOR,
    IT_ADMIN,
    Governance,
    PolicyError,
    grouped_by_key,
    switch_by_role,
)
from custodia.operators.row_filters import AttributeFilter, MappingFilter, ParentFilter, roles
from custodia.operators.governance import FULL_CLEAR
from custodia.workload.scenario import governance, optin_filter, state_filter

ALL = {"a", "b", "c", "d"}


@pytest.fixture()
def gov(spark):
    customers = spark.createDataFrame(
        [
            ("a", "CA", "Y", "a@x.com", "90210", "Ann"),
            ("b", "NY", "N", "b@x.com", "10001", "Bob"),
            ("c", "TX", None, None, "73301", None),
            ("d", None, "Y", "d@x.com", "00000", "Di"),
        ],
        "id string, state string, optin string, email string, zip string, name string",
    )
    g = Governance()
    g.register("customers", customers, {"email": "PII", "zip": "SENSITIVE", "name": "SENSITIVE"})
    return g


def _ids(gov, role, table="customers"):
    return {r["id"] for r in gov.table(table, role).select("id").to_df().collect()}


def _states(spark):
    mapping = spark.createDataFrame([(DATA_USER, "CA"), (DATA_USER, "TX"), ("OTHER", "NY")], "role string, visible_value string")
    return MappingFilter("states", "state", mapping, FULL_CLEAR)


def test_attribute_filter_roles(gov):
    gov.add_row_filter("customers", optin_filter())
    for role in (ENGINEER, GOVERNOR, ADMIN, IT_ADMIN):
        assert _ids(gov, role) == ALL
    assert _ids(gov, DATA_USER) == {"a", "d"}  # NULL status is hidden
    assert _ids(gov, "SOMEBODY") == set()


def test_mapping_filter_roles(gov, spark):
    gov.add_row_filter("customers", _states(spark))
    assert _ids(gov, GOVERNOR) == ALL
    assert _ids(gov, DATA_USER) == {"a", "c"}  # NULL state is hidden
    assert _ids(gov, "OTHER") == {"b"}
    assert _ids(gov, IT_ADMIN) == set()  # neither in the open list nor in the map


def test_swap_row_filter(gov, spark):
    gov.add_row_filter("customers", optin_filter())
    with pytest.raises(PolicyError):
        gov.add_row_filter("customers", _states(spark))
    gov.drop_row_filter("customers")
    assert _ids(gov, DATA_USER) == ALL
    gov.add_row_filter("customers", _states(spark))
    assert _ids(gov, DATA_USER) == {"a", "c"}


def test_masks_by_role(gov):
    row = gov.table("customers", DATA_USER).to_df().filter("id = 'c'").first()
    assert (row["email"], row["zip"], row["name"]) == (HIDDEN_TEXT, "7****", None)
    row = gov.table("customers", GOVERNOR).to_df().filter("id = 'a'").first()
    assert (row["email"], row["zip"]) == ("a@x.com", "90210")


def test_non_null_mask_changes_null_counts(gov):
    count = lambda role: gov.table("customers", role).to_df().agg(F.count("email")).first()[0]
    assert (count(GOVERNOR), count(DATA_USER)) == (3, 4)


def test_predicate_sees_masked_value(gov):
    df = gov.table("customers", DATA_USER).to_df()
    assert df.filter("email = 'a@x.com'").count() == 0
    assert df.filter(F.col("email") == HIDDEN_TEXT).count() == 4


def test_projection_limit(gov):
    gov.limit_projection("customers", "zip")
    table = gov.table("customers", DATA_USER)
    with pytest.raises(PolicyError):
        table.to_df()
    with pytest.raises(PolicyError):
        table.select("id", "zip")
    assert "zip" not in table.exclude("zip").to_df().columns
    found = table.where_hidden_in("zip", ["90210", "10001"]).exclude("zip").to_df().collect()
    assert {r["id"] for r in found} == {"a", "b"}
    assert found[0]["email"] == HIDDEN_TEXT  # masks stay on
    with pytest.raises(PolicyError):
        table.where_hidden_in("email", ["a@x.com"])
    assert "zip" in gov.table("customers", GOVERNOR).to_df().columns


def test_raw_values_cannot_be_filtered_or_sorted_on(gov):
    seen = gov.table("customers", DATA_USER).select("id").to_df()
    for attempt in (lambda: seen.filter("email = 'a@x.com'"), lambda: seen.orderBy("zip"), lambda: seen.select("name")):
        with pytest.raises(AnalysisException):
            attempt().collect()
    gov.limit_projection("customers", "zip")
    rest = gov.table("customers", DATA_USER).exclude("zip").to_df()
    for attempt in (lambda: rest.filter(F.col("zip") > "10050"), lambda: rest.orderBy("zip"), lambda: rest.where("zip like '9%'")):
        with pytest.raises(AnalysisException):
            attempt().collect()
    assert rest.filter("state = 'CA'").orderBy("id").count() == 1  # what is visible works


@pytest.mark.parametrize("spelling", ["zip", "ZIP", "`zip`", "`Zip`"])
def test_limits_hold_for_every_spelling(gov, spelling):
    gov.limit_projection("customers", "Zip")
    table = gov.table("customers", DATA_USER)
    with pytest.raises(PolicyError):
        table.select("id", spelling)
    assert "zip" not in table.exclude(spelling).to_df().columns
    assert table.where_hidden_in(spelling, ["90210"]).exclude("zip").to_df().count() == 1


def test_unknown_columns_are_refused(gov):
    with pytest.raises(PolicyError):
        gov.limit_projection("customers", "no_such")
    for name in ("*", "no_such", "upper(zip)"):
        with pytest.raises(PolicyError):
            gov.table("customers", DATA_USER).select(name)


def test_set_tags_adds_and_unset_removes(gov):
    gov.set_tags("customers", {"STATE": "INTERNAL"})
    assert gov.tags("customers") == {"email": "PII", "zip": "SENSITIVE", "name": "SENSITIVE", "state": "INTERNAL"}
    gov.unset_tags("customers", "zip", "state")
    assert gov.tags("customers") == {"email": "PII", "name": "SENSITIVE"}


def test_grouping_by_key_keeps_the_other_limits(with_orders):
    grouped = lambda: grouped_by_key(with_orders, "orders", DATA_USER, "customer", [], [F.sum("total").alias("t")])
    with_orders.limit_aggregation("orders", 100)
    with pytest.raises(PolicyError):
        grouped()
    with_orders.limit_aggregation("orders", None)
    with_orders.limit_projection("orders", "total")
    with pytest.raises(PolicyError):
        grouped()
    assert grouped_by_key(with_orders, "orders", GOVERNOR, "customer", [], [F.sum("total").alias("t")]).count() == 5


def test_masked_columns_stay_tagged(gov):
    df = gov.table("customers", DATA_USER).to_df()
    derived = Governance()
    derived.register("copy", df.select("id", "email"))
    assert derived.tags("copy") == {"email": "PII"}


def test_derived_table_is_masked_but_not_filtered(gov, spark):
    gov.add_row_filter("customers", _states(spark))
    gov.register_derived("copy", gov.raw("customers").select("*"), ["customers"])
    assert gov.tags("copy") == gov.tags("customers")
    rows = gov.table("copy", DATA_USER).to_df().collect()
    assert {r["id"] for r in rows} == ALL and {r["email"] for r in rows} == {HIDDEN_TEXT}


@pytest.fixture()
def with_orders(gov, spark):
    # keys of another type, one of them unusable, and one customer with most of the orders
    orders = spark.createDataFrame(
        [("1", 10.0), ("1", 20.0), ("1", 30.0), ("2", 5.0), ("x", 7.0), (None, 8.0), ("3", 1.0)], "customer string, total double"
    )
    parents = spark.createDataFrame([(1.0, "CA"), (2.0, "NY"), (3.0, "TX")], "id double, state string")
    states = _states(spark)
    gov.register("parents", parents, {})
    gov.register("orders", orders, {})
    gov.add_row_filter("parents", states)
    gov.add_row_filter("orders", ParentFilter("by_parent", "customer", gov.raw("parents"), "id", states, FULL_CLEAR))
    return gov


def test_cascading_filter(with_orders):
    total = lambda role: with_orders.table("orders", role).to_df().agg(F.sum("total")).first()[0]
    assert total(GOVERNOR) == 81.0
    assert total(DATA_USER) == 61.0
    assert total(IT_ADMIN) is None


def test_filter_on_groups_equals_filter_on_rows(with_orders):
    rows = with_orders.table("orders", DATA_USER).to_df().groupBy("customer").agg(F.sum("total").alias("t"))
    groups = grouped_by_key(with_orders, "orders", DATA_USER, "customer", [], [F.sum("total").alias("t")])
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, groups.collect())) == [("1", 60.0), ("3", 1.0)]


def test_role_switched_text(spark):
    df = spark.createDataFrame([(1, "raw", "[X]")], "id int, original string, redacted string")
    with pytest.raises(AnalysisException):
        switch_by_role(df, DATA_USER, "original", "redacted", "text").filter("original = 'raw'").collect()
    shown = lambda role: switch_by_role(df, role, "original", "redacted", "text").first()["text"]
    assert [shown(r) for r in (GOVERNOR, ADMIN, ENGINEER, DATA_USER)] == ["raw", "raw", "[X]", "[X]"]


def test_no_clear_value_reaches_data_user(spark, base):
    """Every string of a tagged column in the clear must be absent from what the data user gets."""
    gov = governance(spark, base)
    clear = gov.raw("customers")
    seen = gov.table("customers", DATA_USER).to_df()
    for column, level in gov.tags("customers").items():
        if level in ("PII", "RESTRICTED", "SENSITIVE") and dict(clear.dtypes)[column] == "string":
            leaked = seen.select(column).intersect(clear.select(column)).count()
            assert leaked == 0, column


def test_only_mapped_states(spark, base):
    gov = governance(spark, base)
    states = {r["state"] for r in gov.table("customers", DATA_USER).to_df().select("state").distinct().collect()}
    assert states <= {"NATION_3", "NATION_7", "NATION_11"} and states
    assert state_filter(spark).visible_values(DATA_USER).count() == 3


def test_custom_roles(spark):
    f = AttributeFilter("f", "x", "Y", roles("A"), roles("B", "C"))
    df = spark.createDataFrame([("Y",), ("N",)], "x string")
    assert [f.apply(df, r).count() for r in "ABCD"] == [2, 1, 1, 0]
