"""Classification, tags and masks inside nested columns."""

import pytest
from pyspark.sql import functions as F

from custodia.operators import classify as cl
from custodia.operators.governance import DATA_USER, GOVERNOR, Governance
from custodia.operators.paths import leaves, nested_paths
from custodia.operators.tags import apply_tags, inherit, level_of, tags_of, union

DEEP = (
    "id int, who struct<name: string, `odd.name`: string, links: array<struct<kind: string, mails: array<string>>>>, "
    "notes map<string, struct<mail: string, n: int>>, by_mail map<string, int>, by_number map<int, string>, amounts array<double>"
)


@pytest.fixture()
def deep(spark):
    rows = [
        (
            i,
            {"name": "Ann", "odd.name": f"p{i}@x.org", "links": [{"kind": "a", "mails": [f"a{i}@x.org", None]}, None, {"kind": "b", "mails": None}]},
            {"first": {"mail": f"m{i}@x.org", "n": i}, "second": None},
            {f"k{i}@x.org": 1, f"l{i}@x.org": 2},
            {1: "x", i + 2: "y"},
            [1.5, 4000123400000000.0 + i],
        )
        for i in range(10)
    ]
    return spark.createDataFrame([*rows, (99, None, None, None, None, None), (98, {"name": None, "odd.name": None, "links": []}, {}, {}, {}, [])], DEEP)


def test_places(deep):
    assert [p.path for p in leaves(deep.schema)] == [
        "id", "who.name", "who.odd.name", "who.links[].kind", "who.links[].mails[]", "notes{key}", "notes{}.mail", "notes{}.n",
        "by_mail{key}", "by_mail{}", "by_number{key}", "by_number{}", "amounts[]",
    ]
    assert nested_paths(deep.schema)["who.links[].mails[]"].name == "mails"


def test_found_inside(deep):
    found = {r.column_name: (r.semantic_category, r.match_ratio) for r in cl.classify(deep).collect()}
    assert found == {
        "who.odd.name": ("EMAIL", 1.0),
        "who.links[].mails[]": ("EMAIL", 1.0),
        "notes{}.mail": ("EMAIL", 1.0),
        "by_mail{key}": ("EMAIL", 1.0),
        "amounts[]": ("CREDIT_CARD_NUMBER", 1.0),  # of the whole numbers
    }


def test_masked_inside(deep):
    tagged = cl.apply_classification(deep, cl.classify(deep))
    tagged = apply_tags(tagged, {**tags_of(tagged), "who.name": "SENSITIVE", "by_number{key}": "PII", "notes{}.n": "PII"})
    gov = Governance()
    gov.register("deep", tagged)
    shown = {r.id: r for r in gov.table("deep", DATA_USER).to_df().collect()}
    hidden = "***PII-REDACTED***"
    row = shown[3]
    assert row.who.name == "A**" and row.who["odd.name"] == hidden
    assert [None if x is None else (x.kind, x.mails) for x in row.who.links] == [("a", [hidden, hidden]), None, ("b", None)]
    assert row.notes["first"].mail == hidden and row.notes["first"].n is None and row.notes["second"] is None
    assert set(row.by_mail) == {f"{hidden}#1", f"{hidden}#2"} and set(row.by_mail.values()) == {1, 2}
    assert row.by_number is None and row.amounts == [None, None]
    assert shown[99].who is None and shown[99].by_mail is None and shown[98].who.links == [] and shown[98].by_mail == {}
    assert [f.dataType for f in gov.table("deep", DATA_USER).to_df().schema.fields] is not None
    clear = {r.id: r for r in gov.table("deep", GOVERNOR).to_df().collect()}
    assert clear[3].who["odd.name"] == "p3@x.org"
    assert "@" not in str(list(shown.values()))


def test_filters_see_the_mask(deep):
    gov = Governance()
    gov.register("deep", deep, {"notes{}.mail": "PII"})
    rows = gov.table("deep", DATA_USER).to_df()
    assert rows.filter(F.col("notes")["first"]["mail"] == "m3@x.org").count() == 0


def test_tags_on_paths(spark, deep, tmp_path):
    tagged = apply_tags(deep, {"who.name": "PII", "id": "INTERNAL"})
    assert tags_of(tagged) == {"id": "INTERNAL", "who.name": "PII"} and level_of(tagged, "who") is None
    tagged.write.parquet(str(tmp_path / "t"))
    assert tags_of(spark.read.parquet(str(tmp_path / "t"))) == tags_of(tagged)
    with pytest.raises(ValueError):
        apply_tags(deep, {"who.nope": "PII"})
    assert inherit(tagged.select("who"), [tagged]) == {"who.name": "PII"}  # a plain copy
    assert inherit(tagged.filter("id > 0"), [tagged], kept=["who"])["who.name"] == "PII"
    assert inherit(tagged.select(F.col("who.links").alias("links")), [tagged]) == {"links": "PII"}  # taken apart: not believed
    assert inherit(tagged.select(F.size("notes").alias("n")), [tagged], {"n": ["who"]}) == {"n": "PII"}
    assert tags_of(union(tagged, tagged)) == tags_of(tagged)
    assert tags_of(union(apply_tags(deep, {}), tagged)) == {"id": "INTERNAL", "who": "PII"}
    gov = Governance()
    gov.register("deep", tagged)
    gov.set_tags("deep", {"notes{key}": "PII", "ID": "PUBLIC"})
    assert gov.tags("deep") == {"id": "PUBLIC", "who.name": "PII", "notes{key}": "PII"}
    gov.unset_tags("deep", "who.name")
    assert gov.tags("deep") == {"id": "PUBLIC", "notes{key}": "PII"}


def test_a_changed_shape_is_hidden(deep):
    """A tag on a path that is no longer there hides the column."""
    from custodia.operators.governance import masked_columns
    from custodia.operators.tags import METADATA_KEY, PATHS_KEY

    changed = deep.select(F.col("who.links").alias("who", metadata={METADATA_KEY: "NONE", PATHS_KEY: {"who.name": "PII"}}))
    assert {r.who for r in masked_columns(changed, DATA_USER).collect()} == {None}


def test_one_row_per_place_is_moved(deep):
    from tests.test_plans import plan

    text = plan(cl.match_counts(deep, cl.BUILT_IN), "simple")
    assert text.count("Exchange") == 1 and "Python" not in text
