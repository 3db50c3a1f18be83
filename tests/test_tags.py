import pytest
from pyspark.sql import functions as F

from custodia.operators import classify as cl
from custodia.sources.snapshots import insert_rows
from custodia.operators.governance import Governance
from custodia.operators.propagation import levels_of_object, propagate_levels
from custodia.operators.tags import (
    apply_tags,
    difference,
    inherit,
    intersect,
    level_of,
    list_column_tags,
    lookup_tag,
    tag_rows,
    tags_of,
    union,
)


@pytest.fixture()
def source(spark):
    df = spark.createDataFrame([(1, "a@x.org", "555-1234", "Ann", 10.0)], "id int, email string, phone string, name string, amount double")
    return apply_tags(df, {"email": "PII", "phone": "RESTRICTED", "name": "SENSITIVE"})


def test_tags_survive_plain_operations(spark, source, tmp_path):
    derived = source.filter("id > 0").select("id", F.col("email").alias("mail"), "phone")
    assert tags_of(derived) == {"email": "PII", "phone": "RESTRICTED"} or tags_of(derived) == {"mail": "PII", "phone": "RESTRICTED"}
    assert level_of(derived, "mail") == "PII"
    path = str(tmp_path / "t")
    derived.write.parquet(path)
    assert tags_of(spark.read.parquet(path)) == {"mail": "PII", "phone": "RESTRICTED"}


def test_inherit_join_and_group(spark, source):
    orders = apply_tags(spark.createDataFrame([(1, 5.0)], "id int, total double"), {"total": "INTERNAL"})
    derived = source.join(orders, "id").groupBy("phone").agg(
        F.sum("total").alias("total"), F.upper(F.min("name")).alias("who"), F.count("*").alias("n")
    )
    tags = inherit(derived, [source, orders], {"who": ["name"], "n": []}, kept=["phone"])
    assert tags == {"phone": "RESTRICTED", "total": "PII", "who": "SENSITIVE"}  # a computed total is not believed by name
    tags = inherit(derived, [source, orders], {"who": ["name"], "n": [], "total": ["total"]}, kept=["phone"])
    assert tags == {"phone": "RESTRICTED", "total": "INTERNAL", "who": "SENSITIVE"}


def test_a_name_alone_is_not_believed(source):
    assert inherit(source.select(F.upper("email").alias("name")), [source]) == {"name": "PII"}
    assert inherit(source.select(F.lower("name").alias("id")), [source]) == {"id": "PII"}


def test_set_operations_count_as_undeclared(source):
    mixed = source.select("name").union(source.select("email"))
    assert inherit(mixed, [source]) == {"name": "PII"}
    assert inherit(mixed, [source], {"name": ["name", "email"]}) == {"name": "PII"}
    assert inherit(mixed.select("name"), [mixed]) == {"name": "SENSITIVE"}  # the source's own union is no news


def test_inserted_rows_bring_their_tags(spark, source):
    target = apply_tags(spark.createDataFrame([("free text", 1.0)], "note string, amount double"), {})
    more = insert_rows(target, source.select(F.col("phone").alias("note")))
    assert tags_of(more) == {"note": "RESTRICTED"} and more.count() == 2
    computed = source.select(F.upper("email").alias("note"), F.col("amount"))
    assert tags_of(insert_rows(target, computed, [source])) == {"note": "PII", "amount": "PII"}
    assert tags_of(insert_rows(target, computed, [source], kept=["amount"])) == {"note": "PII"}
    assert tags_of(insert_rows(target, computed, [source], {"note": ["phone"]}, ["amount"])) == {"note": "RESTRICTED"}
    both = spark.createDataFrame([("x", 2.0)], "note string, amount double")
    assert tags_of(insert_rows(more, both)) == {"note": "RESTRICTED"}


def test_undeclared_column_fails_closed(source):
    derived = source.select("id", F.length("name").alias("len"))
    assert inherit(derived, [source]) == {"id": "PII", "len": "PII"}
    assert inherit(derived, [source], kept=["id"]) == {"len": "PII"}
    assert inherit(derived, [source], {"len": ["name"]}, kept=["id"]) == {"len": "SENSITIVE"}
    assert inherit(derived, [source], {"len": []}, kept=["id"]) == {}
    with pytest.raises(ValueError):
        inherit(derived, [source], kept=["nope"])


def test_union_takes_most_severe(spark, source):
    other = apply_tags(spark.createDataFrame([("x",)], "name string"), {})
    both = other.union(source.select("email").withColumnRenamed("email", "name"))
    assert inherit(both, [other, source]) == {"name": "PII"}
    renamed = source.select(F.col("email").alias("name"))
    assert inherit(other.union(renamed), [other, renamed]) == {"name": "PII"}


def test_plain_copies_keep_their_tags(source):
    want = {"email": "PII", "phone": "RESTRICTED", "name": "SENSITIVE"}
    assert inherit(source, [source]) == inherit(source.select("*"), [source]) == want
    assert inherit(source.select("phone", "id"), [source]) == {"phone": "RESTRICTED"}
    swapped = source.select("id", F.col("email").alias("name"))
    assert inherit(swapped, [source]) == {"id": "PII", "name": "PII"}


@pytest.mark.parametrize("length", ["100", "2000000"])
def test_set_operations_merge_tags(spark, source, length):
    """However long the plan is and however much of it is printed."""
    before = spark.conf.get("spark.sql.maxPlanStringLength")
    spark.conf.set("spark.sql.maxPlanStringLength", length)
    try:
        low = source.select("id", F.col("name").alias("text"))
        high = source.select("id", F.col("email").alias("mail"))
        for _ in range(20):
            high = high.filter("id > 0")
        plain = spark.createDataFrame([(1, "x")], "id int, other string")
        for result in (
            union(low, high), union(high, low), intersect(low, high), difference(low, high), union(plain, low, high),
            union(low, high.toDF("id", "text"), by_name=True), intersect(low, high, True), difference(low, high, True),
        ):
            assert list(tags_of(result).values()) == ["PII"] and len(result.columns) == 2
        assert tags_of(union(plain, plain)) == {}
        assert inherit(low.union(high), [source]) == {"id": "PII", "text": "PII"}  # not said how: nothing is believed
        assert union(low, high).count() == 2 and intersect(low, low).count() == 1 and difference(low, low).count() == 0
        partly = apply_tags(low, {"text": "RESTRICTED"}).withColumn("id", F.col("id") + 1)
        assert tags_of(union(plain, partly)) == {"id": "RESTRICTED", "other": "RESTRICTED"}  # a lost mark
        with pytest.raises(ValueError):
            union(low, low.select("id"))
    finally:
        spark.conf.set("spark.sql.maxPlanStringLength", before)


EDGES = "source_object_name string, source_column_name string, target_object_name string, target_column_name string"


def _settled(spark, tagged, edges):
    found = propagate_levels(
        spark.createDataFrame(tagged, "object_name string, column_name string, classification_level string"),
        spark.createDataFrame(edges, EDGES),
    )
    return {(r.object_name, r.column_name): (r.classification_level, r.own_level) for r in found.collect()}


def test_levels_move_over_paths_and_cycles(spark):
    path = [(f"t{i}", "c", f"t{i + 1}", "c") for i in range(6)]
    cycle = [("t6", "c", "t4", "c"), ("t2", "c", "t2", "c"), ("u", "x", "t5", "c")]
    odd = [(None, "c", "t9", "c"), ("t0", None, "t9", "c"), ("t0", "c", None, None)]
    tagged = [("t0", "c", "SENSITIVE"), ("t3", "c", "INTERNAL"), ("u", "x", "PII"), ("t1", "d", "PUBLIC"), ("t9", "c", "odd")]
    got = _settled(spark, tagged, [*path, *cycle, *odd, path[0]])
    assert got == {
        ("t0", "c"): ("SENSITIVE", "SENSITIVE"),
        ("t1", "c"): ("SENSITIVE", None),
        ("t1", "d"): ("PUBLIC", "PUBLIC"),
        ("t2", "c"): ("SENSITIVE", None),
        ("t3", "c"): ("SENSITIVE", "INTERNAL"),
        ("t4", "c"): ("PII", None),
        ("t5", "c"): ("PII", None),
        ("t6", "c"): ("PII", None),
        ("u", "x"): ("PII", "PII"),
    }
    assert _settled(spark, [], path) == {} and _settled(spark, tagged[:1], []) == {("t0", "c"): ("SENSITIVE", "SENSITIVE")}


def test_levels_move_in_random_graphs(spark):
    import random

    from custodia.functions.masks import LEVELS, severity

    pick = random.Random(4)
    edges = [(f"t{pick.randrange(40)}", "c", f"t{pick.randrange(40)}", "c") for _ in range(60)]
    edges += [("t0", "c", f"t{i}", "c") for i in range(20, 40)]  # one source of a quarter of all edges
    tagged = [(f"t{pick.randrange(40)}", "c", pick.choice(LEVELS)) for _ in range(12)]
    want = {}
    for name, _, level in tagged:
        want[name] = min(want.get(name, 9), severity(level))
    for _ in range(50):
        for a, _, b, _ in edges:
            if a in want:
                want[b] = min(want.get(b, 9), want[a])
    got = _settled(spark, tagged, edges)
    assert {k[0]: v[0] for k, v in got.items()} == {k: LEVELS[v - 1] for k, v in want.items()}


def test_moved_levels_mask_the_copy(spark, source):
    """End to end: a log row says that mails went into a note; the note is masked."""
    found = propagate_levels(
        spark.createDataFrame([("db.s.people", "email", "PII")], "object_name string, column_name string, classification_level string"),
        spark.createDataFrame([("db.s.people", "email", "db.s.copy", "note")], EDGES),
    )
    gov = Governance()
    gov.register("copy", source.select(F.lower("email").alias("note")), levels_of_object(found, "db.s.copy"))
    assert gov.table("copy", "DATA_USER").to_df().first()["note"] == "***PII-REDACTED***"


def test_declared_unknown_column(source):
    with pytest.raises(ValueError):
        inherit(source, [source], {"email": ["nope"]})
    with pytest.raises(ValueError):
        apply_tags(source, {"nope": "PII"})


def test_listing_order_and_lookup(spark, source):
    refs = tag_rows(spark, "L", "S", "T", tags_of(source))
    assert [r["column_name"] for r in list_column_tags(refs).collect()] == ["email", "phone", "name"]
    assert lookup_tag(refs, "DATA_CLASSIFICATION", "T", "phone").first()[0] == "RESTRICTED"


@pytest.fixture()
def people(spark):
    rows = [
        (f"p{i}@mail.org", f"{100 + i}-{10 + i}-{1000 + i}", f"41111111111111{i:02d}", f"5105105105105{100 + i}", f"Ann{i}", "x" if i else "y", None)
        for i in range(20)
    ]
    return spark.createDataFrame(rows, "contact string, ident string, visa string, mc string, first_name string, filler string, empty string")


def test_classify_by_content(people):
    found = {r["column_name"]: r["semantic_category"] for r in cl.classify(people).collect()}
    assert found == {
        "contact": "EMAIL",
        "ident": "US_SOCIAL_SECURITY_NUMBER",
        "visa": "CREDIT_CARD_NUMBER",
        "first_name": "NAME",
    }


def test_custom_detectors_add(people):
    found = {r["column_name"]: r for r in cl.classify(people, cl.BUILT_IN + cl.CARD_CLASSIFIER).collect()}
    assert found["mc"]["semantic_category"] == "CREDIT_CARD_NUMBER" and found["mc"]["confidence"] == "HIGH"
    assert ("mc_payment_card", "CREDIT_CARD_NUMBER", cl.MASTERCARD) in cl.detector_list(cl.CARD_CLASSIFIER)


def test_preview_does_not_tag_and_apply_does(people):
    classified = cl.classify(people)
    assert tags_of(people) == {}
    assert tags_of(cl.apply_classification(people, classified)) == {
        "contact": "PII",
        "ident": "PII",
        "visa": "PII",
        "first_name": "SENSITIVE",
    }


def test_partial_match_lowers_confidence(spark):
    df = spark.createDataFrame([("a@b.org",), ("c@d.org",), ("e@f.org",), ("none",)], "x string")
    row = cl.classify(df).first()
    assert (row["semantic_category"], row["confidence"], row["match_ratio"]) == ("EMAIL", "MEDIUM", 0.75)
    mostly_not = spark.createDataFrame([("a@b.org",), ("n",), ("m",)], "x string")
    assert cl.classify(mostly_not).count() == 0


@pytest.mark.parametrize(
    "number,hit",
    [("5105105105105100", True), ("2221000000000009", True), ("2720990000000007", True), ("2721000000000004", False), ("4111111111111111", False)],
)
def test_mastercard_pattern(spark, number, hit):
    assert spark.range(1).select(F.lit(number).rlike(cl.MASTERCARD)).first()[0] is hit


def test_due_for_scan(spark):
    df = spark.sql(
        """SELECT * FROM VALUES ('never', 'BASE TABLE', timestamp_ntz'2024-01-01', CAST(NULL AS timestamp_ntz)),
        ('fresh', 'BASE TABLE', timestamp_ntz'2024-01-01', timestamp_ntz'2024-03-01'),
        ('expired', 'VIEW', timestamp_ntz'2023-01-01', timestamp_ntz'2023-06-01'),
        ('young', 'BASE TABLE', timestamp_ntz'2024-03-30', CAST(NULL AS timestamp_ntz)) AS t(name, table_type, created_at, classified_at)"""
    )
    as_of = F.lit("2024-03-31").cast("timestamp_ntz")
    names = lambda **k: {r["name"] for r in cl.due_for_scan(df, as_of, **k).collect()}
    assert names() == {"never", "expired", "young"}
    assert names(min_age_days=5) == {"never", "expired"}
    assert names(include_views=False) == {"never", "young"}
