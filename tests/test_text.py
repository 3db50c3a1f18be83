import re

import pytest
from pyspark.sql import functions as F

from custodia.functions import text as tx

CASES = [
    ("Write to a.b+c@mail.example.org, now", "Write to [EMAIL], now"),
    ("SSN 987-65-4321.", "SSN [US_SOCIAL_SECURITY_NUMBER]."),
    ("card 4111 1111 1111 1111 or 4111-1111-1111-1111 or 4111111111111111", " ".join(["card"] + ["[CREDIT_CARD_NUMBER] or"] * 2 + ["[CREDIT_CARD_NUMBER]"])),
    ("12 digits 411111111111 stay", "12 digits 411111111111 stay"),
    ("17 digits 41111111111111111 stay", "17 digits 41111111111111111 stay"),
    ("call 555-123-4567 or (555) 123-4567 or +1 (743) 555-3824", "call [PHONE_NUMBER] or [PHONE_NUMBER] or [PHONE_NUMBER]"),
    ("from 10.0.0.1 at noon", "from [IP_ADDRESS] at noon"),
    ("born 03/15/1985 and 1985-03-15", "born [DATE_OF_BIRTH] and [DATE_OF_BIRTH]"),
    ("lives at 12 Birch Lane, Salem MA 01970 now", "lives at [STREET_ADDRESS] now"),
    ("lives at 12 Birch Lane now", "lives at [STREET_ADDRESS] now"),
    ("Clara Lund-Berg met Dr. Weiss", "[NAME] met [NAME]"),
    ("a claim by Johnny Cash", "a claim by Johnny Cash"),  # not in the list: low recall is documented
    ("élanAnna Roth stays glued? Anna Roth", None),
    ("555-123-4567,555-123-4568", "[PHONE_NUMBER],[PHONE_NUMBER]"),
    ("line one a@b.co\nline two 10.0.0.1\n", "line one [EMAIL]\nline two [IP_ADDRESS]\n"),
    ("nothing here", "nothing here"),
    ("", ""),
    (None, None),
]


def test_redaction_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(tx.redact(F.col("t"))).collect()]
    for (source, want), out in zip(CASES, got):
        if want is not None or source is None:
            assert out == want, source


def test_partial_leaves_the_rest(spark):
    note = "Reach Maria Roth at maria@x.org or 555-123-4567."
    df = spark.createDataFrame([(note,)], "t string")
    assert df.select(tx.redact(F.col("t"), ["NAME", "EMAIL"])).first()[0] == "Reach [NAME] at [EMAIL] or 555-123-4567."
    assert df.select(tx.redact(F.col("t"))).first()[0] == "Reach [NAME] at [EMAIL] or [PHONE_NUMBER]."
    with pytest.raises(ValueError):
        tx.redact(F.col("t"), ["NO_SUCH_TYPE"])


def test_redaction_is_stable(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "t string")
    twice = df.select(tx.redact(F.col("t")).alias("once")).select("once", tx.redact(F.col("once")).alias("again"))
    assert twice.filter("once <> again").count() == 0


def test_long_unbroken_text_stays_fast(spark):
    """No pattern may scan a long run again from every position."""
    texts = [("a" * 400_000,), ("1" * 400_000,), ("a." * 200_000 + "@",), ("Ab " * 130_000,), ("1-" * 200_000,)]
    df = spark.createDataFrame(texts, "t string")
    out = df.select(F.length("t"), F.length(tx.redact(F.col("t"))), tx.sentiment(F.col("t"))).collect()
    assert all(a == b for a, b, _ in out)


def test_entity_counts(spark):
    df = spark.createDataFrame([("a@b.co c@d.co 10.0.0.1 Anna Roth",), (None,)], "t string")
    row, null_row = df.select(*tx.entity_counts(F.col("t"))).collect()
    assert row.asDict() == {**dict.fromkeys(tx.LABELS, 0), "EMAIL": 2, "IP_ADDRESS": 1, "NAME": 1}
    assert null_row["EMAIL"] in (0, None)


def test_sentiment(spark):
    cases = [("Great, great service!", 1.0), ("bad", -1.0), ("good but late", 0.0), ("plain", 0.0), ("good good bad", 0.3333), ("badge greatest", 0.0), (None, None)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(tx.sentiment(F.col("t"))).collect()]
    assert got == [s for _, s in cases]


def test_labels(spark):
    df = spark.createDataFrame([(0.6,), (0.5,), (-0.5,), (-0.6,)], "s double")
    assert [r[0] for r in df.select(tx.sentiment_label(F.col("s"), 0.5)).collect()] == ["Positive", "Neutral", "Neutral", "Negative"]


def test_placeholders_and_names_are_neutral():
    words = {*tx.POSITIVE, *tx.NEGATIVE}
    for token in (*tx.LABELS, *tx.GIVEN_NAMES):
        assert not words & set(re.split("[^a-z]+", token.lower()))


def test_topics_first_match_wins(spark):
    cases = [
        ("REFUND the shipping", "Refund Request"),
        ("expedited bulk", "Shipping Issue"),
        ("wholesale by credit card", "Bulk Order"),
        ("urgent: Credit Card", "Payment Issue"),
        ("privacy", "Urgent Issue"),
        ("hello", "General Feedback"),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(tx.topic(F.col("t"))).collect()] == [s for _, s in cases]


def test_name_recall_is_as_documented(spark):
    """Listed given names and honorifics are caught, other names are not: 4 of 7 here."""
    names = ["Sofia Tanaka", "Mrs. Okafor", "Yusuf Petrov", "Dr. Lindqvist", "Svetlana Brennan", "Tanaka", "Kwame Okafor"]
    rows = spark.createDataFrame([(n, f"then {n} left") for n in names], "name string, text string")
    got = {r["name"]: r["t"] for r in rows.select("name", tx.redact(F.col("text")).alias("t")).collect()}
    assert [n for n in names if n not in got[n]] == names[:4]
