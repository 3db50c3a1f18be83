"""Scored sentiment against hand-written expectations, invariance under redaction, and learned valences."""

import math
import random

import pytest
from pyspark.sql import functions as F

from custodia.functions.text import redact
from custodia.operators.valence import learn_valences, score_texts, seed_table
from custodia.sources import fixtures as fx
from custodia.sources.tables import literal_rows


def level(total):
    return round(total / math.sqrt(total * total + 4), 4)


CASES = [
    ("The lamp is good.", 1.0),
    ("The lamp is very good.", 1.5),
    ("The lamp is not good.", -0.75),
    ("The lamp is not very good.", -0.75 * 1.5),
    ("NOT good", -0.75),
    ("It was never late", 0.75),
    ("I don't love it, the box was damaged", -0.75 - 1),
    ("not, good", 1.0),  # another clause
    ("not one of good ones", -0.75),  # three words back
    ("not one of the good ones", 1.0),  # four words back
    ("no, it was slightly late. Really great!", -0.5 + 1.4),
    ("extremely bad, absolutely terrible", -3.5),
    ("good good bad", 1.0),
    ("plain words", 0.0),
    ("goodness, badge, greatest", 0.0),
    ("without a problem", 0.75),
    ("it isn't wasn't bad", -1 * 0.75 * 0.75),
    ("", 0.0),
    (None, None),
    ("not Anna Roth's good idea", 0.75 * -1),  # the name is a placeholder of no words
]


@pytest.fixture()
def notes(spark):
    return spark.createDataFrame([(i, t, "clash") for i, (t, _) in enumerate(CASES)] + [(99, CASES[1][0], "x")], "i int, _text string, word string")


def test_cases(spark, notes):
    got = {r.i: r.sentiment for r in score_texts(notes, "_text", seed_table(spark)).collect()}
    want = {i: None if total is None else level(total) for i, (_, total) in enumerate(CASES)}
    assert got == {**want, 99: level(1.5)}
    out = score_texts(notes, "_text", seed_table(spark), "word")
    assert out.columns == ["i", "_text", "word"] and out.count() == len(CASES) + 1
    assert score_texts(notes.limit(0), "_text", seed_table(spark)).count() == 0


def test_redaction_moves_no_score(spark, base):
    table = seed_table(spark)
    odd = [("not 555-123-4567 Anna Roth good",), ("never a.b@c.org, good",), ("very 12 Birch Lane, Salem MA 01970 bad",), ("not Dr. Weiss Anna Roth good",)]
    notes = fx.feedback(spark, base).select("feedback").unionAll(spark.createDataFrame(odd, "feedback string"))
    both = notes.select("feedback", redact(F.col("feedback")).alias("hidden"))
    scored = score_texts(score_texts(both, "feedback", table, "a"), "hidden", table, "b")
    assert scored.filter("a <> b").count() == 0 and scored.filter("a <> 0").count() > 100


def test_a_larger_table_is_data(spark, notes, tmp_path):
    literal_rows(spark, [("lamp", -0.5), ("plain", 0.25)], "word string, valence double").write.csv(str(tmp_path / "v"), header=True)
    table = spark.read.schema("word string, valence double").option("header", True).csv(str(tmp_path / "v"))
    got = {r.i: r.sentiment for r in score_texts(notes, "_text", table).collect()}
    assert got[0] == level(-0.5) and got[13] == level(0.25) and got[14] == 0.0


def test_valences_are_learned_from_seeds(spark):
    """Words that only stand in good or bad sentences get their colour; words of both get none."""
    pick = random.Random(9)
    good, bad, both = ("superb", "gleaming", "tasty"), ("soggy", "rusty", "noisy"), ("lamp", "table", "the", "was")
    rows = []
    for i in range(400):
        parts = []
        for _ in range(2):
            up = pick.random() < 0.5
            seed = pick.choice(["great", "excellent", "never late"] if up else ["awful", "broken", "not good"])
            parts.append(f"The {pick.choice(both[:2])} was {pick.choice(good if up else bad)} and {seed}")
        rows.append((". ".join(parts),))
    df = spark.createDataFrame([*rows, (None,), ("",)], "note string")
    learned = {r.word: r.valence for r in learn_valences(df, "note", seed_table(spark)).collect()}
    assert all(learned[w] > 0.9 for w in good) and all(learned[w] < -0.9 for w in bad)
    assert not {*both, "and"} & set(learned) and learned["awful"] == -1.0
    score = score_texts(spark.createDataFrame([("a soggy and noisy room",)], "t string"), "t", learn_valences(df, "note", seed_table(spark))).first()
    assert score.sentiment < -0.5
    assert learn_valences(df.limit(0), "note", seed_table(spark)).count() == seed_table(spark).count()
