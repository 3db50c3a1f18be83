"""Small tables with every awkward case: nulls, empty and long texts, ties, repeats, clashing columns."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 700} runs, {i}" for i in range(4000))
NEAR = [f"alpha{i} beta gamma{i % 9} delta" for i in range(40)]

ROWS = [
    (1, "It's a plain text. With two lines.\nAnd  the second one!", "en", "a", 52),
    (2, "", "en", "a", 0),
    (3, None, None, None, None),
    (None, "no id here, but  some text\tand tabs", "en", "a", 5),
    (5, LONG, "en", "b", len(LONG)),
    (6, " ".join(NEAR), "en", "b", 1),
    (7, " ".join([*NEAR[:20], "changed", *NEAR[20:]]), "en", "b", 1),
    (8, " ".join(NEAR), "fr", "a", 1),
    (8, " ".join(NEAR), "fr", "a", 1),
    (9, "Ünïcode \u00a0\u2003 späces 漢字仮名 \U0001f600 \u0378 x² ١٢٣ don't <|endoftext|> we'll   \n\n end ", "xx", "c", 1),
    (10, "one two three", "en", "a", 1),
    (10, "another text under the same id", "en", "a", 1),
    (11, " \t\n ", "en", None, 4),
    (12, "x" * 5000, "en", "c", 5000),
    (13, "same word " * 300, "en", "c", 3000),
]


def documents(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, DOCUMENTS)


def clashing(df, *names):
    """The same rows with further columns of the given names."""
    from pyspark.sql import functions as F

    for name in names:
        df = df.withColumn(name, F.lit("clash"))
    return df


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
