"""Scored sentiment from a table of valences, with negation and degree in a window of words before.

The table (word, valence in [-1, 1]) is data: read from wherever it lies, or grown from a few seeds and a corpus
(``learn_valences``). A word's valence is multiplied by the degrees and turned by the negations among the three words before it
in its clause. A text's score is ``t / sqrt(t * t + 4)`` of the sum ``t``, between -1 and 1, 0 without any listed word.

Texts are always redacted first and redaction of a redacted text changes nothing, so a score is the same for a text and
its redacted form, also where a placeholder has fewer words than what it stands for.

Each distinct text is scored once. Its words become rows, meet the table, and are summed per text; nothing after the join
depends on a word, so a very frequent one may be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions.text import NEGATIVE, POSITIVE, redact
from custodia.sources.snapshots import write_snapshot
from custodia.sources.tables import literal_rows

#: What turns a valence, and by how much; what strengthens or weakens it.
NEGATIONS = (
    "not", "no", "never", "neither", "nor", "none", "nothing", "without", "hardly", "cannot",
    "don't", "didn't", "doesn't", "isn't", "wasn't", "weren't", "won't", "wouldn't", "can't", "couldn't",
)
TURN = -0.75
DEGREES = (
    ("very", 1.5), ("really", 1.4), ("so", 1.3), ("extremely", 1.75), ("absolutely", 1.75), ("totally", 1.5), ("most", 1.3),
    ("quite", 1.2), ("rather", 0.8), ("somewhat", 0.6), ("slightly", 0.5), ("barely", 0.25), ("little", 0.5), ("bit", 0.5),
)
WINDOW = 3
_WORD = r"[a-z]+(?:'[a-z]+)*|[.!?;:,()\n]"
_MARK = r"^[^a-z]$"


def seed_table(spark) -> DataFrame:
    """(word, valence) of the short lists."""
    return literal_rows(spark, [(w, 1.0) for w in POSITIVE] + [(w, -1.0) for w in NEGATIVE], "word string, valence double")


def words_of(text: Column) -> Column:
    """Lower-case words and marks of the redacted text; placeholders are no words."""
    plain = F.regexp_replace(redact(text), r"\[[A-Z_]+\]", " ")
    return F.regexp_extract_all(F.lower(plain), F.lit(_WORD), F.lit(0))


def _factor(before: Column) -> Column:
    """Degrees and negations among the words before, back to the last mark."""

    def step(state: Column, word: Column) -> Column:
        factor = F.when(word.rlike(_MARK), F.lit(1.0)).when(word.isin(*NEGATIONS), state * TURN)
        for degree, times in DEGREES:
            factor = factor.when(word == degree, state * times)
        return factor.otherwise(state)

    return F.aggregate(before, F.lit(1.0), step)


def _hits(texts: DataFrame, column: str, table: DataFrame, key: str) -> DataFrame:
    """(key, place, value) of every listed word in the distinct texts."""
    distinct = texts.select(F.xxhash64(column).alias(key), F.col(column).alias("_text")).dropDuplicates([key])
    rows = distinct.select(key, words_of(F.col("_text")).alias("_words")).select(
        key, "_words", F.posexplode("_words").alias("_place", "word")
    )
    first = F.greatest(F.col("_place") - WINDOW, F.lit(0))
    near = rows.select(key, "_place", "word", F.slice("_words", first + 1, F.col("_place") - first).alias("_before"))
    listed = table.select("word", F.col("valence").alias("_valence"))
    return near.join(listed, "word").select(key, "_place", (F.col("_valence") * _factor(F.col("_before"))).alias("_value"))


def score_texts(texts: DataFrame, column: str, table: DataFrame, name: str = "sentiment") -> DataFrame:
    """The rows with their score; NULL for NULL. Columns called like the score are replaced."""
    sums = _hits(texts.filter(F.col(column).isNotNull()), column, table, "_score_key").groupBy("_score_key").agg(
        F.sum("_value").alias("_total")
    )
    total = F.coalesce("_total", F.lit(0.0))
    score = F.when(F.col("_row")[column].isNotNull(), F.round(total / F.sqrt(total * total + 4), 4))
    kept = [c for c in texts.columns if c != name]
    rows = texts.select(F.struct(*[F.col(f"`{c}`") for c in texts.columns]).alias("_row"), F.xxhash64(column).alias("_own_key"))
    joined = rows.join(sums, F.col("_own_key") == F.col("_score_key"), "left")
    return joined.select(*[F.col("_row")[c].alias(c) for c in kept], score.alias(name))


def learn_valences(texts: DataFrame, column: str, seeds: DataFrame, least: int = 5, strength: float = 0.6) -> DataFrame:
    """(word, valence): the seeds, and words that stand in sentences of one colour.

    A sentence has the sign of its seeds, negations minded. A word's valence is the difference of its rates in good and in
    bad sentences over their sum; it is listed from ``least`` sentences and an absolute valence of ``strength`` on.
    """
    key = F.xxhash64(F.col(column))
    written = texts.filter(F.col(column).isNotNull()).select(key.alias("key"), F.col(column).alias("text")).groupBy("key").agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("times")
    )
    sentences = written.select("times", F.posexplode(F.split(redact(F.col("text")), r"[.!?\n]+")).alias("place", "sentence"))
    sentences = write_snapshot(
        sentences.groupBy("sentence").agg(F.sum("times").alias("times")).withColumn("sentence_key", F.xxhash64("sentence")), "sentences"
    )
    signs = (
        _hits(sentences, "sentence", seeds, "sentence_key")
        .groupBy("sentence_key")
        .agg(F.signum(F.sum("_value")).alias("sign"))
        .filter("sign <> 0")
    )
    coloured = sentences.join(signs, "sentence_key").select(
        "sign", "times", F.explode(F.array_distinct(words_of(F.col("sentence")))).alias("word")
    )
    good, bad = (F.sum(F.when(F.col("sign") == sign, F.col("times")).otherwise(0)) for sign in (1, -1))
    totals = sentences.join(signs, "sentence_key").agg(
        *[F.sum(F.when(F.col("sign") == sign, F.col("times")).otherwise(0)) for sign in (1, -1)]
    ).first()
    rates = [(F.col(c) + 0.5) / (float(n or 0) + 1) for c, n in zip(("good", "bad"), totals)]
    stop = [*NEGATIONS, *[d for d, _ in DEGREES]]
    found = (
        coloured.filter(~F.col("word").rlike(_MARK) & ~F.col("word").isin(stop))
        .groupBy("word")
        .agg(good.alias("good"), bad.alias("bad"))
        .filter(F.col("good") + F.col("bad") >= least)
        .select("word", ((rates[0] - rates[1]) / (rates[0] + rates[1])).alias("valence"))
        .filter(F.abs("valence") >= strength)
    )
    return seeds.select("word", "valence").unionByName(found.join(seeds.select("word"), "word", "left_anti"))
