"""Personal names found by how a corpus writes its words, not by a list.

Capitalised words are counted over the corpus with what stands around them. Words after an honorific are the seeds. A word
is then scored by

* its capitalisation: the share of capital letters where no sentence starts (a word only seen at such starts needs three
  different known neighbours instead);
* its company: how often it stands after an honorific, beside a known name part, or in a context in which known parts
  stand; a context is the lower-case word before or after, weighted by the share of known parts among its capitalised words.
  As names that are not known yet hold these shares down, a word's mean share is set against that of the known parts.

Words that reach ``least`` are known in the next round. What is counted once per text position is kept as one row per word
and surrounding, so rounds never read a text again; every word, text and context is counted, whatever its frequency.

* Counts are summed per task before they move; joins meet rows that are grouped again right after, so a frequent context
  may be split. Every table a round needs is written below the shared folder.
* Only names that are written with a capital letter and lower-case letters are found. NULL and empty texts hold none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.sources.snapshots import write_snapshot

#: Titles that stand before names.
HONORIFICS = ("Mr", "Mrs", "Ms", "Dr", "Prof")
#: Words, sentence ends and other marks. Every other character is passed over.
TOKEN = r"[A-Za-zÀ-ÖØ-öø-ÿ][A-Za-zÀ-ÖØ-öø-ÿ'-]*|[.!?:;\n]|[,()\[\]/]|[0-9]+"
CAPITALISED = r"^[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?:['-][A-ZÀ-ÖØ-Þa-zß-öø-ÿ][a-zß-öø-ÿ]*)*$"
LOWER = r"^[a-zß-öø-ÿ][a-zß-öø-ÿ'-]*$"
SENTENCE_END = r"^[.!?:;\n]$"


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _is(token: Column, pattern: str) -> Column:
    return F.coalesce(token.rlike(pattern), F.lit(False))


def _titled(tokens: Column, i: Column) -> Column:
    """Does an honorific, with or without a point, stand before the token?"""
    before, further = F.get(tokens, i - 1), F.get(tokens, i - 2)
    return F.coalesce(before.isin(*HONORIFICS), F.lit(False)) | (
        F.coalesce(before == ".", F.lit(False)) & F.coalesce(further.isin(*HONORIFICS), F.lit(False))
    )


def surroundings(texts: DataFrame, column: str) -> DataFrame:
    """word, before, after, titled, start, n: capitalised words and lower-case ones, with what stands beside them.

    ``before`` and ``after`` are capitalised or lower-case words that follow each other without a mark between.
    Lower-case words have no surroundings: only their number counts.
    """
    t, i = F.col("tokens"), F.col("i")
    rows = texts.select(_tokens(F.col(column)).alias("tokens")).select("tokens", F.posexplode("tokens").alias("i", "word"))
    capital = _is(F.col("word"), CAPITALISED) & ~F.col("word").isin(*HONORIFICS)
    beside = lambda x: F.when(_is(x, CAPITALISED) | _is(x, LOWER), x)
    titled = _titled(t, i)
    start = ~titled & ((i == 0) | _is(F.get(t, i - 1), SENTENCE_END))
    before, after = beside(F.get(t, i - 1)), beside(F.get(t, i + 1))
    nothing = F.lit(None).cast("string")
    kept = rows.filter(capital | _is(F.col("word"), LOWER)).select(
        "word",
        F.when(capital & ~before.isin(*HONORIFICS), before).otherwise(nothing).alias("before"),
        F.when(capital, after).otherwise(nothing).alias("after"),
        (capital & titled).alias("titled"),
        (capital & start).alias("start"),
    )
    return kept.groupBy("word", "before", "after", "titled", "start").agg(F.count(F.lit(1)).alias("n"))


def _spellings(found: DataFrame) -> DataFrame:
    """word, caps, mid, titled_n, low: how often a capitalised word is written so, and how often without a capital."""
    capital = F.col("word").rlike(CAPITALISED)
    forms = found.groupBy("word").agg(
        F.sum("n").alias("caps"),
        F.sum(F.when(~F.col("start"), F.col("n")).otherwise(0)).alias("mid"),
        F.sum(F.when(F.col("titled"), F.col("n")).otherwise(0)).alias("titled_n"),
    )
    plain = forms.filter(~capital).select(F.col("word").alias("_low"), F.col("caps").alias("low"))
    return (
        forms.filter(capital)
        .join(plain, F.lower("word") == F.col("_low"), "left")
        .select("word", "caps", "mid", "titled_n", F.coalesce("low", F.lit(0)).alias("low"))
    )


def _contexts(found: DataFrame, known: DataFrame, side: str) -> DataFrame:
    """Lower-case words beside capitalised ones, with the share of known parts among these, held back by two."""
    met = (
        found.filter(F.col("word").rlike(CAPITALISED) & F.col(side).rlike(LOWER))
        .join(known.select("word", F.lit(1).alias("is_known")), "word", "left")
        .groupBy(side)
        .agg(F.sum("n").alias("all_n"), F.sum(F.when(F.col("is_known") == 1, F.col("n")).otherwise(0)).alias("known_n"))
    )
    share = F.col("known_n") / (F.col("all_n") + 2)
    return met.filter("known_n > 0").select(F.col(side), share.alias(f"{side}_share"))


def name_parts(texts: DataFrame, column: str, least: float = 0.5, rounds: int = 3) -> DataFrame:
    """word, score: given and family names of the corpus. Seeds keep their place whatever their score."""
    found = write_snapshot(surroundings(texts, column), "surroundings")
    spelled = write_snapshot(_spellings(found), "spellings")
    seeds = spelled.filter((F.col("titled_n") > 0) & (F.col("mid") >= 9 * F.col("low"))).select("word", F.lit(1.0).alias("score"))
    known = write_snapshot(seeds, "name-seeds")
    seeds = known
    capital = found.filter(F.col("word").rlike(CAPITALISED))
    for _ in range(rounds):
        other = lambda side: known.select(F.col("word").alias(side), F.lit(1).alias(f"{side}_known"))
        beside = (
            capital.join(other("before"), "before", "left")
            .join(other("after"), "after", "left")
            .join(_contexts(found, known, "before"), "before", "left")
            .join(_contexts(found, known, "after"), "after", "left")
        )
        company = F.coalesce("before_known", "after_known").isNotNull()
        nearest = F.when(F.col("before_known").isNotNull(), F.col("before")).when(F.col("after_known").isNotNull(), F.col("after"))
        around = F.greatest(F.coalesce("before_share", F.lit(0.0)), F.coalesce("after_share", F.lit(0.0)))
        placed = ~F.col("start") & ~F.col("titled")
        sums = beside.groupBy("word").agg(
            F.sum(F.when(company, F.col("n")).otherwise(0)).alias("beside_n"),
            F.count_distinct(nearest).alias("neighbours"),
            F.sum(F.when(placed, F.col("n")).otherwise(0)).alias("placed_n"),
            F.sum(F.when(placed, around * F.col("n")).otherwise(0.0)).alias("context"),
        )
        evidence = write_snapshot(sums, "name-evidence")
        usual = evidence.join(known.select("word"), "word", "left_semi").agg(F.sum("context") / F.sum("placed_n")).first()[0]
        caps = F.col("caps")
        written = F.when(F.col("mid") > 0, F.col("mid") / (F.col("mid") + F.col("low"))).otherwise(
            F.when((F.col("neighbours") >= 3) & (F.col("beside_n") >= 0.9 * caps), caps / (caps + F.col("low"))).otherwise(0.0)
        )
        alike = F.least(F.col("context") / (F.col("placed_n") + 1) / F.lit(float(usual)), F.lit(1.0)) if usual else F.lit(0.0)
        without = (1 - F.col("titled_n") / caps) * (1 - F.col("beside_n") / caps) * (1 - alike)
        scored = spelled.join(evidence, "word").select("word", (written * (1 - without)).alias("score"))
        accepted = scored.filter(F.col("score") >= least).unionByName(seeds)
        known = write_snapshot(accepted.groupBy("word").agg(F.max("score").alias("score")), "name-parts")
    return known


def redact_names(texts: DataFrame, column: str, parts: DataFrame, label: str = "[NAME]") -> DataFrame:
    """The rows with every run of known parts, and an honorific before it, replaced in ``column``.

    Rows meet the parts through the distinct capitalised words of each distinct text; what comes back is one row per text
    that holds a name.
    """
    key = F.xxhash64(F.col(column))
    words = F.array_distinct(F.filter(_tokens(F.col(column)), lambda x: _is(x, CAPITALISED)))
    held = (
        texts.select(key.alias("_key"), F.explode(words).alias("word"))
        .distinct()
        .join(parts.select("word"), "word", "left_semi")
        .groupBy("_key")
        .agg(F.array_join(F.sort_array(F.collect_set("word"), asc=False), "|").alias("_names"))  # of one text
    )
    titles = "|".join(HONORIFICS)
    pattern = F.concat(
        F.lit(rf"(?<![A-Za-zÀ-ÖØ-öø-ÿ'-])(?:(?:{titles})[.]? )?(?:"),
        F.col("_names"),
        F.lit(")(?: (?:"),
        F.col("_names"),
        F.lit("))*(?![A-Za-zÀ-ÖØ-öø-ÿ'-])"),
    )
    replaced = F.when(F.col("_names").isNull(), F.col("_row")[column]).otherwise(
        F.regexp_replace(F.col("_row")[column], pattern, F.lit(label))
    )
    rows = texts.select(F.struct(*[F.col(f"`{c}`") for c in texts.columns]).alias("_row"), key.alias("_key"))
    joined = rows.join(held, "_key", "left")
    return joined.select(*[replaced.alias(c) if c == column else F.col("_row")[c].alias(c) for c in texts.columns])
