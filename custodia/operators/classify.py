"""Finding sensitive columns by content, in one scan of the table."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions.masks import severity_rank
from custodia.operators.paths import Leaf, leaves, readable, texts, written
from custodia.operators.tags import apply_tags, tags_of
from custodia.sources.tables import literal_rows

# Semantic category -> classification level (the standard profile).
LEVEL_OF_CATEGORY = {
    "EMAIL": "PII",
    "US_SOCIAL_SECURITY_NUMBER": "PII",
    "NATIONAL_IDENTIFIER": "PII",
    "US_BANK_ACCOUNT_NUMBER": "PII",
    "CREDIT_CARD_NUMBER": "PII",
    "PHONE_NUMBER": "RESTRICTED",
    "DATE_OF_BIRTH": "RESTRICTED",
    "NAME": "SENSITIVE",
    "STREET_ADDRESS": "SENSITIVE",
    "CITY": "SENSITIVE",
    "US_STATE": "SENSITIVE",
    "ZIP_CODE": "SENSITIVE",
    "JOB_TITLE": "INTERNAL",
    "OCCUPATION": "INTERNAL",
    "COMPANY": "INTERNAL",
}

# Payment card patterns of the custom classifier.
MASTERCARD = "^(?:5[1-5][0-9]{2}|222[1-9]|22[3-9][0-9]|2[3-6][0-9]{2}|27[01][0-9]|2720)[0-9]{12}$"
AMEX = "^3[4-7][0-9]{13}$"

HIGH_RATIO, MEDIUM_RATIO = 0.9, 0.5


@dataclass(frozen=True)
class Detector:
    """A category, a pattern every value is tested with, and a pattern for the column name.

    With ``needs_hint`` the content alone is too weak (any capitalised word could be a city), so
    the column name must agree. A content pattern of None relies on the name only.
    """

    name: str
    category: str
    privacy: str
    content: str | None
    hint: str
    needs_hint: bool = False


BUILT_IN = (
    Detector("email", "EMAIL", "IDENTIFIER", "^[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,255}[.][A-Za-z]{2,24}$", "mail"),
    Detector("ssn", "US_SOCIAL_SECURITY_NUMBER", "IDENTIFIER", "^[0-9]{3}-[0-9]{2}-[0-9]{4}$", "ssn|social"),
    Detector("national_id", "NATIONAL_IDENTIFIER", "IDENTIFIER", "^[A-Z]{2}[0-9]{6,12}$", "national|passport", True),
    Detector("bank_account", "US_BANK_ACCOUNT_NUMBER", "IDENTIFIER", "^[0-9]{8,17}$", "account|iban", True),
    Detector("card", "CREDIT_CARD_NUMBER", "IDENTIFIER", "^4[0-9]{15}$", "card"),
    Detector("phone", "PHONE_NUMBER", "IDENTIFIER", "^([+]?1[ .-]?)?([(]?[0-9]{3}[)]?[ .-])?[0-9]{3}[ .-][0-9]{4}$", "phone|mobile|tel"),
    Detector("birth_date", "DATE_OF_BIRTH", "QUASI_IDENTIFIER", "^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})$", "birth|dob", True),
    Detector("name", "NAME", "IDENTIFIER", "^[A-Z][^0-9@]{0,40}[0-9]*$", "first_?name|last_?name|full_?name", True),
    Detector("street", "STREET_ADDRESS", "IDENTIFIER", "^[0-9]{1,6} [A-Z][A-Za-z ]{1,60}$", "street|address"),
    Detector("city", "CITY", "QUASI_IDENTIFIER", "^[A-Z][^@]{0,60}$", "^city$|town", True),
    Detector("state", "US_STATE", "QUASI_IDENTIFIER", "^([A-Z]{2}|[A-Z][A-Za-z_ ]+[0-9]*)$", "^state$", True),
    Detector("zip", "ZIP_CODE", "QUASI_IDENTIFIER", "^[0-9]{5}(-[0-9]{4})?$", "zip|postal", True),
    Detector("job", "JOB_TITLE", "SENSITIVE", None, "^job", True),
    Detector("occupation", "OCCUPATION", "SENSITIVE", None, "occupation|profession", True),
    Detector("company", "COMPANY", "SENSITIVE", "(Inc|LLC|Corp|Ltd|GmbH|Industries|Systems|Enterprises)[.]?$", "company|employer"),
)

# The card patterns as a custom addition to the built-in set.
CARD_CLASSIFIER = (
    Detector("mc_payment_card", "CREDIT_CARD_NUMBER", "IDENTIFIER", MASTERCARD, "card"),
    Detector("amx_payment_card", "CREDIT_CARD_NUMBER", "IDENTIFIER", AMEX, "card"),
)


def detector_list(detectors: Sequence[Detector]) -> list[tuple[str, str, str | None]]:
    return [(d.name, d.category, d.content) for d in detectors]


def _hinted_columns(category: str, detectors: Sequence[Detector], places: Sequence[Leaf]) -> list[str]:
    hints = [d.hint for d in detectors if d.category == category]
    return [p.path for p in places if any(re.search(h, p.name.lower()) for h in hints)]


def _hit(category: str, detectors: Sequence[Detector], places: Sequence[Leaf]) -> Column:
    """Whether a (column_name, value) row counts for a category.

    Categories that need a matching name are only tested on columns that have one; which these are
    is known when the plan is built.
    """
    own = [d for d in detectors if d.category == category]
    test = None
    for d in own:
        if d.content:
            found = F.col("value").rlike(d.content)
            test = found if test is None else test | found
    test = F.col("value").isNotNull() if test is None else test
    if not own[0].needs_hint:
        return test
    hinted = _hinted_columns(category, detectors, places)
    return F.when(F.col("column_name").isin(hinted), test) if hinted else F.lit(False)


def match_counts(df: DataFrame, detectors: Sequence[Detector]) -> DataFrame:
    """Per column, and per path inside nested ones: non-NULL values and, per category, how many of them match.

    Columns and what lies in them become rows inside the scan stage and each task aggregates before the shuffle, so
    what travels is one row per place and task, whatever the size of the table.
    """
    places = [p for p in leaves(df.schema) if readable(p.kind)]
    categories = list(dict.fromkeys(d.category for d in detectors))
    plain = [p for p in places if not p.steps]
    if len(plain) == len(places):
        shown = df.select(*[written(F.col(f"`{p.column}`"), p.kind).alias(p.column) for p in plain])
        long = shown.unpivot([], [p.column for p in plain], "column_name", "value")
    else:
        each = [F.struct(F.lit(p.path).alias("column_name"), texts(p).alias("values")) for p in places]
        long = df.select(F.inline(F.array(*each))).select("column_name", F.explode("values").alias("value"))
    return long.groupBy("column_name").agg(
        F.count("value").alias("n_values"),
        *[F.count_if(_hit(c, detectors, places)).alias(c) for c in categories],
    )


def classify(df: DataFrame, detectors: Sequence[Detector] = BUILT_IN) -> DataFrame:
    """Recommended category per column or path inside a nested one. A preview: nothing is tagged."""
    places = leaves(df.schema)
    categories = list(dict.fromkeys(d.category for d in detectors))
    candidates = []
    for priority, category in enumerate(categories):
        own = [d for d in detectors if d.category == category]
        hinted = F.col("column_name").isin(_hinted_columns(category, detectors, places))
        ratio = F.when(hinted | F.lit(not own[0].needs_hint), F.col(category) / F.col("n_values"))
        # a matching name breaks ties between categories that fit the content equally well
        candidates.append(
            F.struct(
                (F.coalesce(ratio, F.lit(0.0)) + F.when(hinted, 0.001).otherwise(0.0)).alias("score"),
                F.lit(-priority).alias("rank"),
                F.lit(category).alias("semantic_category"),
                F.lit(own[0].privacy).alias("privacy_category"),
                F.coalesce(ratio, F.lit(0.0)).alias("ratio"),
            )
        )
    best = F.greatest(*candidates) if len(candidates) > 1 else candidates[0]
    return (
        match_counts(df, detectors)
        .filter(F.col("n_values") > 0)
        .select("column_name", "n_values", best.alias("best"))
        .filter(F.col("best.ratio") >= MEDIUM_RATIO)
        .select(
            "column_name",
            F.col("best.semantic_category").alias("semantic_category"),
            F.col("best.privacy_category").alias("privacy_category"),
            F.when(F.col("best.ratio") >= HIGH_RATIO, "HIGH").otherwise("MEDIUM").alias("confidence"),
            F.round("best.ratio", 4).alias("match_ratio"),
        )
    )


def with_levels(classified: DataFrame, level_of: dict[str, str] = LEVEL_OF_CATEGORY) -> DataFrame:
    """Map categories to levels; unmapped categories get none."""
    spark = classified.sparkSession
    mapping = literal_rows(spark, list(level_of.items()), "semantic_category string, classification_level string")
    return classified.join(mapping, "semantic_category", "left")


def apply_classification(df: DataFrame, classified: DataFrame) -> DataFrame:
    """Write the recommended levels into the column tags; existing tags of other columns stay."""
    rows = with_levels(classified).filter(F.col("classification_level").isNotNull()).collect()  # <= one per column
    return apply_tags(df, {**tags_of(df), **{r["column_name"]: r["classification_level"] for r in rows}})


def as_result_map(classified: DataFrame) -> DataFrame:
    """The classification of a table as one object keyed by column name."""
    value = F.struct("semantic_category", "privacy_category", "confidence")
    entries = F.collect_list(F.struct("column_name", value.alias("recommendation")))  # one per column
    return classified.agg(F.map_from_entries(entries).alias("classification_result"))


def flatten_result(result: DataFrame) -> DataFrame:
    """Back from the object to one row per column."""
    return result.select(F.explode("classification_result").alias("column_name", "r")).select(
        "column_name", "r.semantic_category", "r.privacy_category", "r.confidence"
    )


def due_for_scan(
    tables: DataFrame, as_of: Column, min_age_days: int = 0, validity_days: int = 90, include_views: bool = True
) -> DataFrame:
    """Tables old enough to classify whose last classification is missing or has expired."""
    old_enough = F.col("created_at") <= as_of - F.make_dt_interval(F.lit(min_age_days))
    expired = F.col("classified_at").isNull() | (
        F.col("classified_at") < as_of - F.make_dt_interval(F.lit(validity_days))
    )
    kind = F.lit(True) if include_views else F.col("table_type") != "VIEW"
    return tables.filter(old_enough & expired & kind)


def by_severity(levels: DataFrame) -> DataFrame:
    return levels.orderBy(severity_rank(F.col("classification_level")), "column_name")
