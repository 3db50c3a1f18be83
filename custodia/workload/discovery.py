"""Classification of columns, tag listings, propagation to derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions.masks import LEVELS
from custodia.operators import classify as cl
from custodia.operators.governance import Governance
from custodia.operators.audit import column_lineage
from custodia.operators.propagation import column_levels, propagate_levels
from custodia.operators.tags import (
    TAG_NAME,
    apply_tags,
    difference,
    inherit,
    intersect,
    list_column_tags,
    lookup_tag,
    tags_of,
    union,
)
from custodia.sources import fixtures as fx
from custodia.sources.tables import read_table
from custodia.workload import duck
from custodia.workload.duck import strings
from custodia.workload.registry import query

_LEVEL_CASES = " ".join(f"WHEN '{c}' THEN '{v}'" for c, v in cl.LEVEL_OF_CATEGORY.items())
_SEVERITY = "CASE {0} WHEN 'PII' THEN 1 WHEN 'RESTRICTED' THEN 2 WHEN 'SENSITIVE' THEN 3 WHEN 'INTERNAL' THEN 4 WHEN 'PUBLIC' THEN 5 ELSE 6 END"


def _ratio(column: str, category: str, detectors) -> str:
    tests = [
        f"regexp_matches({column}::VARCHAR, '{d.content}')" for d in detectors if d.category == category and d.content
    ]
    return f"count(CASE WHEN {' OR '.join(tests) or 'TRUE'} THEN 1 END)::DOUBLE / count({column})"


# What each column of the people table should be found as, stated by hand.
_EXPECTED = (
    ("first_name", "NAME", "IDENTIFIER"),
    ("last_name", "NAME", "IDENTIFIER"),
    ("street_address", "STREET_ADDRESS", "IDENTIFIER"),
    ("state", "US_STATE", "QUASI_IDENTIFIER"),
    ("city", "CITY", "QUASI_IDENTIFIER"),
    ("zip", "ZIP_CODE", "QUASI_IDENTIFIER"),
    ("phone", "PHONE_NUMBER", "IDENTIFIER"),
    ("email", "EMAIL", "IDENTIFIER"),
    ("ssn", "US_SOCIAL_SECURITY_NUMBER", "IDENTIFIER"),
    ("birthdate", "DATE_OF_BIRTH", "QUASI_IDENTIFIER"),
    ("birth_date", "DATE_OF_BIRTH", "QUASI_IDENTIFIER"),
    ("job", "JOB_TITLE", "SENSITIVE"),
    ("card", "CREDIT_CARD_NUMBER", "IDENTIFIER"),
    ("company", "COMPANY", "SENSITIVE"),
)


def _classified_sql(detectors, columns) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{category}' AS semantic_category, '{privacy}' AS privacy_category, "
        f"{_ratio(c, category, detectors)} AS ratio FROM people"
        for c, category, privacy in columns
    )
    return (
        "SELECT column_name, semantic_category, privacy_category, CASE WHEN ratio >= 0.9 THEN 'HIGH' ELSE 'MEDIUM' END AS confidence, "
        f"round(ratio, 4) AS match_ratio FROM ({rows}) WHERE ratio >= 0.5"
    )


_WITHOUT_CARD = [e for e in _EXPECTED if e[0] != "card"]


@query(duck.with_tables("people", sql=_classified_sql(cl.BUILT_IN, _WITHOUT_CARD)))
def classify_columns(spark: SparkSession, base: str) -> DataFrame:
    """The built-in detectors; they do not know the card formats used here."""
    return cl.classify(fx.people(spark, base))


@query(duck.with_tables("people", sql=_classified_sql(cl.BUILT_IN + cl.CARD_CLASSIFIER, _EXPECTED)))
def custom_classifier(spark: SparkSession, base: str) -> DataFrame:
    """With the custom card patterns the card column is found as well."""
    return cl.classify(fx.people(spark, base), cl.BUILT_IN + cl.CARD_CLASSIFIER)


@query(
    """SELECT 'account_no' AS column_name, 'US_BANK_ACCOUNT_NUMBER' AS semantic_category, 'IDENTIFIER' AS privacy_category,
      'HIGH' AS confidence, 1.0::DOUBLE AS match_ratio FROM customer HAVING count(*) > 0
    UNION ALL SELECT 'dob', 'DATE_OF_BIRTH', 'QUASI_IDENTIFIER', 'HIGH', 1.0::DOUBLE FROM customer HAVING count(*) > 0
    UNION ALL SELECT 'pay_card', 'CREDIT_CARD_NUMBER', 'IDENTIFIER', 'HIGH', 1.0::DOUBLE FROM customer HAVING count(*) > 0"""
)
def classify_typed_columns(spark: SparkSession, base: str) -> DataFrame:
    """Account numbers, cards and birth dates stored as numbers and dates; plain numbers and prices are left alone."""
    typed = read_table(spark, base, "customer").selectExpr(
        "c_custkey",
        "100000000000 + c_custkey AS account_no",
        "date_add(DATE '1960-01-01', CAST(c_custkey % 15000 AS INT)) AS dob",
        "CAST(4000123400000000 + c_custkey AS DECIMAL(20, 0)) AS pay_card",
        "CAST(c_custkey % 7 AS INT) AS visits",
        "c_acctbal",
        "date_add(DATE '2020-01-01', CAST(c_custkey % 900 AS INT)) AS last_visit",
    )
    return cl.classify(typed)


# What lies in the nested people, stated by hand.
_INSIDE = (
    ("home.street", "STREET_ADDRESS", "IDENTIFIER"),
    ("home.city", "CITY", "QUASI_IDENTIFIER"),
    ("contacts[].mail", "EMAIL", "IDENTIFIER"),
    ("numbers{}", "PHONE_NUMBER", "IDENTIFIER"),
    ("paid_with", "CREDIT_CARD_NUMBER", "IDENTIFIER"),
    ("birth_time", "DATE_OF_BIRTH", "QUASI_IDENTIFIER"),
)


@query(
    duck.with_tables(
        "people",
        sql=" UNION ALL ".join(
            f"SELECT '{path}' AS column_name, '{category}' AS semantic_category, '{privacy}' AS privacy_category, "
            "'HIGH' AS confidence, 1.0::DOUBLE AS match_ratio FROM people HAVING count(*) > 0"
            for path, category, privacy in _INSIDE
        ),
    )
)
def classify_nested(spark: SparkSession, base: str) -> DataFrame:
    """Places inside structs, arrays and maps, and sensitive numbers and times of other types."""
    return cl.classify(fx.nested_people(spark, base))


@query(
    duck.with_tables(
        "people",
        sql="""SELECT c_custkey, left(street_address, 1) || repeat('*', length(street_address) - 1) AS street, (c_custkey % 9)::INT AS floor,
      '***PII-REDACTED***' AS mail, 'home' AS kind, '***-' || right(phone, 4) AS mobile, NULL::DOUBLE AS paid_with,
      date_trunc('day', birth_date)::TIMESTAMP AS birth_time, c_acctbal / 3 AS share FROM people""",
    )
)
def classify_and_mask_nested(spark: SparkSession, base: str) -> DataFrame:
    """Found, tagged and masked by path: mails inside an array of structs, numbers inside a map."""
    nested = fx.nested_people(spark, base)
    gov = Governance()
    gov.register("people", cl.apply_classification(nested, cl.classify(nested)))
    return gov.table("people", "DATA_USER").to_df().select(
        "c_custkey",
        "home.street",
        "home.floor",
        F.col("contacts")[1]["mail"].alias("mail"),
        F.col("contacts")[1]["kind"].alias("kind"),
        F.col("numbers")["mobile"].alias("mobile"),
        "paid_with",
        "birth_time",
        "share",
    )


@query(
    duck.with_tables(
        "people",
        sql=f"SELECT column_name, semantic_category, CASE semantic_category {_LEVEL_CASES} END AS classification_level "
        f"FROM ({_classified_sql(cl.BUILT_IN + cl.CARD_CLASSIFIER, _EXPECTED)})",
    )
)
def classification_levels(spark: SparkSession, base: str) -> DataFrame:
    levels = cl.with_levels(cl.classify(fx.people(spark, base), cl.BUILT_IN + cl.CARD_CLASSIFIER))
    return cl.by_severity(levels).select("column_name", "semantic_category", "classification_level")


@query(
    duck.with_tables(
        "people",
        sql="SELECT column_name, semantic_category, privacy_category, confidence "
        f"FROM ({_classified_sql(cl.BUILT_IN + cl.CARD_CLASSIFIER, _EXPECTED)})",
    )
)
def classification_flatten(spark: SparkSession, base: str) -> DataFrame:
    """The result as one object per table and back to rows."""
    found = cl.classify(fx.people(spark, base), cl.BUILT_IN + cl.CARD_CLASSIFIER)
    return cl.flatten_result(cl.as_result_map(found)).orderBy("column_name")


@query(
    duck.with_tables(
        "tags",
        sql=f"""SELECT object_schema, object_name, column_name, tag_value AS classification_level, {_SEVERITY.format('tag_value')} AS severity
    FROM tags WHERE tag_name = 'DATA_CLASSIFICATION' AND domain = 'COLUMN'""",
    )
)
def tag_listing(spark: SparkSession, base: str) -> DataFrame:
    return list_column_tags(fx.tag_references(spark, base))


@query(
    duck.with_tables(
        "tags",
        sql="SELECT tag_value FROM tags WHERE tag_name = 'DATA_CLASSIFICATION' AND object_name = 'T16' AND column_name = 'C3'",
    )
)
def tag_lookup(spark: SparkSession, base: str) -> DataFrame:
    return lookup_tag(fx.tag_references(spark, base), TAG_NAME, "T16", "C3")


_PROPAGATED = (
    ("state", None),
    ("city", "SENSITIVE"),
    ("contact", "PII"),
    ("balance", "RESTRICTED"),
    ("born_first", "RESTRICTED"),
    ("undeclared", "PII"),
    ("customers", None),
)


@query(
    duck.with_tables(
        "people",
        sql="WITH d AS (SELECT state, city, min(email || phone) AS contact, max(c_acctbal) AS balance, min(birth_date) AS born_first, "
        "max(length(company)) AS undeclared, count(*) AS customers FROM people GROUP BY state, city) "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{v}' AS classification_level, count({c}) AS n_values FROM d"
            for c, v in _PROPAGATED
            if v
        ),
    )
)
def tag_propagation(spark: SparkSession, base: str) -> DataFrame:
    """Tags of a table computed from the customers, with the values each tag now covers.

    Grouping columns are kept as they are; computed ones are declared; the undeclared one fails closed.
    """
    source = apply_tags(fx.people(spark, base), fx.PEOPLE_TAGS)
    derived = source.groupBy("state", "city").agg(
        F.min(F.concat("email", "phone")).alias("contact"),
        F.max("c_acctbal").alias("balance"),
        F.min("birth_date").alias("born_first"),
        F.max(F.length("company")).alias("undeclared"),
        F.count(F.lit(1)).alias("customers"),
    )
    lineage = {
        "contact": ["email", "phone"],
        "balance": ["c_acctbal"],
        "born_first": ["birth_date"],
        "customers": [],
    }
    tags = inherit(derived, [source], lineage, kept=["state", "city"])
    return _covered(apply_tags(derived, tags))


def _covered(tagged: DataFrame) -> DataFrame:
    """Every tagged column with its level and the number of values under it."""
    tags = tags_of(tagged)
    level = F.lit(None)
    for column, value in tags.items():
        level = F.when(F.col("column_name") == column, value).otherwise(level)
    return (
        tagged.agg(*[F.count(c).alias(c) for c in tags])
        .unpivot([], list(tags), "column_name", "n_values")
        .select("column_name", level.alias("classification_level"), "n_values")
    )


def _two_sides(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Customers as number, place and remark, and people of even numbers as number, mail and job."""
    people = apply_tags(fx.people(spark, base), fx.PEOPLE_TAGS)
    left = people.select("c_custkey", F.col("city").alias("place"), F.col("job").alias("remark"))
    right = people.filter("c_custkey % 2 = 0").select(
        "c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.col("city")).otherwise(F.col("email")).alias("mail"), "job"
    )
    return left, apply_tags(right, {"mail": "PII"})


def _set_sql(operation: str) -> str:
    return duck.with_tables(
        "people",
        sql=f"""WITH d AS (SELECT c_custkey, city AS place, job AS remark FROM people {operation}
      SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN city ELSE email END, job FROM people WHERE c_custkey % 2 = 0)
    SELECT 'place' AS column_name, 'PII' AS classification_level, count(place) AS n_values FROM d
    UNION ALL SELECT 'remark', 'INTERNAL', count(remark) FROM d""",
    )


@query(_set_sql("UNION ALL"))
def tags_of_union(spark: SparkSession, base: str) -> DataFrame:
    """Places and mails in one column: it takes the more severe tag, though the first input has the milder one."""
    left, right = _two_sides(spark, base)
    return _covered(union(left, right))


@query(_set_sql("INTERSECT"))
def tags_of_intersection(spark: SparkSession, base: str) -> DataFrame:
    left, right = _two_sides(spark, base)
    return _covered(intersect(left, right))


@query(_set_sql("EXCEPT"))
def tags_of_difference(spark: SparkSession, base: str) -> DataFrame:
    left, right = _two_sides(spark, base)
    return _covered(difference(left, right))


@query(
    duck.with_tables(
        "tags",
        "moved_columns",
        sql=f"""WITH RECURSIVE own AS (SELECT object_database || '.' || object_schema || '.' || object_name AS object_name, column_name,
        min({_SEVERITY.format('tag_value')}) AS rank FROM tags WHERE tag_name = 'DATA_CLASSIFICATION' AND domain = 'COLUMN' GROUP BY 1, 2),
    reach(object_name, column_name, rank) AS (SELECT * FROM own UNION SELECT target_object_name, target_column_name, rank
      FROM reach JOIN moved_columns ON object_name = source_object_name AND column_name = source_column_name),
    settled AS (SELECT object_name, column_name, min(rank) AS rank FROM reach GROUP BY 1, 2)
    SELECT object_name, column_name, {strings(LEVELS)}[settled.rank] AS classification_level, {strings(LEVELS)}[own.rank] AS own_level
    FROM settled LEFT JOIN own USING (object_name, column_name)""",
    )
)
def tag_movement(spark: SparkSession, base: str) -> DataFrame:
    """Levels of all columns after everything that the log says has moved, over chains and cycles."""
    lineage = column_lineage(fx.movement_history(spark, base))
    return propagate_levels(column_levels(fx.tag_references(spark, base)), lineage)


@query(
    duck.with_tables(
        "catalog_tables",
        sql=f"""SELECT table_schema, table_name FROM catalog_tables
    WHERE created_at <= {duck.AS_OF} AND (classified_at IS NULL OR classified_at < {duck.AS_OF} - to_days(90))""",
    )
)
def classification_due(spark: SparkSession, base: str) -> DataFrame:
    due = cl.due_for_scan(fx.catalog_tables(spark, base), fx.as_of(), min_age_days=0, validity_days=90)
    return due.select("table_schema", "table_name")


@query(
    duck.with_tables(
        "people",
        sql="""SELECT c_custkey, left(first_name, 1) || repeat('*', length(first_name) - 1) AS first_name,
    '***PII-REDACTED***' AS email, '***-' || right(phone, 4) AS phone, '***PII-REDACTED***' AS card, company FROM people""",
    )
)
def classify_and_mask(spark: SparkSession, base: str) -> DataFrame:
    """End to end: find, tag, mask, without a hand-written tag."""
    people = fx.people(spark, base).select("c_custkey", "first_name", "email", "phone", "card", "company")
    tagged = cl.apply_classification(people, cl.classify(people, cl.BUILT_IN + cl.CARD_CLASSIFIER))
    gov = Governance()
    gov.register("people", tagged)
    return gov.table("people", "DATA_USER").to_df()
