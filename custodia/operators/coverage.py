"""Governance coverage: which sensitive data is tagged, protected and used by whom."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.operators.audit import since

CATEGORY_TAG = "SEMANTIC_CATEGORY"


def full_name(row_prefix: str = "object") -> Column:
    return F.concat_ws(".", *[F.col(f"{row_prefix}_{p}") for p in ("database", "schema", "name")])


def tag_counts(tags: DataFrame, database: str) -> DataFrame:
    return (
        tags.filter(F.col("object_database") == database)
        .groupBy("tag_name", "tag_value", "object_name", "domain")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def policy_list(policies: DataFrame, database: str) -> DataFrame:
    return policies.filter(F.col("policy_db") == database).select(
        "policy_kind", "policy_name", "ref_entity_name", "ref_column_name", "policy_status"
    )


def _sensitive(tags: DataFrame, database: str, categories: Sequence[str]) -> DataFrame:
    return tags.filter(
        (F.col("object_database") == database)
        & (F.col("tag_name") == CATEGORY_TAG)
        & (F.col("domain") == "COLUMN")
        & F.col("tag_value").isin(list(categories))
    )


def listed(values: Column, separator: str = ", ") -> Column:
    """Distinct values of a group, sorted, as text."""
    return F.array_join(F.array_sort(F.collect_set(values)), separator)


def unmasked_sensitive(
    tags: DataFrame, policies: DataFrame, database: str, categories: Sequence[str]
) -> DataFrame:
    """Tables with sensitive columns on which no active masking policy hangs."""
    masked = (
        policies.filter((F.col("policy_kind") == "MASKING_POLICY") & (F.col("policy_status") == "ACTIVE"))
        .select(F.col("ref_entity_name").alias("full_table_name"))
        .distinct()
    )
    return (
        _sensitive(tags, database, categories)
        .select(full_name().alias("full_table_name"), F.col("tag_value").alias("category"))
        .distinct()
        .join(masked, "full_table_name", "left_anti")
        .groupBy("full_table_name")
        .agg(listed(F.col("category")).alias("sensitive_types"))  # at most one entry per category
        .withColumn("governance_status", F.lit(UNMASKED))
    )


#: What the report says of a sensitive table without a masking policy.
UNMASKED = "sensitive, unmasked"


def sensitive_access(
    queries: DataFrame,
    access: DataFrame,
    tags: DataFrame,
    database: str,
    categories: Sequence[str],
    as_of: Column,
    days: int = 7,
) -> DataFrame:
    """Who used sensitive tables, per user, role and day.

    Both logs are cut to the window where they are read, the access log also to sensitive objects before they meet. What both
    aggregates count is distinct anyway, so nothing is made distinct in between: a very frequent
    object then stays splittable in the semi join. A user's ids are few among all, so they are counted as values: a
    bitmap per user, day and bucket would be nearly empty.
    """
    sensitive = _sensitive(tags, database, categories).select(full_name().alias("object_name")).distinct()
    touched = (
        access.filter(since(F.col("query_start_time"), as_of, days))
        .select("query_id", F.explode(F.col("direct_objects_accessed.objectName")).alias("object_name"))
        .join(sensitive, "object_name", "left_semi")
    )
    recent = queries.filter(since(F.col("start_time"), as_of, days)).select(
        "query_id", "user_name", "role_name", F.to_date("start_time").alias("access_date")
    )
    who = ["user_name", "role_name", "access_date"]
    # the list holds each table once, so it is bounded by the number of sensitive tables
    return (
        recent.join(touched, "query_id")
        .groupBy(*who)
        .agg(F.count_distinct("query_id").alias("query_count"), listed(F.col("object_name")).alias("tables_accessed"))
    )


def governance_coverage(tables: DataFrame, tags: DataFrame, policies: DataFrame, database: str) -> DataFrame:
    """Share of tagged and protected tables per schema, with a grade.

    Tag and policy sides are reduced to one row per table before they meet; the schema is taken
    from whichever side has it, so tables with only a policy count too.
    """
    inventory = tables.groupBy("table_schema").agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if(F.col("table_type") == "BASE TABLE").alias("base_tables"),
        F.count_if(F.col("table_type") == "VIEW").alias("views"),
    )
    tagged = (
        tags.filter(F.col("object_database") == database)
        .groupBy("object_schema", "object_name")
        .agg(
            F.max((F.col("domain") == "TABLE").cast("int")).alias("table_tag"),
            F.max((F.col("domain") == "COLUMN").cast("int")).alias("column_tag"),
        )
    )
    part = lambda i: F.split_part(F.col("ref_entity_name"), F.lit("."), F.lit(i))
    protected = (
        policies.filter((part(1) == database) & (F.col("ref_entity_domain") == "TABLE"))
        .select(part(2).alias("p_schema"), part(3).alias("p_name"))
        .distinct()
    )
    stats = (
        tagged.join(
            protected,
            (tagged["object_schema"] == protected["p_schema"]) & (tagged["object_name"] == protected["p_name"]),
            "full",
        )
        .groupBy(F.coalesce("object_schema", "p_schema").alias("table_schema"))
        .agg(
            F.count_if(F.col("table_tag") == 1).alias("tagged_tables"),
            F.count_if(F.col("column_tag") == 1).alias("tables_with_tagged_columns"),
            F.count("p_name").alias("protected_tables"),
        )
    )
    percent = lambda c: F.col(c) * F.lit(100.0) / F.nullif(F.col("total_tables"), F.lit(0))
    zero = ["tagged_tables", "tables_with_tagged_columns", "protected_tables"]
    joined = inventory.join(stats, "table_schema", "left").na.fill(0, zero)
    share = percent("protected_tables")
    return joined.select(
        "table_schema",
        "total_tables",
        "base_tables",
        "views",
        *zero,
        F.round(percent("tagged_tables"), 1).alias("pct_tagged"),
        F.round(share, 1).alias("pct_protected"),
        F.when(share >= 80, "Excellent")
        .when(share >= 60, "Good")
        .when(share >= 40, "Fair")
        .otherwise("Needs Improvement")
        .alias("governance_grade"),
    )


def tag_distribution(tags: DataFrame, database: str) -> DataFrame:
    return (
        tags.filter(F.col("object_database") == database)
        .groupBy("tag_name", "tag_value", F.col("domain").alias("object_type"))
        .agg(
            F.count(F.lit(1)).alias("tagged_objects"),
            F.count_distinct("object_name").alias("unique_objects"),
        )
    )


def policy_distribution(policies: DataFrame, database: str) -> DataFrame:
    in_database = F.split_part("ref_entity_name", F.lit("."), F.lit(1)) == database
    return (
        policies.filter(in_database)
        .groupBy("policy_kind", "policy_status")
        .agg(
            F.count_distinct("policy_name").alias("policy_count"),
            F.count_distinct("ref_entity_name").alias("protected_objects"),
            F.count_distinct("ref_column_name").alias("protected_columns"),
        )
    )


def top_sensitive_users(
    queries: DataFrame,
    object_names: Sequence[str],
    as_of: Column,
    days: int = 30,
    top: int = 10,
    access: DataFrame | None = None,
) -> DataFrame:
    """Users with most successful queries that use one of the objects.

    With the access log it is what the queries really read, by exact name. Without, their text must name an object,
    ignoring case, which also finds longer names that start alike. Ids and days of a user are counted as values, not by
    bitmaps: users grow with the log, and each has few of its ids.
    """
    recent = queries.filter(since(F.col("start_time"), as_of, days) & (F.col("execution_status") == "SUCCESS"))
    if access is None:
        named = F.lit(False)
        for name in object_names:
            named = named | F.contains(F.lower("query_text"), F.lit(name.lower()))
        found = recent.filter(named)
    else:
        names = F.col("direct_objects_accessed.objectName")
        used = access.filter(since(F.col("query_start_time"), as_of, days)).filter(
            F.arrays_overlap(names, F.array(*map(F.lit, object_names)))
        )
        found = recent.join(used.select("query_id"), "query_id", "left_semi")
    time = F.col("total_elapsed_time")
    return (
        found.groupBy("user_name", "role_name")
        .agg(
            F.count_distinct("query_id").alias("total_queries"),
            F.count_distinct(F.to_date("start_time")).alias("active_days"),
            (F.sum(time) / F.nullif(F.count(time), F.lit(0))).alias("_time"),
            F.sum("bytes_scanned").alias("_bytes"),
            F.min("start_time").alias("first_access"),
            F.max("start_time").alias("last_access"),
        )
        .select(
            "user_name",
            "role_name",
            "total_queries",
            "active_days",
            F.round(F.col("_time") / 1000, 3).alias("avg_query_seconds"),
            F.round(F.col("_bytes") / (1024 * 1024 * 1024), 4).alias("total_gb_scanned"),
            "first_access",
            "last_access",
        )
        .orderBy(F.desc("total_queries"), "user_name", "role_name")
        .limit(top)
    )


def policies_on_table(policies: DataFrame, table: str) -> DataFrame:
    return policies.filter(F.col("ref_entity_name") == table).select(
        "policy_kind", "policy_name", "ref_column_name", "policy_status"
    )


def columns_at_level(tags: DataFrame, database: str, tag_name: str, level: str) -> DataFrame:
    return tags.filter(
        (F.col("object_database") == database)
        & (F.col("domain") == "COLUMN")
        & (F.col("tag_name") == tag_name)
        & (F.col("tag_value") == level)
    ).select(full_name().alias("table_name"), "column_name")


def objects_used_by(access: DataFrame, view: str, as_of: Column, days: int | None = 60) -> DataFrame:
    """Base objects reached by queries of the window that name the given view."""
    names = F.col("direct_objects_accessed.objectName")
    return (
        access.filter(since(F.col("query_start_time"), as_of, days))
        .filter(F.array_contains(names, view))
        .select("query_id", F.explode(F.col("base_objects_accessed.objectName")).alias("object_name"))
        .filter(F.col("object_name") != view)
        .groupBy("object_name")
        .agg(F.count_distinct("query_id").alias("number_of_queries"))
    )
