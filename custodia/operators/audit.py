"""Audit, lineage and cost analytics over nested access logs.

``as_of`` is always passed in; nothing reads the clock. Time filters stand directly on the log's time
column so that they reach the scan (and prune partitions of a log stored by day).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.operators.distinct import distinct_counts

# Layout of the access log.
_SOURCE = "struct<objectId: string, objectName: string, columnName: string>"
ACCESS_HISTORY_SCHEMA = (
    "query_id bigint, query_start_time timestamp_ntz, object_modified_by_ddl string, "
    "direct_objects_accessed array<struct<objectName: string>>, "
    "base_objects_accessed array<struct<objectName: string>>, "
    "objects_modified array<struct<objectName: string, columns: array<struct<columnName: string, "
    f"directSources: array<{_SOURCE}>, baseSources: array<{_SOURCE}>>>>>"
)


def since(time: Column, as_of: Column, days: int | None) -> Column:
    if days is None:
        return F.lit(True)
    return time >= as_of - F.make_dt_interval(F.lit(days))


def _per_object(rows: DataFrame, by: Sequence[str], one_row_per_query: bool, along=None) -> DataFrame:
    """Number of queries in a group of rows that name each object once, and other aggregates.

    Where the log is known to hold one row per query, rows are counted and only one number per group and task
    travels; else ids are, as bitmaps if the log's schema calls them dense.
    """
    along = along or {}
    if one_row_per_query:
        kinds = {"max": F.max}
        others = [kinds[function](argument).alias(name) for name, (function, argument) in along.items()]
        return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("number_of_queries"), *others)
    return distinct_counts(rows, by, {"number_of_queries": "query_id"}, along)


def _direct(access: DataFrame) -> DataFrame:
    """One row per query and object it names; a list naming an object twice counts once."""
    names = F.array_distinct(F.col("direct_objects_accessed.objectName"))
    return access.withColumn("object_name", F.explode(names))


def direct_access(
    access: DataFrame,
    as_of: Column,
    days: int | None = 60,
    name_prefix: str | None = None,
    one_row_per_query: bool = False,
) -> DataFrame:
    """Queries per directly named object."""
    rows = _direct(access.filter(since(F.col("query_start_time"), as_of, days)))
    if name_prefix is not None:
        rows = rows.filter(F.startswith(F.col("object_name"), F.lit(name_prefix)))
    return _per_object(rows, ["object_name"], one_row_per_query)


def read_write(
    access: DataFrame,
    as_of: Column,
    days: int | None = 60,
    dml_as_write: bool = False,
    one_row_per_query: bool = False,
) -> DataFrame:
    """Reads and writes per object with the last access.

    A write is a change by DDL; with ``dml_as_write`` also a query that modified any object.
    """
    write = F.col("object_modified_by_ddl").isNotNull()
    if dml_as_write:
        write = write | (F.coalesce(F.size("objects_modified"), F.lit(0)) > 0)
    rows = _direct(access.filter(since(F.col("query_start_time"), as_of, days)))
    rows = rows.withColumn("query_type", F.when(write, "write").otherwise("read"))
    last = {"last_access": ("max", F.col("query_start_time"))}
    return _per_object(rows, ["object_name", "query_type"], one_row_per_query, last)


def indirect_access(
    access: DataFrame,
    as_of: Column,
    days: int | None = 60,
    strict: bool = False,
    one_row_per_query: bool = False,
) -> DataFrame:
    """Queries that reach a base object while naming a different one.

    Tested inside the row's arrays, so the two lists are never multiplied. A base object that is
    itself named still counts when another object is named too; ``strict`` leaves those out.
    """
    rows = access.filter(since(F.col("query_start_time"), as_of, days)).select(
        "query_id",
        F.col("direct_objects_accessed.objectName").alias("_direct"),
        F.explode(F.array_distinct(F.col("base_objects_accessed.objectName"))).alias("object_name"),
    )
    if strict:
        other = (F.size("_direct") > 0) & ~F.array_contains("_direct", F.col("object_name"))
    else:
        other = F.exists("_direct", lambda d: d != F.col("object_name"))
    return _per_object(rows.filter(other), ["object_name"], one_row_per_query)


def column_lineage(access: DataFrame) -> DataFrame:
    """Distinct (source column, kind, target column) edges, direct and base.

    Both kinds leave one pass over the log. Columns and targets without sources stay, with NULLs.
    """
    kinds = F.array(
        F.struct(F.lit("DIRECT").alias("kind"), F.col("c.directSources").alias("sources")),
        F.struct(F.lit("BASE").alias("kind"), F.col("c.baseSources").alias("sources")),
    )
    return (
        access.select(F.explode("objects_modified").alias("m"))
        .select(F.col("m.objectName").alias("target_object_name"), F.explode_outer("m.columns").alias("c"))
        .select("target_object_name", F.col("c.columnName").alias("target_column_name"), F.explode(kinds).alias("k"))
        .select("target_object_name", "target_column_name", "k.kind", F.explode_outer("k.sources").alias("s"))
        .select(
            F.col("s.objectId").alias("source_object_id"),
            F.col("s.objectName").alias("source_object_name"),
            F.col("s.columnName").alias("source_column_name"),
            F.col("kind").alias("source_column_type"),
            "target_object_name",
            "target_column_name",
        )
        .distinct()
    )


def sensitive_lineage(
    lineage: DataFrame, tag_references: DataFrame, schema: str, table: str, full_name: str, tag_names: Sequence[str]
) -> DataFrame:
    """Lineage edges that touch one table through one of its tagged columns."""
    tagged = (
        tag_references.filter(
            (F.col("object_schema") == schema)
            & (F.col("object_name") == table)
            & (F.col("domain") == "COLUMN")
            & F.col("tag_name").isin(list(tag_names))
        )
        .select(F.col("column_name").alias("tagged_column"))
        .distinct()
    )
    touching = lineage.filter(
        (F.col("source_object_name") == full_name) | (F.col("target_object_name") == full_name)
    )
    # An OR across two columns would force a nested loop; test each edge's columns by key instead.
    ends = touching.withColumn("tagged_column", F.explode(F.array("source_column_name", "target_column_name")))
    return ends.join(tagged, "tagged_column", "left_semi").drop("tagged_column").distinct()


def dependencies(deps: DataFrame, database: str) -> DataFrame:
    """All object dependencies of one database."""
    return deps.filter(F.col("referencing_database") == database).select(
        _dotted("referencing").alias("referencing_object"),
        F.col("referencing_object_domain").alias("referencing_type"),
        _dotted("referenced").alias("referenced_object"),
        F.col("referenced_object_domain").alias("referenced_type"),
    )


def _dotted(side: str) -> Column:
    parts = [F.col(f"{side}_{p}") for p in ("database", "schema", "object_name")]
    return F.concat(parts[0], F.lit("."), parts[1], F.lit("."), parts[2])


def _is(side: str, full_name: Sequence[str]) -> Column:
    database, schema, name = full_name
    return (
        (F.col(f"{side}_database") == database)
        & (F.col(f"{side}_schema") == schema)
        & (F.col(f"{side}_object_name") == name)
    )


def downstream(deps: DataFrame, full_name: Sequence[str]) -> DataFrame:
    """Objects that use the given one, one hop."""
    return deps.filter(_is("referenced", full_name)).select(
        _dotted("referencing").alias("dependent_object"), F.col("referencing_object_domain").alias("object_type")
    )


def upstream(deps: DataFrame, full_name: Sequence[str]) -> DataFrame:
    """Objects the given one uses, one hop."""
    return deps.filter(_is("referencing", full_name)).select(
        _dotted("referenced").alias("source_object"), F.col("referenced_object_domain").alias("source_type")
    )


def role_grants(grants: DataFrame, pattern: str) -> DataFrame:
    """Live grants of the roles whose name matches a LIKE pattern."""
    return grants.filter(F.col("grantee_name").like(pattern) & F.col("deleted_on").isNull()).select(
        "grantee_name",
        "privilege",
        F.concat_ws(".", "table_catalog", "table_schema", "name").alias("object_name"),
        "granted_on",
    )


def active_roles(queries: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    times = {"first_used": ("min", F.col("start_time")), "last_used": ("max", F.col("start_time"))}
    recent = queries.filter(since(F.col("start_time"), as_of, days))
    counted = distinct_counts(recent, ["role_name"], {"query_count": "query_id", "user_count": "user_name"}, times)
    return counted.select("role_name", "query_count", "user_count", *times)


def role_effectiveness(grants: DataFrame, queries: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Granted against used: unused roles are dormant, much granted and hardly used ones over-provisioned."""
    granted = (
        grants.filter(F.col("deleted_on").isNull())
        .groupBy(F.col("grantee_name").alias("role_name"))
        .agg(F.count(F.lit(1)).alias("total_grants"))
    )
    used = distinct_counts(queries.filter(since(F.col("start_time"), as_of, days)), ["role_name"], {"_used": "query_id"})
    recent = F.coalesce(F.col("_used"), F.lit(0).cast("bigint"))
    return granted.join(used, "role_name", "left").select(
        "role_name",
        "total_grants",
        recent.alias("queries_recent"),
        F.when(recent == 0, "DORMANT")
        .when((F.col("total_grants") > 20) & (recent < 5), "OVER-PROVISIONED")
        .otherwise("ACTIVE")
        .alias("effectiveness_status"),
    )


def login_activity(logins: DataFrame, as_of: Column, days: int = 60) -> DataFrame:
    """Successful logins per user; active within 7 days, recent within 30, else stale."""
    last = F.max("event_timestamp")
    time = F.col("last_login")
    return (
        logins.filter(since(F.col("event_timestamp"), as_of, days) & (F.col("is_success") == "YES"))
        .groupBy("user_name")
        .agg(
            F.count(F.lit(1)).alias("login_count"),
            last.alias("last_login"),
            F.min("event_timestamp").alias("first_login_in_window"),
        )
        .withColumn(
            "activity_status",
            F.when(since(time, as_of, 7), "ACTIVE").when(since(time, as_of, 30), "RECENT").otherwise("STALE"),
        )
    )


def usage_by_warehouse(metering: DataFrame, as_of: Column, days: int = 60) -> DataFrame:
    return (
        metering.filter(since(F.col("start_time"), as_of, days))
        .groupBy("warehouse_name")
        .agg(
            F.round(F.sum("credits_used"), 2).alias("total_credits"),
            F.round(F.sum("credits_used_compute"), 2).alias("compute_credits"),
            F.round(F.sum("credits_used_cloud_services"), 2).alias("cloud_services_credits"),
            F.count_distinct(F.to_date("start_time")).alias("active_days"),
        )
    )


def cost_by_user(attribution: DataFrame, as_of: Column, days: int = 60, top: int = 20) -> DataFrame:
    """The top spenders; users of equal cost are ordered by name."""
    return (
        attribution.filter(since(F.col("start_time"), as_of, days))
        .groupBy("user_name")
        .agg(F.sum("credits_attributed_compute").alias("_c"), F.count_distinct("query_id").alias("query_count"))
        .select(
            "user_name",
            F.round("_c", 2).alias("compute_credits"),
            "query_count",
            F.round(F.col("_c") / F.nullif(F.col("query_count"), F.lit(0)), 4).alias("credits_per_query"),
        )
        .orderBy(F.desc("compute_credits"), "user_name")
        .limit(top)
    )
