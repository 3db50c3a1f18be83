"""Governance coverage queries over the derived catalog and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.operators import coverage as cov
from custodia.sources import fixtures as fx
from custodia.workload import duck
from custodia.workload.registry import query

DB = fx.DATABASE
_IDENTIFYING = ("EMAIL", "US_SOCIAL_SECURITY_NUMBER", "PHONE_NUMBER", "CREDIT_CARD_NUMBER", "NAME")
_STRICT = _IDENTIFYING[:4]
_FULL = "object_database || '.' || object_schema || '.' || object_name"


@query(
    duck.with_tables(
        "tags", sql="SELECT tag_name, tag_value, object_name, domain, count(*) AS cnt FROM tags GROUP BY ALL"
    )
)
def tag_counts(spark: SparkSession, base: str) -> DataFrame:
    return cov.tag_counts(fx.tag_references(spark, base), DB)


@query(
    duck.with_tables(
        "policies", sql="SELECT policy_kind, policy_name, ref_entity_name, ref_column_name, policy_status FROM policies"
    )
)
def policy_references(spark: SparkSession, base: str) -> DataFrame:
    return cov.policy_list(fx.policy_references(spark, base), DB)


@query(
    duck.with_tables(
        "tags",
        "policies",
        sql=f"""SELECT full_table_name, string_agg(tag_value, ', ' ORDER BY tag_value) AS sensitive_types, '{cov.UNMASKED}' AS governance_status
    FROM (SELECT DISTINCT {_FULL} AS full_table_name, tag_value FROM tags WHERE tag_name = 'SEMANTIC_CATEGORY' AND domain = 'COLUMN'
      AND tag_value IN {duck.names(_IDENTIFYING)})
    WHERE full_table_name NOT IN (SELECT ref_entity_name FROM policies WHERE policy_kind = 'MASKING_POLICY' AND policy_status = 'ACTIVE')
    GROUP BY 1""",
    )
)
def unmasked_sensitive(spark: SparkSession, base: str) -> DataFrame:
    return cov.unmasked_sensitive(fx.tag_references(spark, base), fx.policy_references(spark, base), DB, _IDENTIFYING)


@query(
    duck.with_tables(
        "query_history",
        "access",
        "tags",
        sql=f"""SELECT user_name, role_name, start_time::DATE AS access_date, count(DISTINCT q.query_id) AS query_count,
      string_agg(DISTINCT o, ', ' ORDER BY o) AS tables_accessed
    FROM query_history q JOIN (SELECT query_id, unnest(direct) AS o FROM access) a ON q.query_id = a.query_id
    WHERE o IN (SELECT {_FULL} FROM tags WHERE tag_name = 'SEMANTIC_CATEGORY' AND domain = 'COLUMN' AND tag_value IN {duck.names(_STRICT)})
      AND start_time >= {duck.AS_OF} - to_days(7) GROUP BY 1, 2, 3""",
    )
)
def sensitive_access(spark: SparkSession, base: str) -> DataFrame:
    return cov.sensitive_access(
        fx.query_history(spark, base),
        fx.access_history(spark, base),
        fx.tag_references(spark, base),
        DB,
        _STRICT,
        fx.as_of(),
    )


@query(
    duck.with_tables(
        "catalog_tables",
        "tags",
        "policies",
        sql="""SELECT i.table_schema, total_tables, base_tables, views, coalesce(tt, 0) AS tagged_tables, coalesce(tc, 0) AS tables_with_tagged_columns,
      coalesce(pt, 0) AS protected_tables, round(coalesce(tt, 0) * 100.0::DOUBLE / total_tables, 1) AS pct_tagged,
      round(coalesce(pt, 0) * 100.0::DOUBLE / total_tables, 1) AS pct_protected,
      CASE WHEN coalesce(pt, 0) * 100.0 / total_tables >= 80 THEN 'Excellent' WHEN coalesce(pt, 0) * 100.0 / total_tables >= 60 THEN 'Good'
           WHEN coalesce(pt, 0) * 100.0 / total_tables >= 40 THEN 'Fair' ELSE 'Needs Improvement' END AS governance_grade
    FROM (SELECT table_schema, count(*) AS total_tables, count(*) FILTER (table_type = 'BASE TABLE') AS base_tables,
            count(*) FILTER (table_type = 'VIEW') AS views FROM catalog_tables GROUP BY 1) i
    LEFT JOIN (SELECT object_schema AS s, count(DISTINCT CASE WHEN domain = 'TABLE' THEN object_name END) AS tt,
            count(DISTINCT CASE WHEN domain = 'COLUMN' THEN object_name END) AS tc FROM tags GROUP BY 1) t ON t.s = i.table_schema
    LEFT JOIN (SELECT split_part(ref_entity_name, '.', 2) AS s, count(DISTINCT ref_entity_name) AS pt FROM policies GROUP BY 1) p ON p.s = i.table_schema""",
    )
)
def governance_coverage(spark: SparkSession, base: str) -> DataFrame:
    return cov.governance_coverage(
        fx.catalog_tables(spark, base), fx.tag_references(spark, base), fx.policy_references(spark, base), DB
    )


@query(
    duck.with_tables(
        "tags",
        sql="SELECT tag_name, tag_value, domain AS object_type, count(*) AS tagged_objects, count(DISTINCT object_name) AS unique_objects FROM tags GROUP BY 1, 2, 3",
    )
)
def tag_distribution(spark: SparkSession, base: str) -> DataFrame:
    return cov.tag_distribution(fx.tag_references(spark, base), DB).orderBy(F.desc("tagged_objects"))


@query(
    duck.with_tables(
        "policies",
        sql="""SELECT policy_kind, policy_status, count(DISTINCT policy_name) AS policy_count, count(DISTINCT ref_entity_name) AS protected_objects,
    count(DISTINCT ref_column_name) AS protected_columns FROM policies GROUP BY 1, 2""",
    )
)
def policy_distribution(spark: SparkSession, base: str) -> DataFrame:
    return cov.policy_distribution(fx.policy_references(spark, base), DB).orderBy(F.desc("policy_count"))


@query(
    duck.with_tables(
        "query_history",
        sql=f"""SELECT user_name, role_name, count(DISTINCT query_id) AS total_queries, count(DISTINCT start_time::DATE) AS active_days,
      round(avg(total_elapsed_time) / 1000, 3) AS avg_query_seconds, round(sum(bytes_scanned)::DOUBLE / 1073741824, 4) AS total_gb_scanned,
      min(start_time) AS first_access, max(start_time) AS last_access FROM query_history
    WHERE (query_text ILIKE '%lake.s2.t2%' OR query_text ILIKE '%lake.s3.t3%') AND start_time >= {duck.AS_OF} - to_days(30)
      AND execution_status = 'SUCCESS' GROUP BY 1, 2 ORDER BY total_queries DESC, user_name, role_name LIMIT 10""",
    )
)
def top_sensitive_users(spark: SparkSession, base: str) -> DataFrame:
    return cov.top_sensitive_users(fx.query_history(spark, base), ["LAKE.S2.T2", "LAKE.S3.T3"], fx.as_of())


@query(
    duck.with_tables(
        "query_history",
        "access",
        sql=f"""SELECT user_name, role_name, count(DISTINCT query_id) AS total_queries, count(DISTINCT start_time::DATE) AS active_days,
      round(avg(total_elapsed_time) / 1000, 3) AS avg_query_seconds, round(sum(bytes_scanned)::DOUBLE / 1073741824, 4) AS total_gb_scanned,
      min(start_time) AS first_access, max(start_time) AS last_access FROM query_history
    WHERE query_id IN (SELECT query_id FROM access WHERE list_has_any(direct, ['LAKE.S2.T2', 'LAKE.S3.T3']))
      AND start_time >= {duck.AS_OF} - to_days(30) AND execution_status = 'SUCCESS'
    GROUP BY 1, 2 ORDER BY total_queries DESC, user_name, role_name LIMIT 10""",
    )
)
def top_sensitive_users_logged(spark: SparkSession, base: str) -> DataFrame:
    """By the access log instead of the query text."""
    return cov.top_sensitive_users(
        fx.query_history(spark, base), ["LAKE.S2.T2", "LAKE.S3.T3"], fx.as_of(), access=fx.access_history(spark, base)
    )


@query(
    duck.with_tables(
        "policies",
        sql="SELECT policy_kind, policy_name, ref_column_name, policy_status FROM policies WHERE ref_entity_name = 'LAKE.S3.T3'",
    )
)
def policies_on_table(spark: SparkSession, base: str) -> DataFrame:
    return cov.policies_on_table(fx.policy_references(spark, base), "LAKE.S3.T3")


@query(
    duck.with_tables(
        "access",
        sql=f"""SELECT object_name, count(DISTINCT query_id) AS number_of_queries FROM
    (SELECT query_id, unnest(base) AS object_name FROM access
     WHERE list_contains(direct, 'LAKE.S0.T5') AND query_start_time >= {duck.AS_OF} - to_days(60))
    WHERE object_name <> 'LAKE.S0.T5' GROUP BY 1""",
    )
)
def semantic_lineage(spark: SparkSession, base: str) -> DataFrame:
    return cov.objects_used_by(fx.access_history(spark, base), "LAKE.S0.T5", fx.as_of())


@query(
    duck.with_tables(
        "tags",
        sql=f"SELECT {_FULL} AS table_name, column_name FROM tags WHERE domain = 'COLUMN' AND tag_name = 'DATA_CLASSIFICATION' AND tag_value = 'PII'",
    )
)
def columns_at_level(spark: SparkSession, base: str) -> DataFrame:
    return cov.columns_at_level(fx.tag_references(spark, base), DB, "DATA_CLASSIFICATION", "PII")
