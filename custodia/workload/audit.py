"""Audit, lineage and cost queries over the derived logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.operators import audit, insights
from custodia.sources import fixtures as fx
from custodia.workload import duck
from custodia.workload.registry import query

_WINDOW = f"query_start_time >= {duck.AS_OF} - to_days(60)"
_TABLE = ("LAKE", "S2", "T2")


@query(
    duck.with_tables(
        "access",
        sql=f"""SELECT object_name, count(DISTINCT query_id) AS number_of_queries FROM
    (SELECT query_id, unnest(direct) AS object_name FROM access WHERE {_WINDOW}) GROUP BY 1""",
    )
)
def audit_direct_access(spark: SparkSession, base: str) -> DataFrame:
    out = audit.direct_access(fx.access_history(spark, base), fx.as_of())
    return out.orderBy(F.desc("number_of_queries"), "object_name")


@query(
    duck.with_tables(
        "access",
        sql="""SELECT object_name, count(DISTINCT query_id) AS number_of_queries FROM
    (SELECT query_id, unnest(direct) AS object_name FROM access) WHERE object_name LIKE 'LAKE.S2.%' GROUP BY 1""",
    )
)
def audit_direct_access_prefix(spark: SparkSession, base: str) -> DataFrame:
    return audit.direct_access(fx.access_history(spark, base), fx.as_of(), days=None, name_prefix="LAKE.S2.")


@query(
    duck.with_tables(
        "access",
        sql=f"""SELECT object_name, query_type, count(DISTINCT query_id) AS number_of_queries, max(query_start_time) AS last_access FROM
    (SELECT query_id, query_start_time, CASE WHEN ddl IS NOT NULL THEN 'write' ELSE 'read' END AS query_type, unnest(direct) AS object_name
     FROM access WHERE {_WINDOW}) GROUP BY 1, 2""",
    )
)
def audit_read_write(spark: SparkSession, base: str) -> DataFrame:
    return audit.read_write(fx.access_history(spark, base), fx.as_of())


@query(
    duck.with_tables(
        "access",
        sql=f"""SELECT object_name, query_type, count(DISTINCT query_id) AS number_of_queries, max(query_start_time) AS last_access FROM
    (SELECT query_id, query_start_time, CASE WHEN ddl IS NOT NULL OR event_type = 'purchase' THEN 'write' ELSE 'read' END AS query_type,
     unnest(direct) AS object_name FROM access WHERE {_WINDOW}) GROUP BY 1, 2""",
    )
)
def audit_read_write_dml(spark: SparkSession, base: str) -> DataFrame:
    return audit.read_write(fx.access_history(spark, base), fx.as_of(), dml_as_write=True)


@query(
    duck.with_tables(
        "access",
        sql=f"""SELECT b AS object_name, count(DISTINCT query_id) AS number_of_queries FROM
    (SELECT query_id, b, unnest(direct) AS d FROM (SELECT query_id, direct, unnest(base) AS b FROM access WHERE {_WINDOW}))
    WHERE b <> d GROUP BY 1""",
    )
)
def audit_indirect_access(spark: SparkSession, base: str) -> DataFrame:
    out = audit.indirect_access(fx.access_history(spark, base), fx.as_of())
    return out.orderBy(F.desc("number_of_queries"), "object_name")


@query(
    duck.with_tables(
        "access",
        sql=f"""SELECT b AS object_name, count(DISTINCT query_id) AS number_of_queries FROM
    (SELECT query_id, direct, unnest(base) AS b FROM access WHERE {_WINDOW}) WHERE NOT list_contains(direct, b) GROUP BY 1""",
    )
)
def audit_indirect_access_strict(spark: SparkSession, base: str) -> DataFrame:
    return audit.indirect_access(fx.access_history(spark, base), fx.as_of(), strict=True)


@query(duck.with_tables("lineage_edges", sql="SELECT * FROM lineage_edges"))
def audit_column_lineage(spark: SparkSession, base: str) -> DataFrame:
    return audit.column_lineage(fx.access_history(spark, base))


@query(
    duck.with_tables(
        "lineage_edges",
        "tags",
        sql="""SELECT * FROM lineage_edges WHERE (source_object_name = 'LAKE.S2.T2' OR target_object_name = 'LAKE.S2.T2')
    AND (source_column_name IN (SELECT column_name FROM tags WHERE object_schema = 'S2' AND object_name = 'T2' AND domain = 'COLUMN'
           AND tag_name IN ('SEMANTIC_CATEGORY', 'DATA_CLASSIFICATION'))
      OR target_column_name IN (SELECT column_name FROM tags WHERE object_schema = 'S2' AND object_name = 'T2' AND domain = 'COLUMN'
           AND tag_name IN ('SEMANTIC_CATEGORY', 'DATA_CLASSIFICATION')))""",
    )
)
def audit_sensitive_lineage(spark: SparkSession, base: str) -> DataFrame:
    edges = audit.column_lineage(fx.access_history(spark, base))
    tags = fx.tag_references(spark, base)
    names = ("SEMANTIC_CATEGORY", "DATA_CLASSIFICATION")
    return audit.sensitive_lineage(edges, tags, "S2", "T2", "LAKE.S2.T2", names)


@query(duck.with_tables("deps", sql="SELECT * FROM deps"))
def dependencies_all(spark: SparkSession, base: str) -> DataFrame:
    return audit.dependencies(fx.object_dependencies(spark, base), fx.DATABASE)


@query(
    duck.with_tables(
        "deps",
        sql="SELECT referencing_object AS dependent_object, referencing_type AS object_type FROM deps WHERE referenced_object = 'LAKE.S2.T2'",
    )
)
def deps_downstream(spark: SparkSession, base: str) -> DataFrame:
    return audit.downstream(fx.object_dependencies(spark, base), _TABLE)


@query(
    duck.with_tables(
        "deps",
        sql="SELECT referenced_object AS source_object, referenced_type AS source_type FROM deps WHERE referencing_object = 'LAKE.S2.V12'",
    )
)
def deps_upstream(spark: SparkSession, base: str) -> DataFrame:
    return audit.upstream(fx.object_dependencies(spark, base), ("LAKE", "S2", "V12"))


@query(
    duck.with_tables(
        "grants",
        sql="""SELECT grantee_name, privilege, table_catalog || '.' || table_schema || '.' || name AS object_name, granted_on
    FROM grants WHERE grantee_name LIKE 'R_R%' AND deleted_on IS NULL""",
    )
)
def role_grants(spark: SparkSession, base: str) -> DataFrame:
    return audit.role_grants(fx.grants(spark, base), "R_R%").orderBy("grantee_name", "granted_on", "object_name")


@query(
    duck.with_tables(
        "query_history",
        sql=f"""SELECT role_name, count(DISTINCT query_id) AS query_count, count(DISTINCT user_name) AS user_count,
    min(start_time) AS first_used, max(start_time) AS last_used FROM query_history
    WHERE start_time >= {duck.AS_OF} - to_days(30) GROUP BY 1""",
    )
)
def active_roles(spark: SparkSession, base: str) -> DataFrame:
    return audit.active_roles(fx.query_history(spark, base), fx.as_of()).orderBy(F.desc("query_count"))


@query(
    duck.with_tables(
        "grants",
        "query_history",
        sql=f"""SELECT role_name, total_grants, n AS queries_recent,
      CASE WHEN n = 0 THEN 'DORMANT' WHEN total_grants > 20 AND n < 5 THEN 'OVER-PROVISIONED' ELSE 'ACTIVE' END AS effectiveness_status
    FROM (SELECT g.role_name, total_grants, coalesce(used, 0) AS n
      FROM (SELECT grantee_name AS role_name, count(*) AS total_grants FROM grants WHERE deleted_on IS NULL GROUP BY 1) g
      LEFT JOIN (SELECT role_name, count(DISTINCT query_id) AS used FROM query_history WHERE start_time >= {duck.AS_OF} - to_days(30) GROUP BY 1) u
      ON g.role_name = u.role_name)""",
    )
)
def role_effectiveness(spark: SparkSession, base: str) -> DataFrame:
    out = audit.role_effectiveness(fx.grants(spark, base), fx.query_history(spark, base), fx.as_of())
    return out.orderBy("role_name")


@query(
    duck.with_tables(
        "login_history",
        sql=f"""SELECT user_name, count(*) AS login_count, max(event_timestamp) AS last_login, min(event_timestamp) AS first_login_in_window,
      CASE WHEN max(event_timestamp) >= {duck.AS_OF} - to_days(7) THEN 'ACTIVE' WHEN max(event_timestamp) >= {duck.AS_OF} - to_days(30) THEN 'RECENT'
      ELSE 'STALE' END AS activity_status
    FROM login_history WHERE event_timestamp >= {duck.AS_OF} - to_days(60) AND is_success = 'YES' GROUP BY 1""",
    )
)
def login_activity(spark: SparkSession, base: str) -> DataFrame:
    return audit.login_activity(fx.login_history(spark, base), fx.as_of()).orderBy(F.desc("login_count"))


@query(
    f"""SELECT 'W' || (user_id % 3) AS warehouse_name, round(sum(value / 100), 2) AS total_credits, round(sum(value / 100 * 0.9::DOUBLE), 2) AS compute_credits,
    round(sum(value / 100 * 0.1::DOUBLE), 2) AS cloud_services_credits, count(DISTINCT ts::DATE) AS active_days FROM events
    WHERE ts >= {duck.AS_OF} - to_days(60) GROUP BY 1"""
)
def usage_by_warehouse(spark: SparkSession, base: str) -> DataFrame:
    return audit.usage_by_warehouse(fx.metering(spark, base), fx.as_of()).orderBy(F.desc("total_credits"))


@query(
    f"""SELECT 'user_' || user_id AS user_name, round(sum(value / 100), 2) AS compute_credits, count(DISTINCT event_id) AS query_count,
    round(sum(value / 100) / nullif(count(DISTINCT event_id), 0), 4) AS credits_per_query FROM events
    WHERE ts >= {duck.AS_OF} - to_days(60) GROUP BY 1 ORDER BY compute_credits DESC, user_name LIMIT 20"""
)
def cost_by_user(spark: SparkSession, base: str) -> DataFrame:
    return audit.cost_by_user(fx.attribution(spark, base), fx.as_of())


@query(
    duck.with_tables(
        "login_history",
        sql="""SELECT user_name, day, failures, trailing_mean FROM (
      SELECT user_name, day, failures, round(coalesce(sum(failures) OVER (PARTITION BY user_name ORDER BY day
        RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) / 7.0::DOUBLE, 4) AS trailing_mean
      FROM (SELECT user_name, event_timestamp::DATE AS day, count(*) AS failures FROM login_history WHERE is_success <> 'YES' GROUP BY 1, 2))
    WHERE failures >= 3 AND failures > trailing_mean * 3""",
    )
)
def login_anomaly(spark: SparkSession, base: str) -> DataFrame:
    return insights.login_spikes(fx.login_history(spark, base))


@query(
    duck.with_tables(
        "query_history",
        "access",
        "tags",
        sql=f"""SELECT user_name, count(*) AS queries, min(start_time) AS first_seen, max(start_time) AS last_seen FROM query_history
    WHERE (hour(start_time) < 7 OR hour(start_time) >= 19) AND start_time >= {duck.AS_OF} - to_days(30) AND query_id IN (SELECT query_id FROM (SELECT query_id, unnest(direct) AS o FROM access)
      WHERE o IN (SELECT object_database || '.' || object_schema || '.' || object_name FROM tags WHERE tag_value = 'PII')) GROUP BY 1""",
    )
)
def after_hours_access(spark: SparkSession, base: str) -> DataFrame:
    sensitive = (
        fx.tag_references(spark, base)
        .filter(F.col("tag_value") == "PII")
        .select(F.concat_ws(".", "object_database", "object_schema", "object_name").alias("object_name"))
        .distinct()
    )
    return insights.after_hours(fx.query_history(spark, base), fx.access_history(spark, base), sensitive, fx.as_of())


_COLUMNS = (
    "SELECT p_partkey AS p, c, ['STRING', 'BIGINT', 'DATE'][((p_partkey + c) % 3)::INT + 1] AS data_type "
    "FROM (SELECT p_partkey, unnest(generate_series(1, p_size % 4 + 1)) AS c FROM part)"
)


@query(
    f"""WITH old AS (SELECT p, c, data_type FROM ({_COLUMNS}) WHERE NOT (p % 13 = 0 AND c = 1)),
    new AS (SELECT p, c, CASE WHEN p % 11 = 0 AND c = 2 THEN 'VARIANT' ELSE data_type END AS data_type FROM ({_COLUMNS}) WHERE NOT (p % 17 = 0 AND c = 1))
    SELECT {duck.obj('p')} AS table_name, 'C' || c AS column_name, old.data_type AS old_type, new.data_type AS new_type,
      CASE WHEN old.data_type IS NULL THEN 'ADDED' WHEN new.data_type IS NULL THEN 'DROPPED' ELSE 'TYPE_CHANGED' END AS change
    FROM old FULL JOIN new USING (p, c) WHERE old.data_type IS DISTINCT FROM new.data_type"""
)
def schema_drift(spark: SparkSession, base: str) -> DataFrame:
    before, after = (fx.column_snapshot(spark, base, later=x) for x in (False, True))
    return insights.schema_drift(before, after)


@query(
    """SELECT 'SHARE_' || (l_partkey % 10) AS share_name, n_name AS target_region, count(*) AS transfers,
    sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS bytes_transferred
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2"""
)
def share_transfers(spark: SparkSession, base: str) -> DataFrame:
    return insights.share_transfers(fx.transfers(spark, base))


@query(
    duck.with_tables(
        "query_history",
        sql="""SELECT *, round((bytes_scanned - lag(bytes_scanned) OVER w) / nullif(lag(bytes_scanned) OVER w, 0)::DOUBLE, 4) AS bytes_change FROM (
      SELECT role_name, date_trunc('week', start_time)::DATE AS week, count(*) AS queries, round(avg(total_elapsed_time), 2) AS avg_elapsed,
        sum(bytes_scanned)::BIGINT AS bytes_scanned FROM query_history GROUP BY 1, 2) WINDOW w AS (PARTITION BY role_name ORDER BY week)""",
    )
)
def cost_trend(spark: SparkSession, base: str) -> DataFrame:
    return insights.cost_trend(fx.query_history(spark, base))


@query(
    duck.with_tables(
        "grants",
        sql=f"""SELECT grantee_name, privilege, table_schema, name, created_on FROM grants
    WHERE privilege IN ('OWNERSHIP', 'MANAGE GRANTS') AND deleted_on IS NULL AND created_on >= {duck.AS_OF} - to_days(7)""",
    )
)
def privilege_escalation(spark: SparkSession, base: str) -> DataFrame:
    now = fx.grants(spark, base)
    earlier = now.filter(F.col("created_on") < fx.as_of() - F.make_dt_interval(F.lit(7)))
    key = ("grantee_name", "privilege", "table_schema", "name")
    return insights.new_privileged_grants(earlier, now, fx.PRIVILEGED, key).select(*key, "created_on")
