"""Scenario tables derived from the given tables, each a pure function of keys and row values.

Customers get personal columns, orders get free-text feedback, events become access, query and
login logs, parts and line items become a catalog of tables, tags, policies, grants and dependencies.
All of them grow with the tables they come from.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.operators.distinct import mark_dense
from custodia.sources.generators import COMPANIES
from custodia.sources.tables import literal_rows, read_table

AS_OF_TEXT = "2024-01-31 00:00:00"
AS_OF_SQL = f"TIMESTAMP_NTZ '{AS_OF_TEXT}'"
DATABASE = "LAKE"


def as_of() -> Column:
    return F.lit(AS_OF_TEXT).cast("timestamp_ntz")


def pick_sql(values: Sequence[str], index: str) -> str:
    """The value at a computed position of a list."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), CAST({index} AS INT) + 1)"


def back(days: str) -> str:
    """The moment some days before the reference time."""
    return f"{AS_OF_SQL} - make_dt_interval(CAST({days} AS INT))"


# --- people -------------------------------------------------------------------------------------

PEOPLE_TAGS = {
    "email": "PII",
    "ssn": "PII",
    "card": "PII",
    "phone": "RESTRICTED",
    "birthdate": "RESTRICTED",
    "birth_date": "RESTRICTED",
    "c_acctbal": "RESTRICTED",
    "first_name": "SENSITIVE",
    "last_name": "SENSITIVE",
    "street_address": "SENSITIVE",
    "city": "SENSITIVE",
    "zip": "SENSITIVE",
    "company": "INTERNAL",
    "job": "INTERNAL",
}

JOBS = ("Clerk", "Nurse", "Teacher", "Engineer", "Driver", "Analyst", "Cook")


def people(spark: SparkSession, base: str) -> DataFrame:
    """Customers with personal columns."""
    nation = read_table(spark, base, "nation").selectExpr("n_nationkey", "n_name AS state")
    customers = read_table(spark, base, "customer")
    ssn = "lpad(CAST(c_custkey AS STRING), 9, '0')"
    born = "date_add(DATE '1950-01-01', CAST(c_custkey % 20000 AS INT))"
    return customers.join(nation, customers["c_nationkey"] == nation["n_nationkey"]).selectExpr(
        "c_custkey",
        "concat('First', c_custkey) AS first_name",
        "concat('Last', c_custkey % 1000) AS last_name",
        "concat(c_custkey % 900 + 100, ' Oak Street') AS street_address",
        "state",
        "concat('City', c_custkey % 100) AS city",
        "lpad(CAST(c_custkey % 90000 + 10000 AS STRING), 5, '0') AS zip",
        "concat('555-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) AS phone",
        "concat('cust', c_custkey, '@example.com') AS email",
        f"concat(substring({ssn}, 1, 3), '-', substring({ssn}, 4, 2), '-', substring({ssn}, 6, 4)) AS ssn",
        f"CAST({born} AS STRING) AS birthdate",
        f"{born} AS birth_date",
        "TIMESTAMP_NTZ '2020-01-01 00:00:00' + make_dt_interval(0, 0, CAST(c_custkey % 1000000 AS INT)) AS created_at",
        f"{pick_sql(JOBS, f'c_custkey % {len(JOBS)}')} AS job",
        """CASE WHEN c_custkey % 2 = 0 THEN concat('34', lpad(CAST(c_custkey AS STRING), 13, '0'))
             ELSE concat('51', lpad(CAST(c_custkey AS STRING), 14, '0')) END AS card""",
        f"{pick_sql(COMPANIES, f'c_custkey % {len(COMPANIES)}')} AS company",
        "CASE WHEN c_custkey % 10 = 9 THEN NULL WHEN c_custkey % 3 = 0 THEN 'N' ELSE 'Y' END AS optin",
        "c_acctbal",
        "c_mktsegment",
    )


def nested_people(spark: SparkSession, base: str) -> DataFrame:
    """People with an address as a struct, contacts as an array of structs, numbers as a map, and a card as a double."""
    return people(spark, base).selectExpr(
        "c_custkey",
        "named_struct('street', street_address, 'city', city, 'floor', CAST(c_custkey % 9 AS INT)) AS home",
        "array(named_struct('kind', 'work', 'mail', email), named_struct('kind', 'home', 'mail', concat('own.', email))) AS contacts",
        "map('desk', phone, 'mobile', phone) AS numbers",
        "CAST(concat('4', lpad(CAST(c_custkey AS STRING), 15, '0')) AS DOUBLE) AS paid_with",
        "CAST(birth_date AS TIMESTAMP_NTZ) AS birth_time",
        "c_acctbal / 3 AS share",
    )


def row_policy_map(spark: SparkSession) -> DataFrame:
    """Which states each role may see."""
    rows = [("DATA_USER", "NATION_3"), ("DATA_USER", "NATION_7"), ("DATA_USER", "NATION_11")]
    return literal_rows(spark, rows, "role string, visible_value string")


def sales(spark: SparkSession, base: str) -> DataFrame:
    """Orders with the amounts and currency of the order model."""
    amount = "round(o_totalprice / 1.1D, 2)"
    return read_table(spark, base, "orders").selectExpr(
        "*",
        f"{amount} AS order_amount",
        f"round(o_totalprice - {amount}, 2) AS order_tax",
        f"{pick_sql(('USD', 'EUR', 'GBP'), 'o_custkey % 3')} AS order_currency",
    )


# --- feedback -----------------------------------------------------------------------------------

# Notes of concert guests. Some names are not on the detector's list, one note is empty.
FEEDBACK = (
    "The hall was cold, but the choir was wonderful. {L}",
    "Could Yusuf {L} move my ticket to Sunday? I am at {P} after five.",
    "",
    "Lost my season pass; the desk mailed a new one to {E} within an hour. Impressed.",
    "Refund the parking fee, the barrier would not open.",
    "My son was born {B}, does he need a ticket of his own?",
    "Expedited entry for wheelchairs was helpful, so was Svetlana {L} at the gate.",
    "Dr. {L} of {A} offers to sponsor the summer concerts.",
    "A wholesale block of forty seats for our school: write to {E}, Mrs. {L} decides.",
    "The credit card reader at the bar failed twice with {C}.",
    "Privacy: someone read out {S} from the guest list at the entrance!",
    "A late start again and no word from the stage. Disappointed.",
    "Sofia {L} plays the cello like nobody else, we love it.",
    "Which programme book is for sale online?",
)


SURNAMES = ("Okafor", "Lindqvist", "Tanaka", "Brennan", "Petrov")


def feedback_text(key: str) -> Column:
    """One of the notes with personal details that vary with the key."""
    digits = lambda modulus, width: f"lpad(CAST({key} % {modulus} AS STRING), {width}, '0')"
    parts = {
        "{L}": pick_sql(SURNAMES, f"{key} % {len(SURNAMES)}"),
        "{E}": f"concat('user.', {key}, '@mail', {key} % 10, '.example.com')",
        "{P}": f"concat('555-', {digits(1000, 3)}, '-', {digits(10000, 4)})",
        "{S}": f"concat('9', {digits(100, 2)}, '-12-', {digits(10000, 4)})",
        "{A}": f"concat({key} % 900 + 1, ' Maple Street, Dover NH 0', {key} % 9000 + 1000)",
        "{C}": f"concat('4000 1234 5678 ', {digits(10000, 4)})",
        "{B}": f"concat({key} % 12 + 1, '/', {key} % 28 + 1, '/', {key} % 50 + 1950)",
    }
    cases = []
    for i, template in enumerate(FEEDBACK):
        pieces = [parts.get(piece, f"'{piece}'") for piece in re.split(r"(\{[A-Z]\})", template) if piece]
        cases.append(f"WHEN {i} THEN concat({', '.join(pieces) or chr(39) * 2})")
    return F.expr(f"CASE {key} % {len(FEEDBACK)} {' '.join(cases)} END")


def feedback(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", feedback_text("o_orderkey").alias("feedback")
    )


# --- logs from events ---------------------------------------------------------------------------


def object_sql(index: str) -> str:
    """Full name of the catalog table with this number."""
    return f"concat('{DATABASE}.S', ({index}) % 5, '.T', {index})"


# The logs speak of the first eight catalog tables.
LOG_OBJECTS = tuple(f"{DATABASE}.S{i % 5}.T{i}" for i in range(8))
_LOG_IDS = tuple(f"id{i}" for i in range(8))


def _events(spark: SparkSession, base: str) -> DataFrame:
    events = read_table(spark, base, "events")
    return events.selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")


def access_history(spark: SparkSession, base: str) -> DataFrame:
    """One log row per event: direct and base objects, DDL mark for signups, modified columns for purchases."""
    named = lambda i: f"named_struct('objectName', {pick_sql(LOG_OBJECTS, i)})"
    source = lambda i, c: (
        f"named_struct('objectId', {pick_sql(_LOG_IDS, i)}, 'objectName', {pick_sql(LOG_OBJECTS, i)}, 'columnName', '{c}')"
    )
    nothing = "CAST(array() AS ARRAY<STRUCT<objectId: STRING, objectName: STRING, columnName: STRING>>)"
    # C1 always has two direct sources and, for odd k, a base source; C2 has neither for k divisible by 3
    c1 = f"""named_struct('columnName', 'C1', 'directSources', array({source('k % 8', 'C1')}, {source('(k + 1) % 8', 'C2')}),
             'baseSources', CASE WHEN k % 2 = 1 THEN array({source('k % 4', 'C1')}) ELSE {nothing} END)"""
    c2 = f"""named_struct('columnName', 'C2',
             'directSources', CASE WHEN k % 3 = 0 THEN {nothing} ELSE array({source('k % 8', 'C2')}) END,
             'baseSources', CASE WHEN k % 3 = 0 THEN {nothing} ELSE array({source('k % 4', 'C3')}) END)"""
    log = _events(spark, base).selectExpr(
        "event_id AS query_id",
        "ts AS query_start_time",
        "CASE WHEN event_type = 'signup' THEN 'CREATE' END AS object_modified_by_ddl",
        f"""CASE WHEN event_id % 3 = 0 THEN array({named('k % 8')}, {named('(k + 1) % 8')})
            ELSE array({named('k % 8')}) END AS direct_objects_accessed""",
        f"array({named('k % 4')}) AS base_objects_accessed",
        f"""CASE WHEN event_type = 'purchase' THEN
            array(named_struct('objectName', {pick_sql(LOG_OBJECTS, '(k + 3) % 8')}, 'columns', array({c1}, {c2}))) END AS objects_modified""",
    )
    return mark_dense(log, "query_id")


def movement_history(spark: SparkSession, base: str) -> DataFrame:
    """The access log of copies between part tables, one row per line item: C1 and C2 of a table go into the next one.

    Six tables in a row form a chain (crossing columns on the way); the fifth also flows back into the second.
    """
    named = lambda i: f"concat('{DATABASE}.S', ({i}) % 5, '.T', {i})"
    source = lambda i, c: f"named_struct('objectId', concat('id', {i}), 'objectName', {named(i)}, 'columnName', '{c}')"
    nothing = "CAST(array() AS ARRAY<STRUCT<objectId: STRING, objectName: STRING, columnName: STRING>>)"
    column = lambda c, *sources: (
        f"named_struct('columnName', '{c}', 'directSources', array({', '.join(sources)}), 'baseSources', {nothing})"
    )
    onward = f"named_struct('objectName', {named('p + 1')}, 'columns', array({column('C1', source('p', 'C2'))}, {column('C2', source('p', 'C1'), source('p', 'C3'))}))"
    back_again = f"named_struct('objectName', {named('p - 3')}, 'columns', array({column('C1', source('p', 'C1'))}))"
    moved = f"CASE WHEN p % 6 = 4 THEN array({onward}, {back_again}) WHEN p % 6 <> 5 THEN array({onward}) END"
    copies = read_table(spark, base, "lineitem").selectExpr("l_orderkey AS query_id", "l_partkey AS p")
    return copies.selectExpr("query_id", f"{moved} AS objects_modified")


def query_history(spark: SparkSession, base: str) -> DataFrame:
    log = _events(spark, base).selectExpr(
        "event_id AS query_id",
        "concat('user_', user_id) AS user_name",
        "CASE WHEN event_id < 4 THEN 'R_RARE' ELSE concat('R_', user_id % 4) END AS role_name",
        "ts AS start_time",
        f"concat('select * from ', {pick_sql(LOG_OBJECTS, 'k % 8')}) AS query_text",
        "CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'SUCCESS' END AS execution_status",
        "CAST(round(value * 100) AS BIGINT) AS total_elapsed_time",
        "CAST(round(value * 1000000) AS BIGINT) AS bytes_scanned",
    )
    return mark_dense(log, "query_id")


def login_history(spark: SparkSession, base: str) -> DataFrame:
    """Signups are logins, errors failed ones; some users' events lie 20 or 40 days further back."""
    events = read_table(spark, base, "events").filter("event_type IN ('signup', 'error')")
    return events.selectExpr(
        "concat('user_', user_id) AS user_name",
        "ts - make_dt_interval(CAST(user_id % 3 * 20 AS INT)) AS event_timestamp",
        "CASE WHEN event_type = 'signup' THEN 'YES' ELSE 'NO' END AS is_success",
    )


def metering(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "events").selectExpr(
        "concat('W', user_id % 3) AS warehouse_name",
        "ts AS start_time",
        "value / 100 AS credits_used",
        "value / 100 * 0.9D AS credits_used_compute",
        "value / 100 * 0.1D AS credits_used_cloud_services",
    )


def attribution(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "events").selectExpr(
        "event_id AS query_id",
        "concat('user_', user_id) AS user_name",
        "ts AS start_time",
        "value / 100 AS credits_attributed_compute",
    )


# --- catalog from parts, suppliers and line items --------------------------------------------------

CATEGORIES = (
    "EMAIL", "US_SOCIAL_SECURITY_NUMBER", "PHONE_NUMBER", "CREDIT_CARD_NUMBER", "NAME", "CITY", "JOB_TITLE",
)
_LEVELS = ("PII", "RESTRICTED", "SENSITIVE", "INTERNAL", "PUBLIC")


def catalog_tables(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "part").selectExpr(
        f"'{DATABASE}' AS table_catalog",
        "concat('S', p_partkey % 5) AS table_schema",
        "concat('T', p_partkey) AS table_name",
        "CASE WHEN p_partkey % 4 = 0 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type",
        f"{back('p_size * 10')} AS created_at",
        f"CASE WHEN p_partkey % 7 <> 0 THEN {back('p_partkey % 200')} END AS classified_at",
    )


def tag_references(spark: SparkSession, base: str) -> DataFrame:
    """A table tag and up to three column tags per part; every seventh table has none."""
    categorised = "i > 0 AND (p + i) % 2 = 0"
    numbered = (
        read_table(spark, base, "part")
        .filter("p_partkey % 7 <> 6")
        .selectExpr("p_partkey AS p", "explode(sequence(0, CAST(p_size % 4 AS INT))) AS i")
    )
    return numbered.selectExpr(
        f"'{DATABASE}' AS object_database",
        "concat('S', p % 5) AS object_schema",
        "concat('T', p) AS object_name",
        "CASE WHEN i > 0 THEN concat('C', i) END AS column_name",
        "CASE WHEN i > 0 THEN 'COLUMN' ELSE 'TABLE' END AS domain",
        f"CASE WHEN {categorised} THEN 'SEMANTIC_CATEGORY' ELSE 'DATA_CLASSIFICATION' END AS tag_name",
        f"""CASE WHEN {categorised} THEN {pick_sql(CATEGORIES, f'(p + i) % {len(CATEGORIES)}')}
            ELSE {pick_sql(_LEVELS, f'(p + i) % {len(_LEVELS)}')} END AS tag_value""",
    )


def policy_references(spark: SparkSession, base: str) -> DataFrame:
    """Masking or row policies on two of three tables, one in eleven inactive."""
    return (
        read_table(spark, base, "part")
        .filter("p_partkey % 3 <> 2")
        .selectExpr(
            f"'{DATABASE}' AS policy_db",
            "CASE WHEN p_partkey % 3 = 0 THEN 'MASKING_POLICY' ELSE 'ROW_ACCESS_POLICY' END AS policy_kind",
            "concat('POL_', p_partkey % 4) AS policy_name",
            "CASE WHEN p_partkey % 11 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS policy_status",
            f"{object_sql('p_partkey')} AS ref_entity_name",
            "'TABLE' AS ref_entity_domain",
            "CASE WHEN p_partkey % 3 = 0 THEN 'C1' END AS ref_column_name",
        )
    )


def object_dependencies(spark: SparkSession, base: str) -> DataFrame:
    """Views (one per part) over tables (one per supplier), linked where a line item links them."""
    links = read_table(spark, base, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return links.selectExpr(
        f"'{DATABASE}' AS referencing_database",
        "concat('S', l_partkey % 5) AS referencing_schema",
        "concat('V', l_partkey) AS referencing_object_name",
        "'VIEW' AS referencing_object_domain",
        f"'{DATABASE}' AS referenced_database",
        "concat('S', l_suppkey % 5) AS referenced_schema",
        "concat('T', l_suppkey) AS referenced_object_name",
        "'TABLE' AS referenced_object_domain",
    )


PRIVILEGES = ("SELECT", "INSERT", "OWNERSHIP", "MANAGE GRANTS")
PRIVILEGED = ("OWNERSHIP", "MANAGE GRANTS")


def grants(spark: SparkSession, base: str) -> DataFrame:
    """One grant per part: an eighth to a rarely used role, an eighth to a dormant one, some deleted."""
    return read_table(spark, base, "part").selectExpr(
        """CASE WHEN p_partkey % 8 = 0 THEN 'R_RARE' WHEN p_partkey % 8 = 1 THEN 'R_DORMANT'
           ELSE concat('R_', p_partkey % 4) END AS grantee_name""",
        f"{pick_sql(PRIVILEGES, f'p_size % {len(PRIVILEGES)}')} AS privilege",
        f"'{DATABASE}' AS table_catalog",
        "concat('S', p_partkey % 5) AS table_schema",
        "concat('T', p_partkey) AS name",
        "'TABLE' AS granted_on",
        f"{back('p_partkey % 60')} AS created_on",
        f"CASE WHEN p_partkey % 10 = 7 THEN {AS_OF_SQL} END AS deleted_on",
    )


def column_snapshot(spark: SparkSession, base: str, later: bool) -> DataFrame:
    """Columns of the catalog tables before and after some drops, additions and type changes."""
    columns = read_table(spark, base, "part").selectExpr(
        "p_partkey AS p", "explode(sequence(1, CAST(p_size % 4 AS INT) + 1)) AS c"
    )
    data_type = pick_sql(("STRING", "BIGINT", "DATE"), "(p + c) % 3")
    if later:
        columns = columns.filter("NOT (p % 17 = 0 AND c = 1)")
        data_type = f"CASE WHEN p % 11 = 0 AND c = 2 THEN 'VARIANT' ELSE {data_type} END"
    else:
        columns = columns.filter("NOT (p % 13 = 0 AND c = 1)")
    return columns.selectExpr(
        f"{object_sql('p')} AS table_name", "concat('C', c) AS column_name", f"{data_type} AS data_type"
    )


def transfers(spark: SparkSession, base: str) -> DataFrame:
    """Every line item is a transfer to the region of its supplier."""
    supplier = read_table(spark, base, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, base, "nation").selectExpr("n_nationkey", "n_name AS target_region")
    lines = read_table(spark, base, "lineitem").selectExpr(
        "l_suppkey",
        "concat('SHARE_', l_partkey % 10) AS share_name",
        "CAST(round(l_extendedprice * 100) AS BIGINT) AS bytes_transferred",
    )
    return (
        lines.join(supplier, lines["l_suppkey"] == supplier["s_suppkey"])
        .join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
        .select("share_name", "target_region", "bytes_transferred")
    )
