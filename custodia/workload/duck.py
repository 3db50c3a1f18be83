"""The scenario tables of ``custodia.sources.fixtures`` as SQL for the checking engine."""

from __future__ import annotations

import re

from custodia.functions.text import DEFAULT_TOPIC, ENTITIES, NEGATIVE, POSITIVE, TOPICS, Entity
from custodia.sources import fixtures as fx
from custodia.sources import generators as gen

AS_OF = f"TIMESTAMP '{fx.AS_OF_TEXT}'"


def strings(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def names(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def pick(values, index: str) -> str:
    return f"{strings(values)}[CAST({index} AS INT) + 1]"


def hash_long(value: str, salt: str = "", digits: int = 15) -> str:
    return f"CAST('0x' || substr(md5('{salt}' || ({value})), 1, {digits}) AS BIGINT)"


def uniform(value: str, salt: str = "") -> str:
    return f"((CAST({hash_long(value, salt, 13)} AS DOUBLE) + 0.5) / 4503599627370496.0)"


def laplace(value: str, scale: float, salt: str = "") -> str:
    u = f"({uniform(value, salt)} - 0.5)"
    return f"(-{scale!r}::DOUBLE * sign({u}) * ln(1.0::DOUBLE - 2.0::DOUBLE * abs({u})))"


def hundreds(value: str) -> str:
    """Rounded to hundreds; the checking engine keeps a minus sign on zero, which is no other number."""
    return f"CASE WHEN abs({value}) < 50 THEN 0.0::DOUBLE ELSE round({value}, -2)::DOUBLE END"


def obj(index: str) -> str:
    return f"('{fx.DATABASE}.S' || (({index}) % 5) || '.T' || ({index}))"


def entity_pattern(e: Entity) -> str:
    """The same boundaries without lookaround: the character before becomes part of the match."""
    return f"(^|[^{e.before}]){e.body}" + (r"\b" if e.closed else "")


def redact(text: str, labels=None) -> str:
    for e in ENTITIES:
        if labels is None or e.label in labels:
            text = rf"regexp_replace({text}, '{entity_pattern(e)}', '\1[{e.label}]', 'g')"
    return text


def entity_count(text: str, label: str) -> str:
    e = next(e for e in ENTITIES if e.label == label)
    return f"len(regexp_extract_all({text}, '{entity_pattern(e)}'))"


def sentiment(text: str) -> str:
    def count(words):
        return rf"len(regexp_extract_all(lower({text}), '\b(?:{'|'.join(words)})\b'))"

    p, n = count(POSITIVE), count(NEGATIVE)
    return f"CASE WHEN {p} + {n} = 0 THEN 0.0::DOUBLE ELSE round(({p} - {n})::DOUBLE / ({p} + {n}), 4) END"


def label(score: str, threshold: float) -> str:
    return f"CASE WHEN {score} > {threshold} THEN 'Positive' WHEN {score} < -{threshold} THEN 'Negative' ELSE 'Neutral' END"


def topic(text: str) -> str:
    cases = " ".join(
        f"WHEN {' OR '.join(f'''lower({text}) LIKE '%{w}%' ''' for w in words)} THEN '{name}'" for name, words in TOPICS
    )
    return f"CASE {cases} ELSE '{DEFAULT_TOPIC}' END"


def _feedback(key: str) -> str:
    parts = {
        "{L}": pick(fx.SURNAMES, f"{key} % {len(fx.SURNAMES)}"),
        "{E}": f"('user.' || {key} || '@mail' || ({key} % 10) || '.example.com')",
        "{P}": f"('555-' || lpad(({key} % 1000)::VARCHAR, 3, '0') || '-' || lpad(({key} % 10000)::VARCHAR, 4, '0'))",
        "{S}": f"('9' || lpad(({key} % 100)::VARCHAR, 2, '0') || '-12-' || lpad(({key} % 10000)::VARCHAR, 4, '0'))",
        "{A}": f"(({key} % 900 + 1) || ' Maple Street, Dover NH 0' || ({key} % 9000 + 1000))",
        "{C}": f"('4000 1234 5678 ' || lpad(({key} % 10000)::VARCHAR, 4, '0'))",
        "{B}": f"(({key} % 12 + 1) || '/' || ({key} % 28 + 1) || '/' || ({key} % 50 + 1950))",
    }
    cases = []
    for i, template in enumerate(fx.FEEDBACK):
        pieces = [
            parts[p] if p in parts else f"'{p}'" for p in re.split(r"(\{[A-Z]\})", template) if p
        ]
        cases.append(f"WHEN {i} THEN {' || '.join(pieces or [chr(39) * 2])}")
    return f"CASE {key} % {len(fx.FEEDBACK)} {' '.join(cases)} END"


_ssn = "lpad(k::VARCHAR, 9, '0')"
_lead_amount = f"round(1000.0::DOUBLE + {uniform('i::VARCHAR', 'deal')} * 99000.0::DOUBLE, 2)"


def _leads(source: str) -> str:
    return f"""
    SELECT i AS lead_id, 'Lead ' || i AS lead_name,
      CASE WHEN i % 26 = 0 THEN NULL WHEN i % 41 = 0 THEN '{gen.DUPLICATE_EMAIL}' ELSE 'contact' || i || '@example.com' END AS email,
      CASE WHEN i % 29 = 0 THEN '' ELSE '555-' || lpad((i * 7 % 10000)::VARCHAR, 4, '0') END AS phone,
      {pick(gen.COMPANIES, f'i % {len(gen.COMPANIES)}')} AS company,
      CASE WHEN i % 141 = 0 THEN 'tbd' WHEN i % 141 = 47 THEN 'n/a' WHEN i % 141 = 94 THEN 'ask later'
           ELSE {pick(gen.STATUSES, 'i % 5')} END AS status,
      CASE WHEN i % 158 = 0 THEN -5000.0::DOUBLE WHEN i % 79 = 0 THEN 2500000.0::DOUBLE ELSE {_lead_amount} END AS deal_amount,
      {pick(gen.LEAD_SOURCES, f'i % {len(gen.LEAD_SOURCES)}')} AS lead_source,
      {AS_OF} - to_minutes(i % 1000000 * 15) AS created_at
    FROM ({source})"""


CTES = {
    "people": f"""
    SELECT k AS c_custkey, 'First' || k AS first_name, 'Last' || (k % 1000) AS last_name,
      (k % 900 + 100) || ' Oak Street' AS street_address, n_name AS state, 'City' || (k % 100) AS city,
      lpad((k % 90000 + 10000)::VARCHAR, 5, '0') AS zip, '555-' || lpad((k % 10000)::VARCHAR, 4, '0') AS phone,
      'cust' || k || '@example.com' AS email,
      substr({_ssn}, 1, 3) || '-' || substr({_ssn}, 4, 2) || '-' || substr({_ssn}, 6, 4) AS ssn,
      (DATE '1950-01-01' + (k % 20000)::INT)::VARCHAR AS birthdate, DATE '1950-01-01' + (k % 20000)::INT AS birth_date,
      TIMESTAMP '2020-01-01' + to_minutes(k % 1000000) AS created_at,
      {pick(fx.JOBS, 'k % 7')} AS job,
      CASE WHEN k % 2 = 0 THEN '34' || lpad(k::VARCHAR, 13, '0') ELSE '51' || lpad(k::VARCHAR, 14, '0') END AS card,
      {pick(gen.COMPANIES, f'k % {len(gen.COMPANIES)}')} AS company,
      CASE WHEN k % 10 = 9 THEN NULL WHEN k % 3 = 0 THEN 'N' ELSE 'Y' END AS optin,
      c_acctbal, c_mktsegment
    FROM (SELECT *, c_custkey AS k FROM customer) JOIN nation ON c_nationkey = n_nationkey""",
    "policy_map": """
    SELECT * FROM (VALUES ('DATA_USER', 'NATION_3'), ('DATA_USER', 'NATION_7'), ('DATA_USER', 'NATION_11')) t(role, visible_value)""",
    "masked": f"""
    SELECT c_custkey, left(first_name, 1) || repeat('*', length(first_name) - 1) AS first_name,
      left(last_name, 1) || repeat('*', length(last_name) - 1) AS last_name,
      left(street_address, 1) || repeat('*', length(street_address) - 1) AS street_address, state,
      left(city, 1) || repeat('*', length(city) - 1) AS city,
      left(zip, 1) || repeat('*', length(zip) - 1) AS zip, '***-' || right(phone, 4) AS phone,
      '***PII-REDACTED***' AS email, '***PII-REDACTED***' AS ssn, '***-' || right(birthdate, 4) AS birthdate,
      date_trunc('year', birth_date)::DATE AS birth_date, created_at, job, '***PII-REDACTED***' AS card, company, optin,
      {hundreds('c_acctbal')} AS c_acctbal, c_mktsegment
    FROM people""",
    "visible": """
    SELECT masked.* FROM masked WHERE state IN (SELECT visible_value FROM policy_map WHERE role = 'DATA_USER')""",
    "sales": f"""
    SELECT *, round(o_totalprice / 1.1::DOUBLE, 2) AS order_amount,
      round(o_totalprice - round(o_totalprice / 1.1::DOUBLE, 2), 2) AS order_tax,
      {pick(('USD', 'EUR', 'GBP'), 'o_custkey % 3')} AS order_currency FROM orders""",
    "visible_sales": "SELECT * FROM sales WHERE o_custkey IN (SELECT c_custkey FROM visible)",
    "feedback": f"SELECT o_orderkey, o_custkey, o_orderdate, {_feedback('o_orderkey')} AS feedback FROM orders",
    "leads": _leads("SELECT o_orderkey + 1 AS i FROM orders"),
    "bad_leads": f"""
    SELECT -1 - c_custkey AS lead_id, 'Broken ' || (-1 - c_custkey) AS lead_name, NULL::VARCHAR AS email, '' AS phone,
      'No Such Company' AS company, 'broken' AS status, -1.0::DOUBLE AS deal_amount, 'none' AS lead_source, {AS_OF} AS created_at
    FROM customer""",
    "employees": f"""
    SELECT c_custkey AS employee_id, {pick(gen.DEPARTMENTS, 'c_custkey % 6')} AS department,
      round(50000.0::DOUBLE + {uniform('c_custkey::VARCHAR', 'salary')} * 150000.0::DOUBLE, 2) AS salary,
      round(0.0::DOUBLE + {uniform('c_custkey::VARCHAR', 'bonus')} * 25000.0::DOUBLE, 2) AS bonus,
      (22 + floor({uniform('c_custkey::VARCHAR', 'age')} * 44.0::DOUBLE))::INT AS age,
      floor({uniform('c_custkey::VARCHAR', 'years')} * 26.0::DOUBLE)::INT AS years_at_company
    FROM customer""",
    "ev": "SELECT *, json_extract(props, '$.k')::INT AS k FROM events",
    "access": f"""
    SELECT event_id AS query_id, ts AS query_start_time, CASE WHEN event_type = 'signup' THEN 'CREATE' END AS ddl,
      CASE WHEN event_id % 3 = 0 THEN [{obj('k % 8')}, {obj('(k + 1) % 8')}] ELSE [{obj('k % 8')}] END AS direct,
      [{obj('k % 4')}] AS base, event_type, k FROM ev""",
    "lineage_edges": f"""
    SELECT * FROM (
      SELECT 'id' || (k % 8) AS source_object_id, {obj('k % 8')} AS source_object_name, 'C1' AS source_column_name, 'DIRECT' AS source_column_type,
             {obj('(k + 3) % 8')} AS target_object_name, 'C1' AS target_column_name FROM ev WHERE event_type = 'purchase'
      UNION SELECT 'id' || ((k + 1) % 8), {obj('(k + 1) % 8')}, 'C2', 'DIRECT', {obj('(k + 3) % 8')}, 'C1' FROM ev WHERE event_type = 'purchase'
      UNION SELECT CASE WHEN k % 2 = 1 THEN 'id' || (k % 4) END, CASE WHEN k % 2 = 1 THEN {obj('k % 4')} END,
             CASE WHEN k % 2 = 1 THEN 'C1' END, 'BASE', {obj('(k + 3) % 8')}, 'C1' FROM ev WHERE event_type = 'purchase'
      UNION SELECT CASE WHEN k % 3 <> 0 THEN 'id' || (k % 8) END, CASE WHEN k % 3 <> 0 THEN {obj('k % 8')} END,
             CASE WHEN k % 3 <> 0 THEN 'C2' END, 'DIRECT', {obj('(k + 3) % 8')}, 'C2' FROM ev WHERE event_type = 'purchase'
      UNION SELECT CASE WHEN k % 3 <> 0 THEN 'id' || (k % 4) END, CASE WHEN k % 3 <> 0 THEN {obj('k % 4')} END,
             CASE WHEN k % 3 <> 0 THEN 'C3' END, 'BASE', {obj('(k + 3) % 8')}, 'C2' FROM ev WHERE event_type = 'purchase')""",
    "moved_columns": f"""
    SELECT DISTINCT s AS source_object_name, sc AS source_column_name, t AS target_object_name, tc AS target_column_name FROM (
      SELECT {obj('p')} AS s, 'C2' AS sc, {obj('(p + 1)')} AS t, 'C1' AS tc FROM (SELECT l_partkey AS p FROM lineitem) WHERE p % 6 <> 5
      UNION ALL SELECT {obj('p')}, 'C1', {obj('(p + 1)')}, 'C2' FROM (SELECT l_partkey AS p FROM lineitem) WHERE p % 6 <> 5
      UNION ALL SELECT {obj('p')}, 'C3', {obj('(p + 1)')}, 'C2' FROM (SELECT l_partkey AS p FROM lineitem) WHERE p % 6 <> 5
      UNION ALL SELECT {obj('p')}, 'C1', {obj('(p - 3)')}, 'C1' FROM (SELECT l_partkey AS p FROM lineitem) WHERE p % 6 = 4)""",
    "query_history": f"""
    SELECT event_id AS query_id, 'user_' || user_id AS user_name,
      CASE WHEN event_id < 4 THEN 'R_RARE' ELSE 'R_' || (user_id % 4) END AS role_name, ts AS start_time,
      'select * from ' || {obj('k % 8')} AS query_text, CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'SUCCESS' END AS execution_status,
      round(value * 100)::BIGINT AS total_elapsed_time, round(value * 1000000)::BIGINT AS bytes_scanned FROM ev""",
    "login_history": """
    SELECT 'user_' || user_id AS user_name, ts - to_days((user_id % 3 * 20)::INT) AS event_timestamp,
      CASE WHEN event_type = 'signup' THEN 'YES' ELSE 'NO' END AS is_success
    FROM events WHERE event_type IN ('signup', 'error')""",
    "catalog_tables": f"""
    SELECT '{fx.DATABASE}' AS table_catalog, 'S' || (p_partkey % 5) AS table_schema, 'T' || p_partkey AS table_name,
      CASE WHEN p_partkey % 4 = 0 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type,
      {AS_OF} - to_days(p_size::INT * 10) AS created_at,
      CASE WHEN p_partkey % 7 <> 0 THEN {AS_OF} - to_days((p_partkey % 200)::INT) END AS classified_at FROM part""",
    "tags": f"""
    SELECT '{fx.DATABASE}' AS object_database, 'S' || (p % 5) AS object_schema, 'T' || p AS object_name,
      CASE WHEN i > 0 THEN 'C' || i END AS column_name, CASE WHEN i > 0 THEN 'COLUMN' ELSE 'TABLE' END AS domain,
      CASE WHEN i > 0 AND (p + i) % 2 = 0 THEN 'SEMANTIC_CATEGORY' ELSE 'DATA_CLASSIFICATION' END AS tag_name,
      CASE WHEN i > 0 AND (p + i) % 2 = 0 THEN {pick(fx.CATEGORIES, '(p + i) % 7')} ELSE
        {pick(('PII', 'RESTRICTED', 'SENSITIVE', 'INTERNAL', 'PUBLIC'), '(p + i) % 5')} END AS tag_value
    FROM (SELECT p_partkey AS p, unnest(generate_series(0, p_size % 4)) AS i FROM part WHERE p_partkey % 7 <> 6)""",
    "policies": f"""
    SELECT '{fx.DATABASE}' AS policy_db, CASE WHEN p_partkey % 3 = 0 THEN 'MASKING_POLICY' ELSE 'ROW_ACCESS_POLICY' END AS policy_kind,
      'POL_' || (p_partkey % 4) AS policy_name, CASE WHEN p_partkey % 11 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS policy_status,
      {obj('p_partkey')} AS ref_entity_name, 'TABLE' AS ref_entity_domain, CASE WHEN p_partkey % 3 = 0 THEN 'C1' END AS ref_column_name
    FROM part WHERE p_partkey % 3 <> 2""",
    "deps": f"""
    SELECT DISTINCT '{fx.DATABASE}.S' || (l_partkey % 5) || '.V' || l_partkey AS referencing_object, 'VIEW' AS referencing_type,
      '{fx.DATABASE}.S' || (l_suppkey % 5) || '.T' || l_suppkey AS referenced_object, 'TABLE' AS referenced_type FROM lineitem""",
    "grants": f"""
    SELECT CASE WHEN p_partkey % 8 = 0 THEN 'R_RARE' WHEN p_partkey % 8 = 1 THEN 'R_DORMANT' ELSE 'R_' || (p_partkey % 4) END AS grantee_name,
      {pick(fx.PRIVILEGES, 'p_size % 4')} AS privilege, '{fx.DATABASE}' AS table_catalog, 'S' || (p_partkey % 5) AS table_schema,
      'T' || p_partkey AS name, 'TABLE' AS granted_on, {AS_OF} - to_days((p_partkey % 60)::INT) AS created_on,
      CASE WHEN p_partkey % 10 = 7 THEN {AS_OF} END AS deleted_on FROM part""",
}

_NEEDS = {
    "masked": ("people",),
    "visible": ("people", "policy_map", "masked"),
    "visible_sales": ("people", "policy_map", "masked", "visible", "sales"),
    "access": ("ev",),
    "lineage_edges": ("ev",),
    "query_history": ("ev",),
}


def with_tables(*tables: str, sql: str) -> str:
    """Prefix ``sql`` with the scenario tables it uses."""
    ordered: list[str] = []
    for t in tables:
        for needed in (*_NEEDS.get(t, ()), t):
            if needed not in ordered:
                ordered.append(needed)
    # a query with named parts of its own continues the list
    for start in ("WITH RECURSIVE ", "WITH "):
        if sql.startswith(start):
            return start + ",\n".join(f"{t} AS ({CTES[t]})" for t in ordered) + ",\n" + sql[len(start) :]
    return "WITH " + ",\n".join(f"{t} AS ({CTES[t]})" for t in ordered) + "\n" + sql
