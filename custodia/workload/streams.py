"""Streaming runs over the given tables: processed to the end, results read back from the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from custodia.functions.text import redact
from custodia.operators import quality as dq
from custodia.operators.governance import DATA_USER, masked_columns
from custodia.operators.tags import apply_tags
from custodia.session import fresh_path
from custodia.sources.tables import read_table
from custodia.streaming.governed_stream import (
    DuplicateCounts,
    measured_batches,
    read_stream,
    run_available,
    run_measured,
    windowed_quality,
)
from custodia.workload import duck
from custodia.workload.registry import query


def _stream(spark: SparkSession, base: str, table: str) -> DataFrame:
    schema = read_table(spark, base, table).schema
    # a pattern, because a table may be one file or a folder of files
    return read_stream(spark, f"{base.rstrip('/')}/{table}.parquet*", schema)


def _finish(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    sink = fresh_path(spark, f"{label}-sink")
    run_available(stream, sink, fresh_path(spark, f"{label}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(sink)


@query(
    f"""SELECT c_custkey, left(c_name, 1) || repeat('*', length(c_name) - 1) AS c_name, {duck.hundreds('c_acctbal')} AS c_acctbal, c_mktsegment
    FROM customer WHERE c_nationkey IN (3, 7, 11)"""
)
def stream_masked(spark: SparkSession, base: str) -> DataFrame:
    """Row filter and masks on a stream of customers."""
    customers = _stream(spark, base, "customer").filter(F.col("c_nationkey").isin(3, 7, 11))
    tagged = apply_tags(
        customers.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"),
        {"c_name": "SENSITIVE", "c_acctbal": "RESTRICTED"},
    )
    return _finish(spark, masked_columns(tagged, DATA_USER), "masked")


@query(f"SELECT conv_id, turn, {duck.redact('text')} AS redacted FROM conversations")
def stream_redacted(spark: SparkSession, base: str) -> DataFrame:
    turns = _stream(spark, base, "conversations")
    return _finish(spark, turns.select("conv_id", "turn", redact(F.col("text")).alias("redacted")), "redacted")


@query(
    """SELECT count(*) AS rows, count(*) FILTER (user_id IS NULL) AS null_users, count(*) FILTER (value < 0 OR value > 100) AS large,
    count(*) AS stored FROM events"""
)
def stream_quality_observed(spark: SparkSession, base: str) -> DataFrame:
    """What the micro-batches measured, added up, beside the rows they wrote."""
    metrics = [dq.row_count("rows"), dq.null_count("null_users", "user_id"), dq.out_of_range("large", "value", 0, 100)]
    events = _stream(spark, base, "events").select("event_id", "user_id", "value")
    sink, history = fresh_path(spark, "observed-sink"), fresh_path(spark, "observed-history")
    run_measured(events, metrics, sink, history, fresh_path(spark, "observed-checkpoint"))
    names = [m.name for m in metrics]
    rows = spark.read.schema(events.schema).parquet(sink)
    stored = rows.agg(F.count(F.lit(1)).alias("stored")).select(*[F.lit(0).cast("bigint").alias(n) for n in names], "stored")
    batches = measured_batches(spark, history).select(*names, F.lit(0).cast("bigint").alias("stored"))
    return batches.unionByName(stored).agg(*[F.sum(n).alias(n) for n in [*names, "stored"]])


@query(
    """WITH arrived AS (SELECT 1 AS step, user_id FROM events UNION ALL SELECT 2, user_id FROM events UNION ALL SELECT 2, event_id + 1000000000 FROM events
      UNION ALL SELECT 3, event_id + 1000000000 FROM events),
    seen AS (SELECT s.step AS up_to, user_id, count(*) AS n FROM arrived JOIN (SELECT unnest([1, 2, 3]) AS step) s ON arrived.step <= s.step GROUP BY ALL)
    SELECT up_to AS after_batch, coalesce(sum(n) FILTER (user_id IS NOT NULL AND n > 1), 0)::BIGINT AS duplicates FROM seen GROUP BY up_to"""
)
def stream_duplicates(spark: SparkSession, base: str) -> DataFrame:
    """Duplicate users after each of three micro-batches, whose values repeat those of earlier batches."""
    events = read_table(spark, base, "events")
    users = events.select(F.col("user_id").cast("bigint").alias("user_id"))
    fresh = events.select((F.col("event_id") + 1_000_000_000).alias("user_id"))
    arrivals = fresh_path(spark, "arriving-users")
    tracker = DuplicateCounts(spark, fresh_path(spark, "duplicate-users"), "user_id")
    for rows in (users, users.unionAll(fresh), fresh):
        rows.write.mode("append").parquet(arrivals)
        tracker.arrive(read_stream(spark, arrivals, users.schema))
        tracker.merge()
    number = F.row_number().over(Window.orderBy("batch")).cast("bigint")
    return tracker.history().select(number.alias("after_batch"), "duplicates")


@query(
    """SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, count(*) AS rows, count(*) FILTER (value < 0 OR value > 100) AS large
    FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY 1"""
)
def stream_dq_history(spark: SparkSession, base: str) -> DataFrame:
    """Daily windows the watermark has closed; the newest stay open."""
    metrics = [dq.row_count("rows"), dq.out_of_range("large", "value", 0, 100)]
    windows = windowed_quality(_stream(spark, base, "events"), "ts", metrics, "1 day", "1 hour")
    return _finish(spark, windows, "windows")
