"""Further audit jobs the reference suggests: anomalies, drift, transfers, trends, escalations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custodia.operators.audit import since


def login_spikes(logins: DataFrame, trailing_days: int = 7, factor: float = 3.0, minimum: int = 3) -> DataFrame:
    """Days on which a user failed far more often than on the days before.

    The mean covers the trailing calendar days, days without failures included. The window runs
    over daily counts: a user has one row per day, however many events there were.
    """
    daily = (
        logins.filter(F.col("is_success") != "YES")
        .groupBy("user_name", F.to_date("event_timestamp").alias("day"))
        .agg(F.count(F.lit(1)).alias("failures"))
        .withColumn("_n", F.datediff("day", F.lit("1970-01-01").cast("date")))
    )
    window = Window.partitionBy("user_name").orderBy("_n").rangeBetween(-trailing_days, -1)
    mean = F.coalesce(F.sum("failures").over(window), F.lit(0)) / F.lit(float(trailing_days))
    return (
        daily.withColumn("trailing_mean", F.round(mean, 4))
        .filter((F.col("failures") >= minimum) & (F.col("failures") > F.col("trailing_mean") * factor))
        .select("user_name", "day", "failures", "trailing_mean")
    )


def after_hours(
    queries: DataFrame,
    access: DataFrame,
    sensitive_objects: DataFrame,
    as_of: Column,
    days: int | None = 30,
    opens: int = 7,
    closes: int = 19,
) -> DataFrame:
    """Queries on sensitive objects outside business hours, per user; both logs are cut to the window."""
    hour = F.hour("start_time")
    touched = (
        access.filter(since(F.col("query_start_time"), as_of, days))
        .select("query_id", F.explode(F.col("direct_objects_accessed.objectName")).alias("object_name"))
        .join(sensitive_objects, "object_name", "left_semi")
        .select("query_id")
    )
    return (
        queries.filter(since(F.col("start_time"), as_of, days) & ((hour < opens) | (hour >= closes)))
        .join(touched, "query_id", "left_semi")
        .groupBy("user_name")
        .agg(
            F.count(F.lit(1)).alias("queries"),
            F.min("start_time").alias("first_seen"),
            F.max("start_time").alias("last_seen"),
        )
    )


def schema_drift(before: DataFrame, after: DataFrame, key: Sequence[str] = ("table_name", "column_name")) -> DataFrame:
    """Columns added, dropped or changed in type between two snapshots."""
    old = before.select(*[F.col(k).alias(f"_o_{k}") for k in key], F.col("data_type").alias("old_type"))
    new = after.select(*key, F.col("data_type").alias("new_type"))
    condition = F.lit(True)
    for k in key:
        condition = condition & (F.col(k) == F.col(f"_o_{k}"))
    change = (
        F.when(F.col("old_type").isNull(), "ADDED")
        .when(F.col("new_type").isNull(), "DROPPED")
        .when(F.col("old_type") != F.col("new_type"), "TYPE_CHANGED")
    )
    return (
        new.join(old, condition, "full")
        .select(
            *[F.coalesce(F.col(k), F.col(f"_o_{k}")).alias(k) for k in key],
            "old_type",
            "new_type",
            change.alias("change"),
        )
        .filter(F.col("change").isNotNull())
    )


def share_transfers(transfers: DataFrame) -> DataFrame:
    """What each share sent where."""
    return transfers.groupBy("share_name", "target_region").agg(
        F.count(F.lit(1)).alias("transfers"), F.sum("bytes_transferred").alias("bytes_transferred")
    )


def cost_trend(queries: DataFrame) -> DataFrame:
    """Weekly load per role against the week before; the window sees one row per role and week."""
    weekly = queries.groupBy(
        "role_name", F.to_date(F.date_trunc("week", "start_time")).alias("week")
    ).agg(
        F.count(F.lit(1)).alias("queries"),
        F.round(F.avg("total_elapsed_time"), 2).alias("avg_elapsed"),
        F.sum("bytes_scanned").alias("bytes_scanned"),
    )
    previous = F.lag("bytes_scanned").over(Window.partitionBy("role_name").orderBy("week"))
    change = (F.col("bytes_scanned") - previous) / F.nullif(previous, F.lit(0))
    return weekly.withColumn("bytes_change", F.round(change, 4))


def new_privileged_grants(
    before: DataFrame, after: DataFrame, privileged: Sequence[str], key: Sequence[str]
) -> DataFrame:
    """Live privileged grants that the earlier snapshot did not have."""
    is_privileged = F.col("privilege").isin(list(privileged)) & F.col("deleted_on").isNull()
    return after.filter(is_privileged).join(before.filter(is_privileged), list(key), "left_anti")


def first_per_group(df: DataFrame, group: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each group. Catalyst keeps one row per group and task before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def fixed_sample(df: DataFrame, key: Column, size: int, seed: str) -> DataFrame:
    """A reproducible random sample of fixed size; each task keeps ``size`` rows at most."""
    return (
        df.withColumn("_order", F.md5(F.concat(key.cast("string"), F.lit(seed)).cast("binary")))
        .orderBy("_order")
        .limit(size)
        .drop("_order")
    )
