"""Data-quality metrics, expectations and their history."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.sources.tables import literal_rows


@dataclass(frozen=True)
class Metric:
    """A named count over a table. ``aggregate`` is None for duplicate counts, which need a shuffle.

    ``additive``: the value of a table is the sum of the values of its parts. ``test``: the value is the number of
    rows for which it is true; streams count such metrics.
    """

    name: str
    kind: str
    aggregate: Column | None
    column: str | None = None
    schedule: str = "TRIGGER_ON_CHANGES"
    additive: bool = True
    test: Column | None = None


def _counting(name: str, kind: str, test: Column, column: str | None = None) -> Metric:
    return Metric(name, kind, F.count_if(test), column, test=test)


def null_count(name: str, column: str) -> Metric:
    return _counting(name, "NULL_COUNT", F.col(column).isNull(), column)


def blank_count(name: str, column: str) -> Metric:
    """Empty or all-blank strings; NULL is not blank."""
    return _counting(name, "BLANK_COUNT", F.trim(F.col(column)) == "", column)


def row_count(name: str) -> Metric:
    return Metric(name, "ROW_COUNT", F.count(F.lit(1)), test=F.lit(True))


def accepted_values(name: str, column: str, predicate: Callable[[Column], Column]) -> Metric:
    """Values for which the predicate is false; NULLs are left to ``null_count``."""
    return _counting(name, "ACCEPTED_VALUES", ~predicate(F.col(column)), column)


def custom_metric(name: str, column: str, aggregate: Callable[[Column], Column], kind: str) -> Metric:
    """Any aggregate over one column, such as an out-of-range count."""
    return Metric(name, kind, aggregate(F.col(column)).cast("bigint"), column, additive=False)


def out_of_range(name: str, column: str, low: float, high: float, kind: str = "OUT_OF_RANGE") -> Metric:
    return _counting(name, kind, (F.col(column) < low) | (F.col(column) > high), column)


def duplicate_count(name: str, column: str) -> Metric:
    """Rows whose non-NULL value occurs more than once."""
    return Metric(name, "DUPLICATE_COUNT", None, column)


def _duplicates(df: DataFrame, metric: Metric, by: Sequence[str], along: Sequence[Metric] = ()) -> DataFrame:
    """Counted per value before the shuffle, so one very frequent value is no hot partition.

    NULLs are counted along, as no duplicates, so a group of nothing else has its row; so are additive metrics.
    """
    parts = [m.aggregate.cast("bigint").alias(m.name) for m in along]
    value = F.col(metric.column).alias("_value")
    per_value = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"), *parts)
    repeated = F.sum(F.when(F.col("_value").isNotNull() & (F.col("_n") > 1), F.col("_n")))
    total = F.coalesce(repeated, F.lit(0)).cast("bigint")
    sums = [F.coalesce(F.sum(m.name), F.lit(0)).cast("bigint").alias(m.name) for m in along]
    return per_value.groupBy(*by).agg(total.alias(metric.name), *sums)


def measure_rows(df: DataFrame, metrics: Sequence[Metric], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, metric_name, value)``. Additive metrics share the scan of the first duplicate count, if there is one;
    every further duplicate count, and a metric that does not add up, needs a scan of its own."""
    by = list(by)
    metrics = list({m.name: m for m in metrics}.values())
    repeats = [m for m in metrics if m.aggregate is None]
    along = [m for m in metrics if m.aggregate is not None and m.additive and repeats]
    scan = [m for m in metrics if m.aggregate is not None and m not in along]
    parts = []
    if scan:
        wide = df.groupBy(*by).agg(*[m.aggregate.cast("bigint").alias(m.name) for m in scan])
        parts.append((wide, scan))
    for i, m in enumerate(repeats):
        parts.append((_duplicates(df, m, by, () if i else along), [m, *(() if i else along)]))
    return reduce(
        DataFrame.unionByName, [wide.unpivot(by, [m.name for m in own], "metric_name", "value") for wide, own in parts]
    )


def measure(df: DataFrame, metrics: Sequence[Metric], by: Sequence[str] = ()) -> DataFrame:
    """The same values as one column per metric."""
    value_of = [F.max(F.when(F.col("metric_name") == m.name, F.col("value"))) for m in metrics]
    return (
        measure_rows(df, metrics, by)
        .groupBy(*by)
        .agg(*[F.coalesce(v, F.lit(0).cast("bigint")).alias(m.name) for v, m in zip(value_of, metrics)])
    )


@dataclass(frozen=True)
class Expectation:
    """A metric and the condition its value has to meet."""

    name: str
    metric: Metric
    operator: str
    threshold: int

    def __post_init__(self):
        if self.operator not in _TESTS:
            raise ValueError(f"operator {self.operator!r} is none of {sorted(_TESTS)}")

    def holds(self, value: Column) -> Column:
        return _TESTS[self.operator](value, self.threshold)


_TESTS = {
    "=": lambda v, t: v == t,
    "<>": lambda v, t: v != t,
    "<": lambda v, t: v < t,
    "<=": lambda v, t: v <= t,
    ">": lambda v, t: v > t,
    ">=": lambda v, t: v >= t,
}


def report(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Pass or fail per expectation; a metric is measured once, however many expectations name it."""
    metrics: dict[str, Metric] = {}
    for e in expectations:
        known = metrics.setdefault(e.metric.name, e.metric)
        if (known.kind, known.column) != (e.metric.kind, e.metric.column):
            raise ValueError(f"two metrics are called {e.metric.name!r}")
    rows = measure_rows(df, list(metrics.values()))
    tests = literal_rows(
        df.sparkSession,
        [(e.name, e.metric.name, e.metric.kind, e.operator, e.threshold) for e in expectations],
        "expectation string, metric_name string, metric string, operator string, threshold bigint",
    )
    verdict = F.lit(None).cast("boolean")
    for operator, test in _TESTS.items():
        verdict = F.when(F.col("operator") == operator, test(F.col("value"), F.col("threshold"))).otherwise(verdict)
    return tests.join(rows, "metric_name").select(
        "expectation", "metric", "value", F.when(verdict, "PASS").otherwise("FAIL").alias("status")
    )


HISTORY_SCHEMA = "measurement_time timestamp_ntz, table_database string, table_name string, metric_name string, value bigint"


def history_rows(measured: DataFrame, time: Column, database: str, table: str) -> DataFrame:
    """Measured rows in the layout of the history table."""
    return measured.select(
        time.cast("timestamp_ntz").alias("measurement_time"),
        F.lit(database).alias("table_database"),
        F.lit(table).alias("table_name"),
        "metric_name",
        "value",
    )


def append_history(rows: DataFrame, path: str) -> None:
    """Append to the history, partitioned by day so that trend queries read few folders."""
    rows.withColumn("day", F.to_date("measurement_time")).write.mode("append").partitionBy("day").parquet(path)


def trend(history: DataFrame, database: str, table: str) -> DataFrame:
    """One table's history, newest first."""
    return (
        history.filter((F.col("table_database") == database) & (F.col("table_name") == table))
        .select("measurement_time", "table_name", "metric_name", "value")
        .orderBy(F.desc("measurement_time"), "metric_name")
    )


def registry(measured: DataFrame, metrics: Sequence[Metric], table: str, status: str = "STARTED") -> DataFrame:
    """What is attached to a table, on which schedule, with its latest value."""
    by_name = {m.name: m for m in metrics}
    kind, schedule, column = F.lit(None), F.lit(None), F.lit(None)
    for name, m in by_name.items():
        mine = F.col("metric_name") == name
        kind = F.when(mine, m.kind).otherwise(kind)
        schedule = F.when(mine, m.schedule).otherwise(schedule)
        column = F.when(mine, F.lit(m.column)).otherwise(column)
    return measured.select(
        kind.alias("metric"),
        F.lit(table).alias("table_name"),
        column.alias("column_name"),
        schedule.alias("schedule"),
        F.lit(status).alias("schedule_status"),
        F.col("value").alias("latest_value"),
    )
