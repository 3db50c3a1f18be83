import pytest
from pyspark.sql import functions as F

from custodia.functions.text import redact
from custodia.operators import quality as dq
from custodia.operators.governance import DATA_USER, masked_columns
from custodia.operators.tags import apply_tags
from custodia.session import fresh_path
from custodia.streaming.governed_stream import (
    DuplicateCounts,
    measured_batches,
    read_stream,
    run_available,
    run_measured,
    windowed_quality,
)


def _metrics():
    return [dq.row_count("rows"), dq.null_count("nulls", "email"), dq.duplicate_count("dups", "email")]


@pytest.fixture()
def arrivals(spark):
    """A folder to which batches are appended, and its schema."""
    path = fresh_path(spark, "arrivals")

    def arrive(rows):
        spark.createDataFrame(rows, "id int, email string").coalesce(1).write.mode("append").parquet(path)

    arrive([(1, "a@x.org"), (2, None)])
    return path, spark.read.parquet(path).schema, arrive


def _measured(spark, path, schema, paths, **more):
    run_measured(read_stream(spark, path, schema, **more), _metrics(), *paths)
    sink, history, _ = paths
    return [(r["rows"], r["nulls"]) for r in measured_batches(spark, history).orderBy("batch").collect()]


@pytest.fixture()
def paths(spark):
    return fresh_path(spark, "sink"), fresh_path(spark, "history"), fresh_path(spark, "checkpoint")


def test_measurements_follow_arrivals(spark, arrivals, paths):
    path, schema, arrive = arrivals
    assert _measured(spark, path, schema, paths) == [(2, 1)]
    arrive([(3, None), (4, None), (5, "b@x.org")])
    assert _measured(spark, path, schema, paths) == [(2, 1), (3, 2)]  # a change triggers a measurement of what is new
    assert _measured(spark, path, schema, paths) == [(2, 1), (3, 2)]  # nothing new
    assert spark.read.parquet(paths[0]).count() == 5  # each row once over all runs


def test_more_batches_than_spark_remembers(spark, paths):
    """Every one of 120 batches is measured and stored."""
    source = fresh_path(spark, "files")
    spark.range(1200).selectExpr("CAST(id AS INT) AS id", "CAST(id AS STRING) AS email").repartition(120).write.parquet(source)
    files = spark.read.parquet(source).inputFiles()
    got = _measured(spark, source, spark.read.parquet(source).schema, paths, files_per_trigger=1)
    assert len(got) == len(files) > 100 and sum(n for n, _ in got) == 1200
    assert spark.read.parquet(paths[0]).count() == 1200


def test_measuring_opens_no_callback(spark, arrivals, paths):
    path, schema, _ = arrivals
    gateway = spark.sparkContext._gateway
    before = getattr(gateway, "_callback_server", None)
    _measured(spark, path, schema, paths)
    assert getattr(gateway, "_callback_server", None) is before
    with pytest.raises(ValueError):
        ratio = dq.custom_metric("avg", "id", F.avg, "AVG")
        run_measured(read_stream(spark, path, schema), [ratio], *paths)


def test_lost_counts_are_measured_again(spark, arrivals, paths):
    """Rows are there but their counts are not, as after a crash between the two: the next run adds them once."""
    path, schema, _ = arrivals
    run_available(read_stream(spark, path, schema), paths[0], f"{paths[2]}/rows")
    assert _measured(spark, path, schema, paths) == [(2, 1)]
    assert spark.read.parquet(paths[0]).count() == 2


def _brute_duplicates(batches):
    from collections import Counter

    seen, out = Counter(), []
    for batch in batches:
        seen.update(x for x in batch if x is not None)
        out.append(sum(n for n in seen.values() if n > 1))
    return out


@pytest.mark.parametrize("max_runs", [2, 3, 100])
def test_duplicates_over_batches(spark, max_runs):
    import random

    pick = random.Random(max_runs)
    path = fresh_path(spark, "values")
    tracker = DuplicateCounts(spark, fresh_path(spark, "duplicates"), "v", max_runs)
    batches = []
    for size in (1, 30, 1, 0, 50):
        batch = [pick.choice([None, "hot", "hot", *map(str, range(25))]) for _ in range(size)] or [None]
        batches.append(batch)
        spark.createDataFrame([(x,) for x in batch], "v string").coalesce(2).write.mode("append").parquet(path)
        tracker.arrive(read_stream(spark, path, spark.read.parquet(path).schema))
        if size != 1:  # two batches at one merge
            tracker.merge()
            tracker.merge()  # a rerun changes nothing
        tracker.arrive(read_stream(spark, path, spark.read.parquet(path).schema))
    got = [r["duplicates"] for r in tracker.history().orderBy("batch").collect()]
    assert got == _brute_duplicates(batches)
    assert len(tracker._current()[1]["runs"]) <= max_runs


def test_a_merge_that_dies_changes_nothing(spark, monkeypatch):
    path = fresh_path(spark, "values")
    spark.createDataFrame([("a",), ("a",), ("b",)], "v string").write.parquet(path)
    tracker = DuplicateCounts(spark, fresh_path(spark, "duplicates"), "v")
    tracker.arrive(read_stream(spark, path, spark.read.parquet(path).schema))
    with monkeypatch.context() as broken:
        broken.setattr(tracker._state, "put", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tracker.merge()
    assert tracker.history().count() == 0
    tracker.merge()
    assert [r["duplicates"] for r in tracker.history().collect()] == [2]


def test_masks_and_redaction_on_a_stream(spark, arrivals):
    path, schema, _ = arrivals
    sink = fresh_path(spark, "sink")
    stream = apply_tags(read_stream(spark, path, schema).withColumn("note", F.concat(F.lit("mail "), "email")), {"email": "PII"})
    out = masked_columns(stream, DATA_USER).withColumn("note", redact(F.col("note")))
    assert out.isStreaming
    run_available(out, sink, fresh_path(spark, "checkpoint"))
    rows = spark.read.parquet(sink).orderBy("id").collect()
    assert [(r["email"], r["note"]) for r in rows] == [("***PII-REDACTED***", "mail [EMAIL]"), ("***PII-REDACTED***", None)]


def test_windows_close_with_the_watermark(spark, base):
    events = spark.read.parquet(f"{base}/events.parquet")
    stream = read_stream(spark, f"{base}/events.parquet*", events.schema)
    sink = fresh_path(spark, "sink")
    windows = windowed_quality(stream, "ts", [dq.row_count("rows"), dq.duplicate_count("d", "user_id")], "1 day", "0 seconds")
    run_available(windows, sink, fresh_path(spark, "checkpoint"))
    got = {(r["window_start"], r["rows"]) for r in spark.read.parquet(sink).collect()}
    last = events.agg(F.max("ts")).first()[0].date()
    batch = events.groupBy(F.date_trunc("day", "ts").alias("d")).count().collect()
    assert got == {(r["d"], r["count"]) for r in batch if r["d"].date() < last}
