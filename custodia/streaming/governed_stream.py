"""Governance and quality on streams. Row filters, masks and redaction are stateless and work as they are."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from custodia.operators.quality import Metric
from custodia.sources.claims import Claims
from custodia.sources.snapshots import write_snapshot


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files as they arrive. ``path`` is a folder, or a pattern for files and folders."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def run_available(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived since the last run, then stop; the checkpoint makes a rerun exactly-once."""
    started = (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return started


_BATCH = "batch"


def _counted(rows: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Per task and batch, for how many rows each test holds. Nothing is kept between batches."""
    names = list(tests)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch]).group_by(_BATCH).aggregate([(n, "sum") for n in names])
            columns = [table.column(_BATCH), *(table.column(f"{n}_sum").cast(pa.int64()) for n in names)]
            yield from pa.Table.from_arrays(columns, [_BATCH, *names]).to_batches()

    flags = [F.coalesce(test, F.lit(False)).cast("int").alias(name) for name, test in tests.items()]
    schema = ", ".join([f"{_BATCH} timestamp", *[f"`{n}` bigint" for n in names]])
    return rows.select(F.current_timestamp().alias(_BATCH), *flags).mapInArrow(count, schema)


def run_measured(
    stream: DataFrame, metrics: Sequence[Metric], sink: str, history: str, checkpoint: str
) -> StreamingQuery:
    """Write what has arrived, and measure every micro-batch.

    Two plain file sinks over the same source, each exactly-once by its checkpoint: the rows, and their counts. Counts are
    taken where rows are read: per task, as a few numbers under the time of the micro-batch, which is part of the
    checkpoint, so a batch that is run again counts the same. There is no state, no watermark and no callback.
    Duplicate counts need what earlier batches held; see ``DuplicateCounts``.
    """
    tests = {m.name: m.test for m in metrics if m.aggregate is not None}
    uncounted = sorted(name for name, test in tests.items() if test is None)
    if uncounted:
        raise ValueError(f"{uncounted} are no counts of rows; measure them as a batch job")
    run_available(_counted(stream, tests), history, f"{checkpoint.rstrip('/')}/counts")
    return run_available(stream, sink, f"{checkpoint.rstrip('/')}/rows")


def measured_batches(spark: SparkSession, history: str) -> DataFrame:
    """One row per micro-batch: its time and the measured values."""
    counts = spark.read.parquet(history)
    return counts.groupBy(_BATCH).agg(*[F.sum(f"`{c}`").alias(c) for c in counts.columns if c != _BATCH])


class DuplicateCounts:
    """Rows whose value occurs more than once, after every micro-batch of a stream, without reading old rows again.

    A stream appends partial counts per value and batch to a plain file sink. ``merge`` takes the batches that are not
    merged yet and derives what each of them changed: a value that was there ``before`` times and comes ``n`` times more
    adds ``n`` duplicates; if it was there once, one more; if it stays alone, none. The new counts become a run beside
    the earlier ones; after ``max_runs`` of them all runs are put together. Runs and history are named by one numbered
    record that is written last and once: a merge that dies, or meets another one, leaves nothing behind.

    Values are counted per task before they move; a value in a third of all rows is one row per task and batch, and one
    row per run. NULL is no duplicate.
    """

    def __init__(self, spark: SparkSession, path: str, column: str, max_runs: int = 8):
        self._spark, self._path, self._column, self._max_runs = spark, path.rstrip("/"), column, max_runs
        self._state = Claims(spark, f"{self._path}/state")

    def arrive(self, stream: DataFrame) -> None:
        """Append the partial counts of what has arrived."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                table = pa.Table.from_batches([batch]).group_by([_BATCH, "value"]).aggregate([([], "count_all")])
                columns = [table.column(_BATCH), table.column("value"), table.column("count_all")]
                yield from pa.Table.from_arrays(columns, [_BATCH, "value", "n"]).to_batches()

        values = stream.select(F.current_timestamp().alias(_BATCH), F.col(self._column).alias("value"))
        schema = T.StructType().add(_BATCH, T.TimestampType()).add(values.schema["value"]).add("n", T.LongType())
        run_available(values.mapInArrow(count, schema), f"{self._path}/partial", f"{self._path}/checkpoint")

    def _current(self) -> tuple[int, dict]:
        numbers = self._state.numbers()
        return (numbers[-1], self._state.read(numbers[-1])) if numbers else (0, {"runs": [], "history": []})

    def _read(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).parquet(*[f"{self._path}/{f}" for f in folders])

    def _written(self, df: DataFrame, label: str) -> str:
        folder = f"{label}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{self._path}/{folder}")
        return folder

    def merge(self) -> None:
        """Bring runs and history up to all batches that have arrived. Run again, it changes nothing."""
        number, state = self._current()
        partial = self._spark.read.parquet(f"{self._path}/partial")
        counts_of = T.StructType().add(partial.schema["value"]).add("n", T.LongType())
        history = self._read(state["history"], _ADDED)
        new = partial.join(history.select(_BATCH), _BATCH, "left_anti").groupBy("value", _BATCH).agg(F.sum("n").alias("n"))
        new = write_snapshot(new, "arrived-counts")
        if new.isEmpty():
            return
        runs = self._read(state["runs"], counts_of)
        known = runs.join(new.select("value"), "value", "left_semi").withColumn(_BATCH, F.lit(None).cast("timestamp"))
        earlier = Window.partitionBy("value").orderBy(F.asc_nulls_first(_BATCH)).rowsBetween(Window.unboundedPreceding, -1)
        known = known.groupBy("value", _BATCH).agg(F.sum("n").alias("n"))
        before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
        together = F.col("before") + F.col("n")
        added = F.when(F.col("value").isNull() | (together < 2), 0).when(F.col("before") == 1, together).otherwise(F.col("n"))
        changed = known.unionByName(new).withColumn("before", before).filter(F.col(_BATCH).isNotNull())
        deltas = changed.groupBy(_BATCH).agg(F.sum(added).cast("bigint").alias("added"))
        run = new.filter(F.col("value").isNotNull()).groupBy("value").agg(F.sum("n").alias("n"))
        if len(state["runs"]) + 1 >= self._max_runs:
            run = runs.unionByName(run).groupBy("value").agg(F.sum("n").alias("n"))
            state = {"runs": [], "history": []}
            deltas = history.unionByName(deltas)
        record = {
            "runs": [*state["runs"], self._written(run, "run")],
            "history": [*state["history"], self._written(deltas, "history")],
        }
        self._state.put(number + 1, record)  # if another merge was first, its record counts

    def history(self) -> DataFrame:
        """(batch, duplicates) after every merged micro-batch."""
        added = self._read(self._current()[1]["history"], _ADDED)
        so_far = Window.orderBy(_BATCH).rowsBetween(Window.unboundedPreceding, 0)  # one row per batch
        return added.select(_BATCH, F.sum("added").over(so_far).alias("duplicates"))


_ADDED = T.StructType().add(_BATCH, T.TimestampType()).add("added", T.LongType())


def windowed_quality(
    stream: DataFrame, time_column: str, metrics: Sequence[Metric], width: str, delay: str
) -> DataFrame:
    """Quality per event-time window; a window is published once the watermark has passed its end."""
    scan = [m for m in metrics if m.aggregate is not None]
    timed = stream.withColumn("_time", F.col(time_column).cast("timestamp")).withWatermark("_time", delay)
    return (
        timed.groupBy(F.window("_time", width).alias("w"))
        .agg(*[m.aggregate.cast("bigint").alias(m.name) for m in scan])
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *[m.name for m in scan])
    )
