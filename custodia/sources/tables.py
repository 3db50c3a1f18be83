"""Reading the base tables and declared-schema CSV files."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Bulk load with a declared schema and one header line per file; a malformed line is an error."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few rows given in code. Unlike rows from an RDD they have a known size, so joins can broadcast them."""
    fields = T.StructType.fromDDL(schema).fields
    columns = {f.name: pa.array([row[i] for row in rows]) for i, f in enumerate(fields)}
    df = spark.createDataFrame(pa.table(columns))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
