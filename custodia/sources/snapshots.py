"""Table changes on parquet: every change writes a new version, nothing is edited in place."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custodia.functions.masks import most_severe
from custodia.operators.tags import METADATA_KEY, UNTAGGED, inherit, level_of
from custodia.session import fresh_path
from custodia.sources.claims import Versions


def write_snapshot(df: DataFrame, label: str) -> DataFrame:
    """Create-table-as-select: write to a new path and return the stored table."""
    path = fresh_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Create-or-replace at a known place, also from what lies there. A write that fails leaves the old table."""
    folder = Versions(df.sparkSession, path).replace(df)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of what ``replace_snapshot`` wrote."""
    folder = Versions(spark, path).current()
    if folder is None:
        raise ValueError(f"no table at {path}")
    return spark.read.parquet(folder)


def create_if_absent(df: DataFrame, path: str) -> DataFrame:
    """Create-if-not-exists: an existing table at ``path`` wins and is returned unchanged."""
    return df.sparkSession.read.parquet(Versions(df.sparkSession, path).create(df))


def insert_rows(
    table: DataFrame,
    rows: DataFrame,
    sources: Iterable[DataFrame] = (),
    lineage: Mapping[str, Iterable[str]] | None = None,
    kept: Iterable[str] = (),
) -> DataFrame:
    """Insert with a column list: columns matched by name, missing ones NULL, types of the table.

    Every column takes the more severe tag of target and rows. With ``sources``, the tables the rows are computed
    from, theirs are settled as for a derived table; without, by the marks that the rows carry, and a column
    without a mark counts as the most severe of the rows' other columns.
    """
    unknown = set(rows.columns) - set(table.columns)
    if unknown:
        raise ValueError(f"no such columns in the target: {sorted(unknown)}")
    aligned = rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
        ]
    )
    sources = list(sources)
    if sources:
        marked = {**dict.fromkeys(rows.columns), **inherit(rows, sources, lineage, kept)}
    else:
        marked = {c: level_of(rows, c) for c in rows.columns if METADATA_KEY in rows.schema[c].metadata}
    if not any(marked.values()):
        return table.unionByName(aligned)
    worst = most_severe(marked.values())
    fields = []
    for f in table.schema.fields:
        incoming = marked.get(f.name, worst) if f.name in rows.columns else None
        level = most_severe([level_of(table, f.name), incoming])
        fields.append(F.col(f.name).alias(f.name, metadata={**f.metadata, METADATA_KEY: level or UNTAGGED}))
    return table.select(*fields).unionByName(aligned.select(*fields))


def update_where(table: DataFrame, assignments: Mapping[str, Column], predicate: Column) -> DataFrame:
    """Conditional update; a NULL predicate leaves the row as it is."""
    return table.select(
        *[
            F.when(predicate, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
            for c in table.columns
        ]
    )


def delete_where(table: DataFrame, predicate: Column) -> DataFrame:
    """Delete; rows whose predicate is NULL stay."""
    return table.filter(~F.coalesce(predicate, F.lit(False)))


def add_column_if_absent(table: DataFrame, name: str, dtype: T.DataType) -> DataFrame:
    if name.lower() in (c.lower() for c in table.columns):
        return table
    return table.withColumn(name, F.lit(None).cast(dtype))
