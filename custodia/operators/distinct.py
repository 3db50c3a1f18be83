"""Exact distinct counts per group; for dense ids as bitmaps, so (group, id) pairs are not shuffled.

A column whose schema says that its numbers are dense (a running number such as a log's query id; ``mark_dense``) is counted
in two levels: ids fall into buckets of 32,768, every task makes one bitmap of 4 KB per group and bucket it meets, bitmaps
of the same bucket are or-ed, and their bits are added up per group. Other columns, and other types, are counted through
distinct pairs. The schema decides, not the size of the data.

A very frequent group is at most one row per bucket and task before its buckets are added.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custodia.operators.partials import first_step, second_step

DENSE_KEY = "dense_ids"


def mark_dense(df: DataFrame, *columns: str) -> DataFrame:
    """Say of integer columns that their values are dense. Spark carries the mark like every column metadata."""
    for c in columns:
        if not isinstance(df.schema[c].dataType, T.IntegralType):
            raise ValueError(f"{c} is no integer column")
    return df.select(
        *[
            F.col(f.name).alias(f.name, metadata={**f.metadata, DENSE_KEY: True}) if f.name in columns else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def is_dense(df: DataFrame, column: str) -> bool:
    field = df.schema[column]
    return isinstance(field.dataType, T.IntegralType) and bool(field.metadata.get(DENSE_KEY))


def _keyed(by: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(c).alias(f"{prefix}{c}") for c in by]


def _by_bitmaps(df: DataFrame, by: Sequence[str], name: str, column: str, along: Mapping[str, tuple[str, Column]]) -> DataFrame:
    number = F.col(column).cast("bigint")
    partial = [p for alias, (function, argument) in along.items() for p in first_step(function, argument, alias)]
    buckets = df.groupBy(*by, F.bitmap_bucket_number(number).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits"), *partial
    )
    held = F.when(F.col("_bucket").isNotNull(), F.bitmap_count("_bits"))
    return buckets.groupBy(*by).agg(
        F.coalesce(F.sum(held), F.lit(0)).alias(name),
        *[second_step(function, alias).alias(alias) for alias, (function, _) in along.items()],
    )


def _by_pairs(df: DataFrame, by: Sequence[str], name: str, column: Column, along: Mapping[str, tuple[str, Column]]) -> DataFrame:
    partial = [p for alias, (function, argument) in along.items() for p in first_step(function, argument, alias)]
    pairs = df.groupBy(*by, column.alias("_value")).agg(F.count(F.lit(1)).alias("_rows"), *partial)
    return pairs.groupBy(*by).agg(
        F.count("_value").alias(name),
        *[second_step(function, alias).alias(alias) for alias, (function, _) in along.items()],
    )


def distinct_counts(
    df: DataFrame,
    by: Sequence[str],
    counts: Mapping[str, str | Column],
    along: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """One row per group: ``counts`` names distinct counts of columns, ``along`` other aggregates (function, argument).

    ``along`` shares the scan of the first count; every further one reads the rows again and meets the others per
    group. NULL is not counted; a NULL group is a group.
    """
    by, along = list(by), dict(along or {})
    parts = []
    for name, column in counts.items():
        if isinstance(column, str) and is_dense(df, column):
            parts.append(_by_bitmaps(df, by, name, column, along))
        else:
            parts.append(_by_pairs(df, by, name, F.col(column) if isinstance(column, str) else column, along))
        along = {}

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        name = right.columns[-1]
        right = right.select(*_keyed(by, "_other_"), name)
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_other_{c}")) for c in by])
        return left.join(right, same).drop(*[f"_other_{c}" for c in by])

    return reduce(met, parts)
