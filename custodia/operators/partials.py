"""Aggregates in two steps, so that rows can be summed up per join key before a join.

The first step shrinks the many side to one row per key and task, whatever the share of a single key;
the join then has no hot key, and the final step adds up what the join brings together.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FIRST = {
    "count": lambda x: [F.count(x)],
    "sum": lambda x: [F.sum(x)],
    "min": lambda x: [F.min(x)],
    "max": lambda x: [F.max(x)],
    "avg": lambda x: [F.sum(x), F.count(x)],
    # distinct days, of dates less than 32,768 days apart: one bit each
    "days": lambda x: [F.bitmap_construct_agg(F.pmod(F.unix_date(x), F.lit(32768)).cast("bigint"))],
    # distinct values, of which a group has few
    "set": lambda x: [F.collect_set(x)],
}
_SECOND = {
    "count": lambda p: F.coalesce(F.sum(p[0]), F.lit(0)),
    "sum": lambda p: F.sum(p[0]),
    "min": lambda p: F.min(p[0]),
    "max": lambda p: F.max(p[0]),
    "avg": lambda p: F.sum(p[0]) / F.nullif(F.sum(p[1]), F.lit(0)),
    "days": lambda p: F.bitmap_count(F.bitmap_or_agg(p[0])),
    "set": lambda p: F.array_sort(F.array_distinct(F.flatten(F.collect_list(p[0])))),
}


_MERGE = {
    "count": (F.sum,),
    "sum": (F.sum,),
    "min": (F.min,),
    "max": (F.max,),
    "avg": (F.sum, F.sum),
    "days": (F.bitmap_or_agg,),
    "set": (lambda c: F.array_distinct(F.flatten(F.collect_list(c))),),
}


def splits(function: str) -> bool:
    return function in _FIRST


def first_step(function: str, argument: Column, name: str) -> list[Column]:
    """Partial results of one aggregate, to be computed per join key."""
    return [c.alias(f"_{name}_{i}") for i, c in enumerate(_FIRST[function](argument))]


def merge_step(function: str, name: str) -> list[Column]:
    """Partial results of several groups as those of their union, under the same names."""
    return [merge(f"_{name}_{i}").alias(f"_{name}_{i}") for i, merge in enumerate(_MERGE[function])]


def second_step(function: str, name: str) -> Column:
    """The aggregate from its partial results."""
    return _SECOND[function]([F.col(f"_{name}_{i}") for i in range(2)])
