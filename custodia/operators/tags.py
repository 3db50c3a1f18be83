"""Classification tags on columns: kept in column metadata, listed as rows, inherited by derived tables.

Spark carries column metadata through select, alias, group keys, joins and parquet. It drops it for
computed columns and for INSERT into another table, and of the inputs of a set operation it keeps the first
one's. So ``inherit`` believes what the caller declares and what is a plain copy, and otherwise fails closed;
``union``, ``intersect`` and ``difference`` merge the tags of their inputs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions.masks import most_severe, severity_rank
from custodia.operators.paths import nested_paths
from custodia.sources.tables import literal_rows

METADATA_KEY = "classification"
PATHS_KEY = "classification_inside"  # path -> level of values inside a nested column
UNTAGGED = "NONE"  # a column known to need no tag, as opposed to one whose tag was lost
TAG_NAME = "DATA_CLASSIFICATION"

TAG_SCHEMA = (
    "object_database string, object_schema string, object_name string, column_name string, "
    "domain string, tag_name string, tag_value string"
)


def level_of(df: DataFrame, column: str) -> str | None:
    level = df.schema[column].metadata.get(METADATA_KEY)
    return None if level == UNTAGGED else level


def levels_inside(df: DataFrame, column: str) -> dict[str, str]:
    """Tagged paths inside a nested column."""
    return dict(df.schema[column].metadata.get(PATHS_KEY, {}))


def tags_of(df: DataFrame) -> dict[str, str]:
    """Level per tagged column, and per tagged path inside one."""
    tags = {c: level for c in df.columns if (level := level_of(df, c))}
    for c in df.columns:
        tags |= levels_inside(df, c)
    return tags


def _severest(df: DataFrame, column: str) -> str | None:
    """The most severe of a column's own level and those inside it."""
    return most_severe([level_of(df, column), *levels_inside(df, column).values()])


def _labelled(column: Column, name: str, field_metadata: Mapping, level: str | None) -> Column:
    return column.alias(name, metadata={**field_metadata, METADATA_KEY: level or UNTAGGED})


def apply_tags(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Mark every column: with its level, or as known to be untagged. A tag may be on a path inside a nested column."""
    inside = nested_paths(df.schema) if set(tags) - set(df.columns) else {}
    missing = set(tags) - set(df.columns) - set(inside)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    fields = []
    for f in df.schema.fields:
        metadata = {k: v for k, v in f.metadata.items() if k != PATHS_KEY}
        own = {p: tags[p] for p, leaf in inside.items() if leaf.column == f.name and p in tags and p not in df.columns}
        fields.append(_labelled(F.col(f.name), f.name, {**metadata, PATHS_KEY: own} if own else metadata, tags.get(f.name)))
    return df.select(*fields)


def _merged(result: DataFrame, frames: list[DataFrame]) -> DataFrame:
    """Columns of ``result`` with the most severe tag that stands at their place in any of the frames.

    In a frame with tags, a column without a mark counts as the most severe of the frame's tags.
    """
    fields = []
    for i, field in enumerate(result.schema.fields):
        levels = []
        for frame in frames:
            metadata = frame.schema.fields[i].metadata
            inside = metadata.get(PATHS_KEY, {})
            mark = metadata.get(METADATA_KEY)
            levels += [mark, *inside.values()] if mark else [most_severe(tags_of(frame).values())]
        same = METADATA_KEY in field.metadata and all(f.schema.fields[i].metadata == field.metadata for f in frames)
        level = field.metadata.get(METADATA_KEY) if same else most_severe(levels)
        metadata = field.metadata if same else {k: v for k, v in field.metadata.items() if k != PATHS_KEY}
        fields.append(_labelled(F.col(f"`{field.name.replace('`', '``')}`"), field.name, metadata, level))
    return result.select(*fields)


def _same_width(frames: tuple[DataFrame, ...]) -> list[DataFrame]:
    if len({len(f.columns) for f in frames}) > 1:
        raise ValueError("set operations take frames of equally many columns")
    return list(frames)


def union(*frames: DataFrame, by_name: bool = False) -> DataFrame:
    """All rows of all frames; columns go by their place, or by name, and take the most severe tag of their inputs."""
    inputs = _same_width(frames)
    if by_name:
        inputs = [inputs[0], *(f.select(*[f[f"`{c.replace('`', '``')}`"] for c in inputs[0].columns]) for f in inputs[1:])]
    return _merged(reduce(DataFrame.unionAll, inputs), inputs)


def intersect(left: DataFrame, right: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """Rows that both hold."""
    inputs = _same_width((left, right))
    return _merged(left.intersectAll(right) if keep_duplicates else left.intersect(right), inputs)


def difference(left: DataFrame, right: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """Rows of ``left`` that ``right`` does not hold. They tell what is absent there, so its tags count as well."""
    inputs = _same_width((left, right))
    return _merged(left.exceptAll(right) if keep_duplicates else left.subtract(right), inputs)


def _plain_copy(derived: DataFrame, sources: Iterable[DataFrame]) -> bool:
    """Is it one of the sources, or a choice of its columns?"""
    for source in sources:
        if set(derived.columns) <= set(source.columns):
            chosen = source.select(*[F.col(f"`{c.replace('`', '``')}`") for c in derived.columns])
            if derived.sameSemantics(source) or derived.sameSemantics(chosen):
                return True
    return False


def inherit(
    derived: DataFrame,
    sources: Iterable[DataFrame],
    lineage: Mapping[str, Iterable[str]] | None = None,
    kept: Iterable[str] = (),
) -> dict[str, str]:
    """Tags of a table computed from tagged ``sources``.

    Per output column: the most severe of the source columns declared for it in ``lineage`` (an empty list
    declares a count-like column that needs no tag); or, for columns named in ``kept`` (passed through unchanged:
    selected, grouped by, joined on) and for plain copies of a source, of the metadata it carries and the tags of
    source columns of its name. Any other column has an unknown origin and gets the most severe tag found in any
    source: a name proves nothing, and metadata neither, as Spark keeps that of the first input of a set operation.
    """
    lineage = lineage or {}
    kept = set(kept)
    unknown = kept - set(derived.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    sources = list(sources)
    copied = _plain_copy(derived, sources)
    source_tags: dict[str, list[tuple[str | None, str | None]]] = {}  # own level, and with those inside
    for source in sources:
        for c in source.columns:
            source_tags.setdefault(c.lower(), []).append((level_of(source, c), _severest(source, c)))
    worst = most_severe(level for levels in source_tags.values() for _, level in levels)

    result: dict[str, str] = {}
    for field in derived.schema.fields:
        name = field.name
        if name in lineage:
            unknown = [c for c in lineage[name] if c.lower() not in source_tags]
            if unknown:
                raise ValueError(f"{name}: no source column {unknown}")
            level = most_severe(x for c in lineage[name] for _, x in source_tags[c.lower()])
        elif METADATA_KEY in field.metadata and (copied or name in kept):
            level = most_severe([field.metadata.get(METADATA_KEY), *(x for x, _ in source_tags.get(name.lower(), []))])
            result |= levels_inside(derived, name)
        else:
            level = worst
        if level:
            result[name] = level
    return result


def tag_rows(
    spark: SparkSession, database: str, schema: str, name: str, tags: Mapping[str, str]
) -> DataFrame:
    """One ``tag_references`` row per tagged column of one table."""
    rows = [(database, schema, name, c, "COLUMN", TAG_NAME, level) for c, level in sorted(tags.items())]
    return literal_rows(spark, rows, TAG_SCHEMA)


def list_column_tags(tag_references: DataFrame) -> DataFrame:
    """Column tags by severity, then table and column."""
    return (
        tag_references.filter((F.col("tag_name") == TAG_NAME) & (F.col("domain") == "COLUMN"))
        .select(
            "object_schema",
            "object_name",
            "column_name",
            F.col("tag_value").alias("classification_level"),
            severity_rank(F.col("tag_value")).alias("severity"),
        )
        .orderBy("severity", "object_schema", "object_name", "column_name")
    )


def lookup_tag(tag_references: DataFrame, tag_name: str, object_name: str, column_name: str) -> DataFrame:
    """The value of one tag on one column."""
    return tag_references.filter(
        (F.col("tag_name") == tag_name)
        & (F.col("object_name") == object_name)
        & (F.col("column_name") == column_name)
    ).select("tag_value")
