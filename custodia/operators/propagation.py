"""Classification levels carried along logged data movement: the most severe level that can reach a column.

Edges say which column was written from which (``audit.column_lineage``). Levels start at the columns that carry a tag
and move along the edges until nothing rises any more, so paths of any length and cycles settle. A round looks only at
the columns that rose in the round before.

* Ranks are grouped per target before they move, so a column that many are written from, or into which many flow, is one
  row per task. The join of edges and risen columns is followed by that grouping alone: a hot source may be split by AQE.
* Every round's table is written below the shared folder, which cuts the lineage; the driver learns one number per round.
* A column rises at most once per level, so rounds are bounded by the longest path times the number of levels.
* Columns without a level that nothing flows into do not appear. Null objects and columns, self-loops and unknown levels
  are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions.masks import LEVELS
from custodia.operators.tags import TAG_NAME
from custodia.sources.snapshots import write_snapshot

_KEY = ["object_name", "column_name"]


def _rank(level: Column) -> Column:
    """1 for the most severe; null for what is no level."""
    return F.nullif(F.array_position(F.array(*map(F.lit, LEVELS)), level), F.lit(0))


def column_levels(tag_references: DataFrame) -> DataFrame:
    """(object_name, column_name, classification_level) of directly tagged columns, under full object names."""
    return tag_references.filter((F.col("tag_name") == TAG_NAME) & (F.col("domain") == "COLUMN")).select(
        F.concat_ws(".", "object_database", "object_schema", "object_name").alias("object_name"),
        "column_name",
        F.col("tag_value").alias("classification_level"),
    )


def propagate_levels(tagged: DataFrame, lineage: DataFrame) -> DataFrame:
    """(object_name, column_name, classification_level, own_level) of every column that carries or receives a level.

    ``tagged``: (object_name, column_name, classification_level). ``lineage``: source_object_name, source_column_name,
    target_object_name, target_column_name; other columns are ignored.
    """
    own = (
        tagged.select(*_KEY, _rank(F.col("classification_level")).alias("rank"))
        .dropna()
        .groupBy(*_KEY)
        .agg(F.min("rank").alias("rank"))
    )
    ends = ["source_object_name", "source_column_name", "target_object_name", "target_column_name"]
    loop = (F.col(ends[0]) == F.col(ends[2])) & (F.col(ends[1]) == F.col(ends[3]))
    edges = write_snapshot(lineage.select(*ends).dropna().filter(~loop).distinct(), "movement")
    own = write_snapshot(own, "own-levels")
    known = risen = own
    while True:
        arriving = (
            edges.join(risen.toDF("source_object_name", "source_column_name", "rank"), ends[:2])
            .groupBy(F.col(ends[2]).alias(_KEY[0]), F.col(ends[3]).alias(_KEY[1]))
            .agg(F.min("rank").alias("rank"))
        )
        better = arriving.join(known.withColumnRenamed("rank", "before"), _KEY, "left").filter(
            F.col("before").isNull() | (F.col("rank") < F.col("before"))
        )
        risen = write_snapshot(better.select(*_KEY, "rank"), "risen-levels")
        if risen.isEmpty():
            break
        known = write_snapshot(known.unionByName(risen).groupBy(*_KEY).agg(F.min("rank").alias("rank")), "levels")
    named = lambda rank: F.get(F.array(*map(F.lit, LEVELS)), rank.cast("int") - 1)
    return known.join(own.withColumnRenamed("rank", "own"), _KEY, "left").select(
        *_KEY, named(F.col("rank")).alias("classification_level"), named(F.col("own")).alias("own_level")
    )


def levels_of_object(levels: DataFrame, object_name: str) -> dict[str, str]:
    """The tags of one object's columns, as ``apply_tags`` and ``Governance.register`` take them."""
    rows = levels.filter(F.col("object_name") == object_name).select("column_name", "classification_level").collect()
    return dict(map(tuple, rows))  # one row per column of one table
