"""Row access policies. The role is known when the plan is built, so it never costs a per-row test."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class RowFilter(Protocol):
    name: str

    def apply(self, df: DataFrame, role: str) -> DataFrame: ...


def _nothing(df: DataFrame) -> DataFrame:
    return df.filter(F.lit(False))


@dataclass(frozen=True)
class AttributeFilter:
    """Open roles see all rows, matching roles only ``column = value``, all others none."""

    name: str
    column: str
    value: str
    open_roles: frozenset[str]
    matching_roles: frozenset[str]

    def apply(self, df: DataFrame, role: str) -> DataFrame:
        if role in self.open_roles:
            return df
        if role in self.matching_roles:
            return df.filter(F.col(self.column) == self.value)
        return _nothing(df)


@dataclass(frozen=True)
class MappingFilter:
    """Rows whose ``column`` is mapped to the role; roles without a mapping see nothing.

    A left semi join: Spark broadcasts the map while it is under the broadcast threshold and
    shuffles both sides beyond it.
    """

    name: str
    column: str
    mapping: DataFrame
    open_roles: frozenset[str]
    role_column: str = "role"
    value_column: str = "visible_value"

    def visible_values(self, role: str) -> DataFrame:
        return self.mapping.filter(F.col(self.role_column) == role).select(
            F.col(self.value_column).alias("_visible")
        )

    def apply(self, df: DataFrame, role: str) -> DataFrame:
        if role in self.open_roles:
            return df
        values = self.visible_values(role)
        return df.join(values, df[self.column] == values["_visible"], "left_semi")


@dataclass(frozen=True)
class ParentFilter:
    """A child row is visible when its parent row is.

    ``parent`` is the raw parent table; its own filter runs first, then the child is semi-joined
    on the key. Keys of different type are compared as the parent's type, and a child key that
    does not convert matches nothing.
    """

    name: str
    foreign_key: str
    parent: DataFrame
    parent_key: str
    parent_filter: RowFilter
    open_roles: frozenset[str]

    def apply(self, df: DataFrame, role: str) -> DataFrame:
        if role in self.open_roles:
            return df
        visible = self.parent_filter.apply(self.parent, role)
        key_type = visible.schema[self.parent_key].dataType
        visible = visible.select(F.col(self.parent_key).alias("_parent"))
        same_type = df.schema[self.foreign_key].dataType == key_type
        child_key = df[self.foreign_key] if same_type else df[self.foreign_key].try_cast(key_type)
        return df.join(visible, child_key == visible["_parent"], "left_semi")


def roles(*names: Iterable[str] | str) -> frozenset[str]:
    return frozenset(n for group in names for n in ([group] if isinstance(group, str) else group))
