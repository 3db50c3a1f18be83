"""Values inside structs, arrays and maps: their paths, their written form, and masks that reach them.

A path is written as the column, then ``.field`` for a struct's field, ``[]`` for the elements of an array, ``{}`` for the
values and ``{key}`` for the keys of a map: ``contacts[].mail``. Everything is column expressions, so values are taken apart
and masked in the scan stage.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custodia.functions.masks import mask

ITEMS, VALUES, KEYS = "[]", "{}", "{key}"


@dataclass(frozen=True)
class Leaf:
    """A place of simple values: its path, the name that stands nearest to it, and how to get there from the column."""

    path: str
    name: str
    column: str
    steps: tuple[str, ...]  # ".field", ITEMS, VALUES or KEYS
    kind: T.DataType


def _below(path: str, name: str, column: str, steps: tuple[str, ...], kind: T.DataType) -> Iterator[Leaf]:
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _below(f"{path}.{f.name}", f.name, column, (*steps, f".{f.name}"), f.dataType)
    elif isinstance(kind, T.ArrayType):
        yield from _below(path + ITEMS, name, column, (*steps, ITEMS), kind.elementType)
    elif isinstance(kind, T.MapType):
        yield from _below(path + KEYS, name, column, (*steps, KEYS), kind.keyType)
        yield from _below(path + VALUES, name, column, (*steps, VALUES), kind.valueType)
    else:
        yield Leaf(path, name, column, steps, kind)


def leaves(schema: T.StructType) -> list[Leaf]:
    """All places of simple values; a plain column is one under its own name."""
    return [leaf for f in schema.fields for leaf in _below(f.name, f.name, f.name, (), f.dataType)]


def nested_paths(schema: T.StructType) -> dict[str, Leaf]:
    """Those that are no plain columns."""
    return {leaf.path: leaf for leaf in leaves(schema) if leaf.steps}


def readable(kind: T.DataType) -> bool:
    """Whether values have a written form that patterns are made for."""
    return isinstance(kind, (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def written(value: Column, kind: T.DataType) -> Column:
    """Text of a value: of numbers with a fraction only those that have none, of times their day."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when((value == F.floor(value)) & (F.abs(value) < 1e17), value.cast("decimal(20,0)").cast("string"))
    if isinstance(kind, T.DecimalType) and kind.scale > 0:
        return F.when(value == F.floor(value), F.floor(value).cast("string"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return value.cast("date").cast("string")
    return value.cast("string")


def _field(value: Column, step: str) -> Column:
    return value.getField(step[1:])


def _parts(value: Column, step: str) -> Column:
    return {ITEMS: lambda v: v, VALUES: F.map_values, KEYS: F.map_keys}[step](value)


def _texts(value: Column, steps: tuple[str, ...], kind: T.DataType) -> Column:
    if not steps:
        return F.array(written(value, kind))
    step, rest = steps[0], steps[1:]
    if step.startswith("."):
        return _texts(_field(value, step), rest, kind)
    if not rest:
        return F.transform(_parts(value, step), lambda x: written(x, kind))
    nothing = F.array().cast("array<string>")  # a null part would make the whole null
    return F.flatten(F.transform(_parts(value, step), lambda x: F.coalesce(_texts(x, rest, kind), nothing)))


def texts(leaf: Leaf) -> Column:
    """All values of a place in one row, as an array of texts."""
    return _texts(F.col(f"`{leaf.column.replace('`', '``')}`"), leaf.steps, leaf.kind)


def _tree(levels: Mapping[tuple[str, ...], str]) -> dict | str:
    if () in levels:
        return levels[()]
    out: dict = {}
    for step in dict.fromkeys(steps[0] for steps in levels):
        out[step] = _tree({s[1:]: level for s, level in levels.items() if s[0] == step})
    return out


def _masked(value: Column, kind: T.DataType, tree: dict | str, salt: str) -> Column:
    if isinstance(tree, str):
        return mask(value, tree, kind, salt)
    if isinstance(kind, T.StructType):
        for step, below in tree.items():
            inner = _masked(_field(value, step), kind[step[1:]].dataType, below, salt)
            value = value.withField("`" + step[1:].replace("`", "``") + "`", inner)
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _masked(x, kind.elementType, tree[ITEMS], salt))
    if VALUES in tree:
        value = F.transform_values(value, lambda _, v: _masked(v, kind.valueType, tree[VALUES], salt))
    if KEYS not in tree:
        return value
    if not isinstance(kind.keyType, T.StringType):
        return F.lit(None).cast(kind)
    # equal masks would be equal keys; their place keeps them apart
    keys = F.transform(F.map_keys(value), lambda k, i: F.concat(_masked(k, kind.keyType, tree[KEYS], salt), F.lit("#"), i + 1))
    return F.map_from_arrays(keys, F.map_values(value))


def masked_inside(value: Column, kind: T.DataType, levels: Mapping[tuple[str, ...], str], salt: str = "") -> Column:
    """The value with a mask on every place of ``levels`` (steps to the place, level); all else as it is."""
    return _masked(value, kind, _tree(levels), salt)
