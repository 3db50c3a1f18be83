"""Tables as a role may see them: row filter, then masks, then projection and aggregation limits."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custodia.functions.masks import mask
from custodia.operators.partials import first_step, second_step, splits
from custodia.operators.paths import masked_inside, nested_paths
from custodia.operators.row_filters import ParentFilter, RowFilter, roles
from custodia.operators.tags import METADATA_KEY, apply_tags, inherit, level_of, levels_inside, tags_of

# The roles of the reference scenario.
ENGINEER, GOVERNOR, ADMIN = "DATA_ENGINEER", "DATA_GOVERNOR", "ACCOUNTADMIN"
DATA_USER, IT_ADMIN = "DATA_USER", "IT_ADMIN"
FULL_CLEAR = roles(ENGINEER, GOVERNOR, ADMIN)
TEXT_CLEAR = roles(GOVERNOR, ADMIN)  # original free text: the engineer is not in this list


class PolicyError(Exception):
    """The query is not allowed for this role."""


def resolved(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The columns that Spark would take ``names`` for: back-ticks removed, case ignored unless the session minds it."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive").lower() == "true"
    key = (lambda c: c) if exact else str.lower
    columns = {key(c): c for c in df.columns}
    out = []
    for name in names:
        plain = name[1:-1].replace("``", "`") if len(name) > 1 and name[0] == name[-1] == "`" else name
        if key(plain) not in columns:
            raise PolicyError(f"no column {name!r}; name single columns")
        out.append(columns[key(plain)])
    return out


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def sealed(df: DataFrame, name: str) -> DataFrame:
    """A frame whose later filters and sorts cannot fall back on columns below its last projection."""
    return df.alias(name)


def masked_columns(df: DataFrame, role: str, salt: str = "") -> DataFrame:
    """All columns in one projection; full-clear roles get the table itself.

    The tag stays in the metadata of the masked column, so tables derived from it are masked too.
    """
    if role in FULL_CLEAR:
        return df
    paths = nested_paths(df.schema) if any(levels_inside(df, c) for c in df.columns) else {}

    def masked(f: T.StructField) -> Column:
        shown = mask(quoted(f.name), f.metadata.get(METADATA_KEY), f.dataType, salt)
        inside = {paths[p].steps: level for p, level in levels_inside(df, f.name).items() if p in paths}
        if len(inside) < len(levels_inside(df, f.name)):  # the column has changed its shape below a tag
            return F.lit(None).cast(f.dataType)
        return masked_inside(shown, f.dataType, inside, salt) if inside else shown

    return df.select(*[masked(f).alias(f.name, metadata=f.metadata) for f in df.schema.fields])


@dataclass(frozen=True)
class GovernedTable:
    """One table for one role, rows already filtered. Only ``to_df`` hands out a DataFrame."""

    _raw: DataFrame = field(repr=False)
    role: str
    hidden: frozenset[str] = frozenset()  # may be filtered on, not returned
    salt: str = ""

    def where_hidden_in(self, column: str, values: list, negate: bool = False) -> GovernedTable:
        """Filter on the raw value of a projection-limited column by (in)equality.

        The column's owner opts in by limiting it; values can be guessed one at a time this way.
        """
        (column,) = resolved(self._raw, [column])
        if column not in self.hidden:
            raise PolicyError(f"{column} is not projection-limited; filter the returned DataFrame")
        test = quoted(column).isin(values)
        return replace(self, _raw=self._raw.filter(~test if negate else test))

    def select(self, *columns: str) -> GovernedTable:
        columns = resolved(self._raw, columns)
        blocked = self.hidden.intersection(columns)
        if blocked:
            raise PolicyError(f"role {self.role} may not return {sorted(blocked)}")
        return replace(self, _raw=self._raw.select(*map(quoted, columns)), hidden=frozenset())

    def exclude(self, *columns: str) -> GovernedTable:
        gone = set(resolved(self._raw, columns))
        kept = [quoted(c) for c in self._raw.columns if c not in gone]
        return replace(self, _raw=self._raw.select(*kept), hidden=self.hidden - gone)

    def to_df(self) -> DataFrame:
        """The masked rows. Every later expression, also a filter or sort, sees masked values only."""
        if self.hidden:
            raise PolicyError(f"role {self.role} may not return {sorted(self.hidden)}; exclude them")
        return sealed(masked_columns(self._raw, self.role, self.salt), "governed")


# Aggregates that do not return the value of a single row.
_AGGREGATES = {
    "count": F.count,
    "count_distinct": F.count_distinct,
    "sum": F.sum,
    "avg": F.avg,
}


def _check_allowed(specs: Mapping[str, tuple[str, str]]) -> None:
    for function, _ in specs.values():
        if function not in _AGGREGATES:
            raise PolicyError(f"aggregate {function!r} is not allowed here; use {sorted(_AGGREGATES)}")


def build_aggregates(specs: Mapping[str, tuple[str, str]]) -> list[Column]:
    return [
        _AGGREGATES[function](F.lit(1) if argument == "*" else argument).alias(name)
        for name, (function, argument) in specs.items()
    ]


@dataclass(frozen=True)
class AggregateOnlyTable:
    """A table of which this role sees groups of at least ``min_group`` rows, never rows."""

    _raw: DataFrame = field(repr=False)
    role: str
    min_group: int
    dimension: DataFrame | None = None
    on: str = ""
    key: str = ""

    def to_df(self) -> DataFrame:
        raise PolicyError(f"role {self.role} must aggregate this table")

    select = exclude = where_hidden_in = lambda self, *_, **__: self.to_df()

    def join_dimension(self, dimension: DataFrame, on: str, key: str) -> AggregateOnlyTable:
        """Add the columns of a dimension, one row per key: repeated keys would inflate the groups."""
        if self.dimension is not None:
            raise PolicyError("one dimension at a time; join dimensions with each other first")
        return replace(self, dimension=dimension, on=on, key=key)

    def _grouped(self, by: list[str], specs: Mapping[str, tuple[str, str]]) -> DataFrame:
        """Aggregates per group and, as ``_rows``, the protected rows in it."""
        specs = {**specs, "_rows": ("count", "*")}
        if self.dimension is None:
            return self._raw.groupBy(*by).agg(*build_aggregates(specs))
        if not all(splits(function) for function, _ in specs.values()):
            arguments = [a for _, a in specs.values() if a != "*"]
            dimension = self._one_per_key([c for c in [*by, *arguments] if c not in self._raw.columns])
            joined = self._raw.join(dimension, self._raw[self.on] == dimension["_key"])
            return joined.groupBy(*by).agg(*build_aggregates(specs))
        own = [c for c in by if c in self._raw.columns]
        steps = [
            column
            for name, (function, argument) in specs.items()
            for column in first_step(function, F.lit(1) if argument == "*" else F.col(argument), name)
        ]
        per_key = self._raw.groupBy(*dict.fromkeys([self.on, *own])).agg(*steps)
        extra = [c for c in by if c not in own]
        dimension = self._one_per_key(extra)
        return (
            per_key.join(dimension, per_key[self.on] == dimension["_key"])
            .groupBy(*by)
            .agg(*[second_step(function, name).alias(name) for name, (function, _) in specs.items()])
        )

    def _one_per_key(self, columns: list[str]) -> DataFrame:
        """The dimension as ``_key`` and ``columns``; of repeated keys the smallest row counts."""
        row = F.struct(*dict.fromkeys(columns)) if columns else F.struct(F.lit(0).alias("_none"))
        reduced = self.dimension.groupBy(F.col(self.key).alias("_key")).agg(F.min(row).alias("_row"))
        return reduced.select("_key", *[F.col("_row")[c].alias(c) for c in dict.fromkeys(columns)])

    def aggregate(self, by: list[str], merge_small: bool = False, **specs: tuple[str, str]) -> DataFrame:
        """Grouped aggregates; groups below the limit are dropped.

        With ``merge_small`` they are pooled into one group with NULL keys, kept if the pool itself
        reaches the limit. Pooling needs aggregates that add up, so it takes count and sum only.
        """
        _check_allowed(specs)
        grouped = self._grouped(by, specs)
        if not merge_small:
            large = grouped.filter(F.col("_rows") >= self.min_group)
            return sealed(large.select(*by, *specs), "grouped")
        if any(function not in ("count", "sum") for function, _ in specs.values()):
            raise PolicyError("merge_small needs count or sum aggregates")
        small = F.col("_rows") < self.min_group
        pooled = grouped.groupBy(
            small.alias("_pooled"), *[F.when(~small, F.col(c)).alias(c) for c in by]
        ).agg(*[F.sum(name).alias(name) for name in specs], F.sum("_rows").alias("_rows"))
        return sealed(pooled.filter(F.col("_rows") >= self.min_group).select(*by, *specs), "grouped")


@dataclass
class _Entry:
    df: DataFrame
    row_filter: RowFilter | None = None
    hidden: frozenset[str] = frozenset()
    min_group: int | None = None


@dataclass
class Governance:
    """Which policies hang on which table. Policies act on plans, never on stored data."""

    salt: str = ""
    _tables: dict[str, _Entry] = field(default_factory=dict)

    def register(self, name: str, df: DataFrame, tags: Mapping[str, str] | None = None) -> None:
        """A base table; without ``tags`` those in its column metadata count."""
        self._tables[name] = _Entry(apply_tags(df, tags if tags is not None else tags_of(df)))

    def register_derived(self, name: str, df: DataFrame, sources: list[str], lineage=None, kept=()) -> None:
        """A copy or transformation: inherits tags, hence masks. Row filters are not inherited."""
        tags = inherit(df, [self._tables[s].df for s in sources], lineage, kept)
        self._tables[name] = _Entry(apply_tags(df, tags))

    def raw(self, name: str) -> DataFrame:
        return self._tables[name].df

    def tags(self, name: str) -> dict[str, str]:
        return tags_of(self._tables[name].df)

    def set_tags(self, name: str, tags: Mapping[str, str]) -> None:
        """Add or change tags; all others stay."""
        entry = self._tables[name]
        plain = [c for c in tags if c not in nested_paths(entry.df.schema)]
        named = {**{p: tags[p] for p in tags if p not in plain}, **dict(zip(resolved(entry.df, plain), map(tags.get, plain)))}
        entry.df = apply_tags(entry.df, {**tags_of(entry.df), **named})

    def unset_tags(self, name: str, *columns: str) -> None:
        entry = self._tables[name]
        inside = [c for c in columns if c in nested_paths(entry.df.schema)]
        gone = {*inside, *resolved(entry.df, [c for c in columns if c not in inside])}
        entry.df = apply_tags(entry.df, {c: t for c, t in tags_of(entry.df).items() if c not in gone})

    def add_row_filter(self, name: str, row_filter: RowFilter) -> None:
        if self._tables[name].row_filter is not None:
            raise PolicyError(f"{name} already has a row filter; drop it first")
        self._tables[name].row_filter = row_filter

    def drop_row_filter(self, name: str) -> None:
        self._tables[name].row_filter = None

    def limit_projection(self, name: str, *columns: str) -> None:
        entry = self._tables[name]
        entry.hidden = frozenset(resolved(entry.df, columns))

    def limit_aggregation(self, name: str, min_group: int | None) -> None:
        self._tables[name].min_group = min_group

    def table(self, name: str, role: str) -> GovernedTable | AggregateOnlyTable:
        entry = self._tables[name]
        rows = entry.row_filter.apply(entry.df, role) if entry.row_filter else entry.df
        clear = role in FULL_CLEAR
        if entry.min_group and not clear:
            return AggregateOnlyTable(masked_columns(rows.drop(*entry.hidden), role, self.salt), role, entry.min_group)
        return GovernedTable(rows, role, frozenset() if clear else entry.hidden, self.salt)


def grouped_by_key(
    gov: Governance, name: str, role: str, key: str, by: Sequence[Column], aggregates: Sequence[Column]
) -> DataFrame:
    """Masked rows grouped by ``key`` and ``by``, as the role's row filter leaves them.

    A filter that looks at ``key`` alone keeps or drops whole groups, so it runs after the grouping, when the rows of
    a very frequent key have become one. A table whose columns or group sizes are limited for the role takes the
    ordinary way, which refuses what the role may not see. Unfiltered rows never leave this function.
    """
    entry = gov._tables[name]
    row_filter = entry.row_filter
    limited = role not in FULL_CLEAR and bool(entry.hidden or entry.min_group)
    late = isinstance(row_filter, ParentFilter) and row_filter.foreign_key == key and level_of(entry.df, key) is None
    if late and not limited:
        grouped = masked_columns(entry.df, role, gov.salt).groupBy(key, *by).agg(*aggregates)
        return sealed(row_filter.apply(grouped, role), "grouped")
    return gov.table(name, role).to_df().groupBy(key, *by).agg(*aggregates)


def switch_by_role(df: DataFrame, role: str, clear: str, redacted: str, name: str) -> DataFrame:
    """Show one of two stored columns, chosen when the plan is built; the other is never read."""
    clear, redacted = resolved(df, [clear, redacted])
    chosen = clear if role in TEXT_CLEAR else redacted
    shown = df.select(*[quoted(c) for c in df.columns if c not in (clear, redacted)], quoted(chosen).alias(name))
    return sealed(shown, "switched")
