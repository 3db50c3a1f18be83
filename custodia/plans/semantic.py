"""A metrics layer: named dimensions and metrics compiled to aggregation and join.

Tables come from a loader, so handing in governed tables makes every query inherit their row
filters and masks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.operators.partials import first_step, merge_step, second_step
from custodia.sources.tables import literal_rows

# groups a table by a key and further columns, and aggregates
GroupRows = Callable[[str, str, Sequence[Column], Sequence[Column]], DataFrame]


class SemanticError(Exception):
    """Unknown name, a metric that the requested dimensions would multiply, or more than one way to a dimension."""


@dataclass(frozen=True)
class LogicalTable:
    """``primary_key`` is a column or an expression; one row per value."""

    name: str
    primary_key: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Relationship:
    """Many rows of ``child`` to one row of ``parent``."""

    child: str
    foreign_key: str
    parent: str
    label: str = ""

    @property
    def name(self) -> str:
        return self.label or f"{self.child}_to_{self.parent}"


@dataclass(frozen=True)
class Fact:
    name: str
    table: str
    expression: str
    comment: str = ""


@dataclass(frozen=True)
class Dimension:
    name: str
    table: str
    expression: str
    synonyms: tuple[str, ...] = ()
    comment: str = ""


@dataclass(frozen=True)
class MetricDef:
    """``argument`` is a column or the name of a fact of the same table."""

    name: str
    table: str
    function: str
    argument: str
    synonyms: tuple[str, ...] = ()
    comment: str = ""
    digits: int | None = None


@dataclass(frozen=True)
class SemanticModel:
    name: str
    tables: Sequence[LogicalTable]
    relationships: Sequence[Relationship] | Relationship
    facts: Sequence[Fact]
    dimensions: Sequence[Dimension]
    metrics: Sequence[MetricDef]
    _names: Mapping = field(default_factory=dict)

    def __post_init__(self):
        names: dict[str, object] = {}
        for item in [*self.dimensions, *self.metrics]:
            names[item.name.lower()] = item
            names[f"{item.table}.{item.name}".lower()] = item
        for item in [*self.dimensions, *self.metrics]:
            for synonym in item.synonyms:
                names.setdefault(synonym.lower(), item)  # a real name beats a synonym
        object.__setattr__(self, "_names", names)
        if isinstance(self.relationships, Relationship):
            object.__setattr__(self, "relationships", (self.relationships,))
        known = {t.name for t in self.tables}
        labels = [r.name for r in self.relationships]
        if len(set(labels)) < len(labels) or not {t for r in self.relationships for t in (r.child, r.parent)} <= known:
            raise SemanticError(f"{self.name}: relationships need names of their own and known tables")

    def paths(self, start: str, target: str) -> list[list[Relationship]]:
        """All ways from a table to another one that lead from many rows to one, without a table twice."""
        found: list[list[Relationship]] = []

        def walk(table: str, path: list[Relationship], seen: frozenset[str]) -> None:
            if table == target:
                found.append(path)
                return
            for r in self.relationships:
                if r.child == table and r.parent not in seen:
                    walk(r.parent, [*path, r], seen | {r.parent})

        walk(start, [], frozenset([start]))
        return found

    def _path(self, start: str, target: str, via: Sequence[str], what: str) -> list[Relationship]:
        """The one way; of several, the one that takes a relationship named in ``via``."""
        paths = self.paths(start, target)
        if not paths:
            reason = "would multiply" if self.paths(target, start) else "is not related to"
            raise SemanticError(f"{what} {reason} {start}: no way from one {start} row to one {target} row")
        if len(paths) > 1:
            named = [p for p in paths if any(r.name in via for r in p)]
            if len(named) != 1:
                ways = "; ".join(" > ".join(r.name for r in p) for p in paths)
                raise SemanticError(f"{what} can be reached from {start} in {len(paths)} ways ({ways}); name one in via")
            paths = named
        return paths[0]

    def resolve(self, name: str, kind: type):
        item = self._names.get(name.lower())
        if not isinstance(item, kind):
            raise SemanticError(f"{self.name} has no {kind.__name__.lower()} {name!r}")
        return item

    def _argument(self, metric: MetricDef) -> Column:
        facts = {f.name: f.expression for f in self.facts if f.table == metric.table}
        return F.expr(facts.get(metric.argument, metric.argument))

    def query(
        self,
        load: Callable[[str], DataFrame],
        dimensions: Sequence[str],
        metrics: Sequence[str],
        group: GroupRows | None = None,
        via: Sequence[str] = (),
    ) -> DataFrame:
        """Group ``metrics`` by ``dimensions``; only the tables that are needed are read.

        Tables are joined along the relationships that lead from a metric's table to a dimension's. Where there are
        several ways, ``via`` names relationships to take; without it the query is refused.

        ``group(table, key, by, aggregates)`` may do the grouping by a foreign key itself, so that a row filter
        that depends on the key alone can run on the groups instead of the rows.
        """
        dims = [self.resolve(d, Dimension) for d in dimensions]
        wanted = [self.resolve(m, MetricDef) for m in metrics]
        unknown = set(via) - {r.name for r in self.relationships}
        if unknown:
            raise SemanticError(f"{self.name} has no relationship {sorted(unknown)}")
        results = []
        for table in dict.fromkeys(m.table for m in wanted):
            own = [m for m in wanted if m.table == table]
            results.append(self._at_grain(load, group, table, dims, own, via))
        names = [d.name for d in dims]
        out = reduce(lambda a, b: _join_results(a, b, names), results)
        return out.select(*names, *[m.name for m in wanted])

    def _at_grain(
        self,
        load: Callable[[str], DataFrame],
        group: GroupRows | None,
        table: str,
        dims: Sequence[Dimension],
        metrics: Sequence[MetricDef],
        via: Sequence[str],
    ) -> DataFrame:
        """Metrics of one table at its own grain, so that a join never multiplies them."""
        steps: dict[str, Relationship] = {}  # by the table they lead to, in an order that can be walked
        for d in dims:
            if d.table != table:
                for r in self._path(table, d.table, via, f"{d.name} for {[m.name for m in metrics]}"):
                    if steps.setdefault(r.parent, r) != r:
                        raise SemanticError(f"{r.parent} would be reached in two ways in one query")
        of = lambda name: [d for d in dims if d.table == name]
        key = lambda r: f"_key_{r.name}"
        partial = [p for m in metrics for p in first_step(m.function, self._argument(m), m.name)]
        merged = [p for m in metrics for p in merge_step(m.function, m.name)]
        final = []
        for m in metrics:
            value = second_step(m.function, m.name)
            final.append((value if m.digits is None else F.round(value, m.digits)).alias(m.name))

        # Aggregate the many side per foreign key before joining: the join then sees one row per
        # parent, a parent with very many children is no hot key, and the shuffle on the key serves
        # both steps. After every join the rows are grouped again by what the next ones need. Joins are
        # left joins: children without a visible parent keep a NULL dimension, as they do in the raw data.
        own = [F.expr(d.expression).alias(d.name) for d in of(table)]
        first = [r for r in steps.values() if r.child == table]
        if len(first) == 1 and group:
            rows = group(table, first[0].foreign_key, own, partial).withColumnRenamed(first[0].foreign_key, key(first[0]))
        else:
            rows = load(table).groupBy(*own, *[F.expr(r.foreign_key).alias(key(r)) for r in first]).agg(*partial)
        have = [d.name for d in of(table)]
        pending = first
        while pending:
            r, *pending = pending
            primary = next(t.primary_key for t in self.tables if t.name == r.parent)
            onward = [s for s in steps.values() if s.child == r.parent]
            parents = load(r.parent).select(
                F.expr(primary).alias("_primary"),
                *[F.expr(s.foreign_key).alias(key(s)) for s in onward],
                *[F.expr(d.expression).alias(d.name) for d in of(r.parent)],
            )
            rows = rows.join(parents, rows[key(r)] == parents["_primary"], "left").drop(key(r), "_primary")
            have += [d.name for d in of(r.parent)]
            pending = [*pending, *onward]
            if pending:
                rows = rows.groupBy(*have, *[key(s) for s in pending]).agg(*merged)
        return rows.groupBy(*[d.name for d in dims]).agg(*final)

    def check_keys(self, load: Callable[[str], DataFrame]) -> DataFrame:
        """Per relationship: rows of the child, those without a parent, and parent keys that stand twice.

        A metric is right only if no key stands twice; children without a parent come out under NULL.
        """
        keys = {t.name: t.primary_key for t in self.tables}
        reports = []
        for r in self.relationships:
            children = load(r.child).groupBy(F.expr(r.foreign_key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
            parents = load(r.parent).groupBy(F.expr(keys[r.parent]).alias("_primary")).agg(F.count(F.lit(1)).alias("_times"))
            met = children.join(parents, F.col("_key") == F.col("_primary"), "full")
            reports.append(
                met.agg(
                    F.coalesce(F.sum("_n"), F.lit(0)).alias("child_rows"),
                    F.coalesce(F.sum(F.when(F.col("_times").isNull(), F.col("_n"))), F.lit(0)).alias("without_parent"),
                    F.count_if(F.col("_times") > 1).alias("repeated_keys"),
                ).select(F.lit(r.name).alias("relationship"), "child_rows", "without_parent", "repeated_keys")
            )
        return reduce(DataFrame.unionAll, reports)

    def catalog(self) -> list[tuple[str, str, str, str, str]]:
        """Kind, table, name, definition and synonyms of everything in the model."""
        rows = [("FACT", f.table, f.name, f.expression, "") for f in self.facts]
        rows += [("DIMENSION", d.table, d.name, d.expression, ", ".join(d.synonyms)) for d in self.dimensions]
        rows += [
            ("METRIC", m.table, m.name, f"{m.function}({m.argument})", ", ".join(m.synonyms)) for m in self.metrics
        ]
        return rows

    def describe(self, load: Callable[[str], DataFrame]) -> DataFrame:
        """The catalog with the number of non-NULL values behind each fact and dimension."""
        profiles = []
        for table in self.tables:
            items = [x for x in [*self.facts, *self.dimensions] if x.table == table.name]
            counted = load(table.name).agg(*[F.count(F.expr(i.expression)).alias(i.name) for i in items])
            long = counted.unpivot([], [i.name for i in items], "name", "n_values")
            profiles.append(long.withColumn("logical_table", F.lit(table.name)))
        profile = reduce(DataFrame.unionByName, profiles)
        spark = profile.sparkSession
        listing = literal_rows(
            spark,
            self.catalog(), "kind string, logical_table string, name string, definition string, synonyms string"
        )
        return listing.join(profile, ["logical_table", "name"], "left").select(
            "kind", "logical_table", "name", "definition", "synonyms", "n_values"
        )


def _join_results(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Combine aggregates of two tables; NULL dimension values match each other."""
    if not names:
        # one row each: line them up on a constant
        return left.withColumn("_one", F.lit(1)).join(right.withColumn("_one", F.lit(1)), "_one").drop("_one")
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in names else F.col(c) for c in right.columns])
    condition = reduce(
        lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in names]
    )
    joined = left.join(renamed, condition, "full")
    keys = [F.coalesce(left[c], renamed[f"_r_{c}"]).alias(c) for c in names]
    return joined.select(*keys, *[c for c in [*left.columns, *right.columns] if c not in names])
