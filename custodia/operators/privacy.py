"""Differentially private aggregates with a budget ledger.

Laplace mechanism (Dwork et al. 2006) with every entity reduced to one row first, so that adding or
removing an entity changes one group by at most the clamped range (bounded contribution, Wilson et
al. 2020). Noise is drawn on the few aggregated rows from md5 of a secret, everything that defines the query, the
group and the metric: a retried task draws the same noise again, so lost executors cannot be used to average
it away, and two different queries draw independently, also under one id. Published values are rounded
(Mironov 2012).
"""

from __future__ import annotations

import math
import secrets
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from typing import Protocol
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions.keyed import laplace
from custodia.operators.governance import FULL_CLEAR, PolicyError
from custodia.sources.claims import Claims
from custodia.sources.tables import literal_rows

DEFAULT_ALPHA = 0.05


@dataclass(frozen=True)
class Range:
    low: float
    high: float

    def clamp(self, value: Column) -> Column:
        inside = F.least(F.greatest(value, F.lit(self.low)), F.lit(self.high))
        return F.when(value.isNotNull(), inside)  # greatest() would turn NULL into the lower bound

    @property
    def magnitude(self) -> float:
        return max(abs(self.low), abs(self.high))


@dataclass(frozen=True)
class PrivacyPolicy:
    """Protected entity, budget and the public value domains of the columns."""

    entity_key: str
    budget_name: str
    weekly_budget: float = 100.0
    epsilon: float = 1.0
    exempt_roles: frozenset[str] = FULL_CLEAR
    ranges: Mapping[str, Range] = field(default_factory=dict)
    groups: Mapping[str, Sequence[str]] = field(default_factory=dict)


def fresh_secret() -> str:
    """A secret for one query, drawn on the driver from the operating system."""
    return secrets.token_hex(32)


def interval_half_width(scale: float, alpha: float = DEFAULT_ALPHA) -> float:
    """|noise| stays below this with probability 1 - alpha."""
    return scale * math.log(1.0 / alpha)


def signature(
    policy: PrivacyPolicy, kind: str, query_id: str, group: str, value: str | None, where: str | None, alpha: float
) -> str:
    """All that defines a query; the noise is bound to it."""
    return "|".join(map(str, (kind, query_id, policy.entity_key, group, value, where, alpha, policy.epsilon)))


class Budget(Protocol):
    def charge(self, user: str, epsilon: float) -> None:
        """Raise ``PolicyError`` if the budget does not allow it."""


class SessionBudget:
    """A budget kept in this process, for one session's queries."""

    def __init__(self, policy: PrivacyPolicy):
        self._policy, self.spent = policy, 0.0

    def charge(self, user: str, epsilon: float) -> None:
        if self.spent + epsilon > self._policy.weekly_budget + 1e-9:
            raise PolicyError(f"privacy budget {self._policy.budget_name!r} is used up")
        self.spent += epsilon


@dataclass(frozen=True)
class PrivateTable:
    """What a role without exemption may do with a protected table: noisy grouped aggregates within a budget."""

    _raw: DataFrame = field(repr=False)
    policy: PrivacyPolicy
    role: str
    secret: str = field(default_factory=fresh_secret, repr=False)
    ledger: Budget | None = None

    def to_df(self) -> DataFrame:
        if self.role in self.policy.exempt_roles:
            return self._raw
        raise PolicyError(f"role {self.role} may not read rows of a privacy-protected table")

    def _per_entity(self, group: str, value: str | None, where: str | None) -> DataFrame:
        """One row per entity; the minimum makes the choice of its group and value reproducible.

        Restricted to the group column's public domain. The filter applies to the reduced row, as a
        filter before the reduction could move an entity from one group to another.
        """
        if group not in self.policy.groups:
            raise PolicyError(f"{group} has no privacy domain and cannot be grouped by")
        picked = [F.min(group).alias(group)]
        if value:
            picked.append(F.min(value).alias(value))
        reduced = self._raw.groupBy(self.policy.entity_key).agg(*picked)
        return reduced if where is None else reduced.filter(where)

    def _all_groups(self, aggregated: DataFrame, group: str) -> DataFrame:
        """Every group of the public domain, also empty ones, and no other."""
        domain = literal_rows(
            self._raw.sparkSession, [(g,) for g in self.policy.groups[group]], f"{group} string"
        )
        return domain.join(aggregated, group, "left")

    def _publish(self, noisy: DataFrame) -> DataFrame:
        """Run now and return only the values: one row per group of the public domain.

        A lazy result would carry the secret and the way to the exact numbers in its plan, and
        could be evaluated after the budget is gone.
        """
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in noisy.schema.fields)
        return literal_rows(noisy.sparkSession, [tuple(r) for r in noisy.collect()], schema)

    def _noise(self, query: str, metric: str, group: str, scale: float) -> Column:
        return laplace(F.concat(F.lit(f"{query}|"), F.col(group), F.lit(f"|{metric}")), scale, self.secret + "|")

    def _charge(self, user: str, epsilon: float) -> None:
        if self.ledger is not None:
            self.ledger.charge(user, epsilon)
        elif self.role not in self.policy.exempt_roles:
            raise PolicyError(f"role {self.role} needs a budget")

    def count(
        self,
        query_id: str,
        group: str,
        value: str | None = None,
        where: str | None = None,
        user: str = "",
        alpha: float = DEFAULT_ALPHA,
    ) -> DataFrame:
        """Noisy number of entities per group with an interval of confidence 1 - alpha; ``where`` is a SQL test."""
        self._charge(user, self.policy.epsilon)
        counted = F.count(value) if value else F.count(F.lit(1))
        exact = self._per_entity(group, value, where).groupBy(group).agg(counted.alias("_n"))
        scale = 1.0 / self.policy.epsilon
        half = interval_half_width(scale, alpha)
        query = signature(self.policy, "count", query_id, group, value, where, alpha)
        noisy = F.coalesce(F.col("_n"), F.lit(0)) + self._noise(query, "count", group, scale)
        return self._publish(
            self._all_groups(exact, group)
            .select(group, noisy.alias("_x"))
            .select(
                group,
                F.round("_x", 2).alias("noisy_count"),
                F.round(F.col("_x") - half, 2).alias("count_low"),
                F.round(F.col("_x") + half, 2).alias("count_high"),
            )
        )

    def average(self, query_id: str, group: str, value: str, user: str = "") -> DataFrame:
        """Noisy sum over clamped values and noisy count, half the budget each, and their ratio."""
        if value not in self.policy.ranges:
            raise PolicyError(f"{value} has no privacy domain and cannot be summed")
        self._charge(user, self.policy.epsilon)
        limits = self.policy.ranges[value]
        exact = (
            self._per_entity(group, value, None)
            .groupBy(group)
            .agg(
                F.count(value).alias("_n"),
                F.round(F.sum(limits.clamp(F.col(value))), 2).alias("_s"),
            )
        )
        half_epsilon = self.policy.epsilon / 2
        query = signature(self.policy, "average", query_id, group, value, None, DEFAULT_ALPHA)
        noisy_n = F.coalesce(F.col("_n"), F.lit(0)) + self._noise(query, "count", group, 1.0 / half_epsilon)
        noisy_s = F.coalesce(F.col("_s"), F.lit(0.0)) + self._noise(
            query, "sum", group, limits.magnitude / half_epsilon
        )
        ratio = limits.clamp(F.col("_ns") / F.greatest(F.col("_nn"), F.lit(1.0)))
        return self._publish(
            self._all_groups(exact, group)
            .select(group, noisy_n.alias("_nn"), noisy_s.alias("_ns"))
            .select(
                group,
                F.round("_nn", 2).alias("noisy_count"),
                F.round("_ns", 2).alias("noisy_sum"),
                F.round(ratio, 2).alias("noisy_avg"),
            )
        )


def weekly_spend(charges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Budget used per key and calendar week."""
    return charges.groupBy(*by, F.date_trunc("week", "charged_at").alias("week")).agg(
        F.round(F.sum("epsilon"), 6).alias("spent")
    )


def remaining_aggregates(spend: DataFrame, policy: PrivacyPolicy) -> DataFrame:
    """How many further aggregates each week's budget allows."""
    left = F.greatest(F.lit(policy.weekly_budget) - F.col("spent"), F.lit(0.0))
    return spend.withColumn("remaining", F.floor(left / F.lit(policy.epsilon)))


class Ledger:
    """Charges against a budget, shared by any number of writers.

    Every charge of a week is a record with the next free number, written once (``Claims``). A writer adds up the records
    it sees and claims the number after them; if another one was faster, it reads again. So whoever holds a number has
    counted all before it, and the week's budget is never overspent.
    """

    SCHEMA = "budget_name string, user_name string, epsilon double, charged_at timestamp_ntz"

    def __init__(self, spark: SparkSession, path: str, policy: PrivacyPolicy, as_of: str):
        self._spark, self._path, self._policy, self._as_of = spark, path.rstrip("/"), policy, as_of

    def _week(self) -> Claims:
        time = datetime.fromisoformat(self._as_of)
        monday = (time - timedelta(days=time.weekday())).date()
        return Claims(self._spark, f"{self._path}/budget={quote(self._policy.budget_name, safe='')}/week={monday}")

    def charges(self) -> DataFrame:
        """All charges of all budgets and weeks."""
        empty = literal_rows(self._spark, [], self.SCHEMA)
        reader = self._spark.read.schema(self.SCHEMA).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
        try:
            return reader.json(self._path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":  # nothing charged yet
                return empty
            raise

    def spent_this_week(self) -> float:
        return float(sum(r["epsilon"] for r in self._week().records()))

    def charge(self, user: str, epsilon: float) -> None:
        week = self._week()
        record = {
            "budget_name": self._policy.budget_name,
            "user_name": user,
            "epsilon": float(epsilon),
            "charged_at": datetime.fromisoformat(self._as_of).isoformat(),
        }
        while True:
            numbers = week.numbers()
            spent = sum(week.read(n)["epsilon"] for n in numbers)
            if spent + epsilon > self._policy.weekly_budget + 1e-9:
                raise PolicyError(f"privacy budget {self._policy.budget_name!r} is used up for this week")
            if week.put(len(numbers) + 1, record):
                return

    def at(self, as_of: str) -> Ledger:
        """The same ledger seen at another time; a new week starts with a full budget."""
        return Ledger(self._spark, self._path, self._policy, as_of)
