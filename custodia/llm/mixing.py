"""Poisson replication: mix sources to target weights by repeating documents.

A source with ``n`` documents and target share ``w`` has the mean repetition rate ``total * w / n``. Every
document draws its number of copies by inverting the Poisson distribution at a uniform value hashed from
its id and a seed, is exploded by it, and the copies are shuffled by another hash.

* Rates above ``STEP`` are drawn as sums of several smaller Poisson values, which is exact, so no rate
  underflows and no count is capped.
* Rates are one row per source, written before texts are read, so Spark knows their size: it broadcasts them below its
  threshold and no text moves by source; beyond it the equi-join is split at a hot source. The copies move once, dealt
  by a hash that no source or document dominates.
* Null source: a source of its own. Rows with equal ids draw alike; rows without an id draw by their
  text. Null text stays null. Empty tables give empty results. Other columns are kept, whatever they are called; a
  column called as the copy number is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions.keyed import hash_long, uniform
from custodia.llm.common import let, stored

STEP = 64.0
#: Terms of the distribution at rate ``STEP``; beyond them the rest is below 2**-53.
TERMS = 200


def repetition_rates(documents: DataFrame, exponent: float, weights: dict[str, float] | None = None) -> DataFrame:
    """(mix_source, rate). Weights: given ones, else the source's share to the power ``exponent``."""
    counts = documents.groupBy(F.col("source").alias("mix_source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighted = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(float(exponent))))
    else:
        table = counts.sparkSession.createDataFrame(sorted(weights.items()), "name string, w double")
        weighted = counts.join(table, counts.mix_source == table.name, "left").withColumn(
            "w", F.coalesce("w", F.lit(0.0))
        )
    total, scale = weighted.agg(F.sum("n"), F.sum("w")).first()
    factor = float(total or 0) / float(scale) if scale else 0.0
    return weighted.select("mix_source", (F.lit(factor) * F.col("w") / F.col("n")).alias("rate"))


def cumulative(rate: Column) -> Column:
    """Cumulative Poisson probabilities at 0, 1, 2, ... while they are below 1."""
    first = F.exp(-rate)
    start = F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all"))

    def term(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        c = state["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(state["all"], F.array(c)).alias("all"))

    sums = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, term, lambda s: s["all"])
    return F.filter(sums, lambda c: c < 1.0)


def poisson_mix(
    documents: DataFrame,
    exponent: float = 0.7,
    weights: dict[str, float] | None = None,
    seed: str = "mix",
    copy: str = "copy",
) -> DataFrame:
    """Every document as often as drawn, with the copy's number from 1, in hashed order."""
    rates = stored(repetition_rates(documents, exponent, weights), "rates").select(
        "mix_source",
        F.greatest(F.ceil(F.col("rate") / STEP), F.lit(1)).cast("int").alias("mix_draws"),
        F.col("rate").alias("mix_rate"),
    )
    rates = rates.withColumn("mix_cdf", cumulative(F.col("mix_rate") / F.col("mix_draws")))
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    row = F.struct(*[quoted(c) for c in documents.columns if c != copy])  # the caller's names stay inside
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce("text", F.lit("")))))

    def drawn(number: Column) -> Column:
        u = uniform(F.concat_ws(":", F.col("mix_name"), number.cast("string")), seed)
        return let(u, lambda value: F.size(F.filter("mix_cdf", lambda c: c <= value)))

    counts = F.aggregate(
        F.sequence(F.lit(1), F.col("mix_draws")), F.lit(0), lambda total, number: total + drawn(number)
    )
    left = documents.select(row.alias("row"), name.alias("mix_name"), F.col("source").alias("own_source"))
    copies = (
        left.join(rates, left.own_source.eqNullSafe(rates.mix_source))
        .withColumn("mix_count", counts)
        .where("mix_count > 0")
        .select("row", "mix_name", F.explode(F.expr("sequence(1L, cast(mix_count AS bigint))")).alias("number"))
    )
    order = hash_long(F.concat_ws(":", F.col("mix_name"), F.col("number").cast("string")), f"{seed} order")
    return (
        copies.select("row", "number", order.alias("mix_order"))
        .repartition("mix_order")
        .sortWithinPartitions("mix_order")
        .select("row.*", F.col("number").alias(copy))
    )
