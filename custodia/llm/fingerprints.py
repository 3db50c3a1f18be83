"""Threshold-scaled document fingerprints, and documents compared with the next one and an edited text.

A fingerprint keeps every 5-word shingle hash below a fixed fraction of the hash range, and at least the
``floor`` smallest, so short documents are kept whole. Union, then the same rule, merges fingerprints. Two
fingerprints are compared below the threshold both of them cover; there the share of one's hashes that the other
holds estimates containment, also between very unequal documents.

* Native: words, hashes and sketches are column expressions in the stage that reads or joins the text.
* The next document (descending id) is found on ids alone: up to ``RANGES`` id ranges at percentile bounds, a
  window in each, and one row per range for the ends. Texts then move once, and of each next document only the
  part that its predecessor needs.
* Null text: empty. Null ids come last, as the smallest (and the smallest long is not told from them). Equal ids are ordered by a hash of their texts. Rows alike
  in id and text are one document and returned once. An empty table gives an empty result; a single document
  is its own next one. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.common import let

SHINGLE = 5
RANGES = 256
_LOW = -(2**63)
_HIGH = 2**63 - 1


def shingle_hashes(text: Column) -> Column:
    """Hashes of all 5-word shingles in text order; of the whole sequence if it is shorter."""
    words = F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")

    def hashed(w: Column) -> Column:
        last = F.greatest(F.size(w) - SHINGLE, F.lit(0))
        return F.when(
            F.size(w) > 0,
            F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])),
        ).otherwise(F.array().cast("array<bigint>"))

    return let(words, hashed)


def threshold(fraction: float) -> int:
    return _LOW + int(fraction * 2.0**64)


def reduced(hashes: Column, fraction: float, floor: int) -> Column:
    """The sketch of a set of hashes: sorted, below the threshold or among the ``floor`` smallest."""
    below = F.sort_array(F.array_distinct(F.filter(hashes, lambda h: h < F.lit(threshold(fraction)))))
    return let(
        below,
        lambda kept: F.when(F.size(kept) >= floor, kept).otherwise(
            F.slice(F.sort_array(F.array_distinct(hashes)), 1, floor)
        ),
    )


def sketch(text: Column, fraction: float, floor: int) -> Column:
    return let(shingle_hashes(text), lambda hashes: reduced(hashes, fraction, floor))


def merged(a: Column, b: Column, fraction: float, floor: int) -> Column:
    """The sketch of the union of two documents."""
    return reduced(F.concat(a, b), fraction, floor)


def written(kept: Column) -> Column:
    """16 hexadecimal digits per hash."""
    return F.lower(F.array_join(F.transform(kept, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def covered(kept: Column, fraction: float, floor: int) -> Column:
    """The largest hash up to which a sketch is complete."""
    return F.when(F.size(kept) < floor, F.lit(_HIGH)).otherwise(
        F.greatest(F.lit(threshold(fraction) - 1), F.array_max(kept))
    )


def containment(a: Column, b: Column, fraction: float, floor: int) -> Column:
    """Estimated share of the first document's shingles that the second holds; 1 if both have none."""
    limit = F.least(covered(a, fraction, floor), covered(b, fraction, floor))

    def share(top: Column) -> Column:
        own = F.filter(a, lambda h: h <= top)
        both = F.array_intersect(own, b)
        return F.when(F.size(own) > 0, F.size(both) / F.size(own)).otherwise(
            F.when(F.size(a) == F.size(b), F.lit(1.0)).otherwise(F.lit(0.0))
        )

    return let(limit, share)


def resemblance(a: Column, b: Column, fraction: float, floor: int) -> Column:
    """Estimated Jaccard similarity; 1 if both documents have no shingles."""
    limit = F.least(covered(a, fraction, floor), covered(b, fraction, floor))

    def share(top: Column) -> Column:
        union = F.filter(F.array_union(a, b), lambda h: h <= top)
        both = F.filter(F.array_intersect(a, b), lambda h: h <= top)
        return F.when(F.size(union) > 0, F.size(both) / F.size(union)).otherwise(F.lit(1.0))

    return let(limit, share)


def predecessors(ids: DataFrame) -> DataFrame:
    """For each (k1, k2, n) the row before it in descending order, the last one before the first.

    ``ids`` has one row per document. Percentile bounds cut it into at most ``RANGES`` ranges of equal size.
    """
    steps = [i / RANGES for i in range(1, RANGES)]
    found = ids.agg(F.percentile_approx("k1", steps).alias("bounds")).first()["bounds"] or []
    bounds = F.array(*[F.lit(b).cast("long") for b in sorted(set(found))]).cast("array<bigint>")
    ranged = ids.withColumn("range", F.size(F.filter(bounds, lambda b: F.col("k1") >= b)))
    inside = Window.partitionBy("range").orderBy(F.desc("k1"), F.desc("k2"))
    row = F.struct("k1", "k2", "n")
    ordered = ranged.withColumn("before", F.lag(row).over(inside))
    ends = ranged.groupBy("range").agg(F.min(row).alias("end"))  # at most RANGES rows
    downwards = Window.orderBy(F.desc("range"))
    ends = ends.select(
        F.col("range").alias("end_range"),
        F.coalesce(F.lag("end").over(downwards), F.last("end").over(downwards.rowsBetween(0, Window.unboundedFollowing))).alias("end"),
    )
    return (
        ordered.join(ends, (F.col("range") == F.col("end_range")) & F.col("before").isNull(), "left")
        .withColumn("before", F.coalesce("before", "end"))
        .select("k1", "k2", F.col("before.k1").alias("p1"), F.col("before.k2").alias("p2"), F.col("before.n").alias("pn"))
    )


def fingerprint_documents(documents: DataFrame, fraction: float = 0.125, floor: int = 16) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how near that and the next document are.

    Edited: the last third of the code points (rounded down) gives way to as many from the start of the next document.
    """
    keyed = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumns({"k1": F.coalesce("doc_id", F.lit(_LOW)), "k2": F.xxhash64("text")})
    links = predecessors(keyed.groupBy("k1", "k2").agg(F.max(F.length("text")).cast("long").alias("n")))
    own = (
        keyed.withColumn("sketch", sketch(F.col("text"), fraction, floor))
        .groupBy("k1", "k2")
        .agg(F.first("text").alias("text"), F.first("sketch").alias("sketch"))
    )
    sent = (
        own.join(links, ["k1", "k2"])
        .groupBy("p1", "p2")
        .agg(
            F.first(F.expr("left(text, cast(pn div 3 AS int))")).alias("head"),
            F.first("sketch").alias("next_sketch"),
        )
        .select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "head", "next_sketch")
    )
    paired = own.join(sent, ["k1", "k2"]).withColumn("n_chars", F.length("text").cast("long"))
    edited = (
        paired.withColumn("edited", F.expr("concat(left(text, cast(n_chars - n_chars div 3 AS int)), head)"))
        .withColumn("edited_sketch", sketch(F.col("edited"), fraction, floor))
    )
    a, e, n = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return edited.select(
        F.when(F.col("k1") != _LOW, F.col("k1")).alias("doc_id"),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(a).alias("fingerprint"),
        written(e).alias("edited_fingerprint"),
        containment(a, e, fraction, floor).alias("near_edited"),
        containment(a, n, fraction, floor).alias("near_next"),
        resemblance(a, e, fraction, floor).alias("resemblance_edited"),
        resemblance(a, n, fraction, floor).alias("resemblance_next"),
    )
