"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.llm.byte_pairs import encode_documents
from custodia.llm.collocations import mine_collocations
from custodia.llm.common import let, table
from custodia.llm.fingerprints import fingerprint_documents
from custodia.llm.jaccard_join import jaccard_components
from custodia.llm.licenses import scan_licenses
from custodia.llm.line_rules import judge_lines
from custodia.llm.mixing import poisson_mix
from custodia.llm.oracles import collocations_sql, jaccard_sql, lines_sql, mixing_sql, url_sql
from custodia.llm.packing import pack_documents
from custodia.llm.periodic_runs import periodic_runs
from custodia.llm.quality_ranker import rank_quality
from custodia.llm.secrets import scan_secrets
from custodia.llm.token_counts import count_tokens
from custodia.llm.url_filter import judge_urls
from custodia.sources.tables import literal_rows

#: The rules of the URL query.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def vocabulary() -> tuple[str, str]:
    """Files of the public byte-level vocabulary: for the tokenizers library, and as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def url_rules(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, URL_RULES, "host string, path string, verdict string")


def op1_scaled_fingerprints(spark: SparkSession, base: str) -> DataFrame:
    return fingerprint_documents(table(spark, base, "documents"))


def op2_pairwise_quality(spark: SparkSession, base: str) -> DataFrame:
    return rank_quality(table(spark, base, "documents"), table(spark, base, "labels"))


def op3_randomness_secrets(spark: SparkSession, base: str) -> DataFrame:
    return scan_secrets(table(spark, base, "documents"))


def op4_signature_trees(spark: SparkSession, base: str) -> DataFrame:
    return jaccard_components(table(spark, base, "documents"), count_links=True).drop("text_key", "group_key")


def op5_url_range_join(spark: SparkSession, base: str) -> DataFrame:
    return judge_urls(table(spark, base, "pages"), url_rules(spark))


def op6_license_windows(spark: SparkSession, base: str) -> DataFrame:
    return scan_licenses(table(spark, base, "documents"))


def op7_line_frequency(spark: SparkSession, base: str) -> DataFrame:
    return judge_lines(table(spark, base, "documents")).drop("host", "text_key")


def op8_tiered_packing(spark: SparkSession, base: str) -> DataFrame:
    return pack_documents(table(spark, base, "documents"), *vocabulary())


def op9_poisson_mixing(spark: SparkSession, base: str) -> DataFrame:
    return poisson_mix(table(spark, base, "documents"))


def op10_token_counts(spark: SparkSession, base: str) -> DataFrame:
    return count_tokens(table(spark, base, "documents"), *vocabulary())


def with_periodic_tails(documents: DataFrame) -> DataFrame:
    """The texts of the run query: where the id's checksum ends in 0, the words from one on repeat with one period."""
    checksum = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1).cast("long"))

    def repeated(words: Column) -> Column:
        g = F.floor(checksum / 10)
        start = F.pmod(g, F.size(words))
        period = 1 + F.floor((F.size(words) - start) / (3 + F.pmod(g, F.lit(8))))
        return let(
            F.struct(start.alias("a"), period.alias("p")),
            lambda x: F.array_join(
                F.transform(
                    words,
                    lambda word, i: F.when(i < x["a"], word).otherwise(
                        F.get(words, (x["a"] + F.pmod(i - x["a"], x["p"])).cast("int"))
                    ),
                ),
                " ",
            ),
        )

    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    touched = (F.pmod(checksum, F.lit(10)) == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return documents.select("doc_id", F.when(touched, let(words, repeated)).otherwise(F.col("text")).alias("text"))


def op11_maximal_pair_runs(spark: SparkSession, base: str) -> DataFrame:
    found = periodic_runs(with_periodic_tails(table(spark, base, "documents")))
    first = F.array_max(F.transform("runs", lambda x: F.struct(x["length"], -x["start"], -x["period"])))
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    longest = F.struct(first["length"].alias("length"), (-first["col2"]).alias("start"), (-first["col3"]).alias("period"))
    return found.withColumn("longest", F.when(F.size("runs") > 0, longest)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_trie_collocations(spark: SparkSession, base: str) -> DataFrame:
    return mine_collocations(table(spark, base, "documents"))


def op13_scanned_byte_pairs(spark: SparkSession, base: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode_documents(table(spark, base, "documents"), ranks, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_scaled_fingerprints,
        op2_pairwise_quality,
        op3_randomness_secrets,
        op4_signature_trees,
        op5_url_range_join,
        op6_license_windows,
        op7_line_frequency,
        op8_tiered_packing,
        op9_poisson_mixing,
        op10_token_counts,
        op11_maximal_pair_runs,
        op12_trie_collocations,
        op13_scanned_byte_pairs,
    )
}
#: SQL for DuckDB. The others need token ids, trained scores, 64-bit sketches or positions of regular expressions.
ORACLES: dict[str, str] = {
    "op4_signature_trees": jaccard_sql(),
    "op5_url_range_join": url_sql(URL_RULES),
    "op7_line_frequency": lines_sql(),
    "op9_poisson_mixing": mixing_sql(),
    "op12_trie_collocations": collocations_sql(),
}
