"""A training corpus in five stages: quality rules, near duplicates, secrets, source mixing, packing.

Every stage takes what its predecessor kept, as Parquet in the shared folder, and makes its decisions take effect. All but
the last return the columns of ``documents``. Nulls, empty texts, repeated rows and empty tables are handled as the
operators of ``custodia.llm`` state; further columns of the input are left out by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from custodia.llm.common import stored, table
from custodia.llm.jaccard_join import first_of_each
from custodia.llm.line_rules import cleaned_documents
from custodia.llm.mixing import poisson_mix
from custodia.llm.packing import pack_documents
from custodia.llm.queries import vocabulary
from custodia.llm.secrets import redacted

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the per-document rules and are not mostly their host's boilerplate, without the frequent lines."""
    return cleaned_documents(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked shingle sets."""
    return first_of_each(docs.select(*COLUMNS))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    return redacted(docs.select(*COLUMNS))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in shuffled order."""
    return poisson_mix(docs.select(*COLUMNS)).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return pack_documents(docs, *vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

#: Token ids cannot be had in SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
