"""Extra columns called like anything that the operators call a column of their own change no result."""

import inspect
import re
import sys

import pytest

import corpus_pipeline
from custodia.llm import (
    byte_pairs,
    collocations,
    common,
    components,
    fingerprints,
    jaccard_join,
    licenses,
    line_rules,
    mixing,
    packing,
    periodic_runs,
    quality_ranker,
    secrets,
    token_counts,
    url_filter,
)
from custodia.llm.queries import QUERIES, vocabulary
from tests.llm.helpers import ROWS, documents

MODULES = (
    byte_pairs, collocations, common, components, fingerprints, jaccard_join, licenses, line_rules, mixing, packing,
    periodic_runs, quality_ranker, secrets, token_counts, url_filter, sys.modules[QUERIES["op11_maximal_pair_runs"].__module__],
)
OWN = {"doc_id", "text", "lang", "source", "n_chars", "page_id", "url", "html", "label", "quality", "toxic"}


def names():
    """Every word that stands quoted, or as an alias in SQL, in the sources of the operators."""
    found = set()
    for module in MODULES:
        source = inspect.getsource(module)
        found |= set(re.findall(r"""["'`]([A-Za-z_][A-Za-z0-9_]{0,30})["'`]""", source))
        found |= set(re.findall(r"\\bAS ([a-z_][a-z0-9_]*)", source))
        for text in re.findall(r'"([a-z_0-9 ,<>:]+)"', source):  # schemas
            found |= set(re.findall(r"([a-z_][a-z0-9_]*):? (?:long|string|int|double|binary|boolean|array)", text))
    return sorted({n.lower() for n in found} - OWN)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("clash").alias(n) for n in names()])


def test_there_are_many_names():
    assert len(names()) > 150 and {"mix_name", "join_id", "text_key", "band", "mix_cdf", "word"} <= set(names())


OPERATORS = {
    "fingerprints": lambda df: fingerprints.fingerprint_documents(df),
    "secrets": lambda df: secrets.scan_secrets(df),
    "redacted": lambda df: secrets.redacted(df).select(*sorted(OWN & set(df.columns))),
    "jaccard": lambda df: jaccard_join.jaccard_components(df).drop("text_key", "group_key"),
    "first_of_each": lambda df: jaccard_join.first_of_each(df).select(*sorted(OWN & set(df.columns))),
    "licenses": lambda df: licenses.scan_licenses(df),
    "lines": lambda df: line_rules.judge_lines(df),
    "cleaned": lambda df: line_rules.cleaned_documents(df).select(*sorted(OWN & set(df.columns))),
    "mixing": lambda df: mixing.poisson_mix(df, 0.5).select(*sorted(OWN & set(df.columns)), "copy"),
    "packing": lambda df: packing.pack_documents(df.coalesce(1), *vocabulary()),
    "tokens": lambda df: token_counts.count_tokens(df, *vocabulary()),
    "runs": lambda df: periodic_runs.periodic_runs(df),
    "collocations": lambda df: collocations.mine_collocations(df, bucket_bits=16, least=3),
    "byte_pairs": lambda df: byte_pairs.encode_documents(df, vocabulary()[1]),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_same_result_beside_any_column(spark, name):
    rows = [r for i, r in enumerate(ROWS) if r[0] != 10 or i % 2]  # one row per id, so that order is settled
    plain, clashing = (
        sorted(map(repr, OPERATORS[name](df).collect())) for df in (documents(spark, rows), with_clashes(documents(spark, rows)))
    )
    assert plain == clashing


def test_ranker_beside_any_column(spark):
    labels = spark.createDataFrame([(1, 1, 0), (13, 0, 0), (5, 1, 0), (6, 1, 0), (12, 0, 1)], "doc_id long, quality int, toxic int")
    plain = sorted(map(repr, quality_ranker.rank_quality(documents(spark), labels).collect()))
    assert sorted(map(repr, quality_ranker.rank_quality(with_clashes(documents(spark)), with_clashes(labels)).collect())) == plain


def test_urls_beside_any_column(spark):
    from custodia.llm.queries import url_rules

    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None), (3, "https://www.example.org/es/y?z"), (None, "x")], "page_id long, url string")
    plain = sorted(map(repr, url_filter.judge_urls(pages, url_rules(spark)).collect()))
    assert sorted(map(repr, url_filter.judge_urls(with_clashes(pages), url_rules(spark)).collect())) == plain


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_beside_any_column(spark, base, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = [r for i, r in enumerate(ROWS) if r[0] != 10 or i % 2]
    plain, clashing = (sorted(map(repr, stage(spark, df.coalesce(1), base).collect())) for df in (documents(spark, rows), with_clashes(documents(spark, rows))))
    assert plain == clashing
