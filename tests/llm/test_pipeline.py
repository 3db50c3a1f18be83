"""Every stage of the pipeline against a plain version of what it must do to its input."""

from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.helpers import ROWS, clashing, documents
from tests.llm.test_jaccard import brute
from tests.llm.test_quality import frequent_lines, judged, normal
from tests.llm.test_tokens import check_pieces, encoded, library  # noqa: F401

STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def table(spark, base):
    return spark.read.parquet(f"{base}/documents.parquet")


def stored(df, tmp):
    df.write.parquet(str(tmp))
    return df.sparkSession.read.parquet(str(tmp))


def test_quality_stage(spark):
    base = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{base}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in table.collect()]
    short = [(r[0], r[1], r[3]) for r in rows]
    kept, frequent = {j[0] for j in judged(short) if j[7]}, frequent_lines(short, 3, 0.05)

    def plain(doc_id, text, lang, source, n_chars):
        left = "\n".join(x for x in text.split("\n") if normal(x) not in frequent[source])
        return (doc_id, left, lang, source, n_chars if left == text else len(left))

    got = sorted(tuple(r) for r in STAGE["quality_rules"](spark, table, base).collect())
    assert got == sorted(plain(*r) for r in rows if r[0] in kept)
    assert sum(plain(*r)[1] != r[1] for r in rows if r[0] in kept) > 50


def test_quality_stage_takes_frequent_lines_out(spark, base):
    footer = "Terms and  PRIVACY of this site"
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    rows = [(i, f"{body(i)}\n{footer if i % 2 else footer.lower()}\n\nlast {i}", "en", "h", 7) for i in range(130)]
    rows += [(500, f"{body(500)}\n{footer}", "en", "g", 7), (501, f"{footer} {body(501)}", "en", "h", 7)]
    rows += [(502, f"{footer}\n" * 3 + "few words", "en", "h", 7), (503, rows[3][1], "fr", "h", 7), (504, None, "en", "h", 7)]
    kept = {j[0] for j in judged([(r[0], r[1], r[3]) for r in rows]) if j[7]}

    def plain(doc_id, text, lang, source, n_chars):
        lines = [x for x in text.split("\n") if source != "h" or normal(x) != normal(footer)]
        return (doc_id, "\n".join(lines), lang, source, n_chars if "\n".join(lines) == text else len("\n".join(lines)))

    got = sorted(tuple(r) for r in STAGE["quality_rules"](spark, documents(spark, rows), base).collect())
    assert got == sorted(plain(*r) for r in rows if r[0] in kept)
    assert {500, 501, 503} <= kept and not kept & {502, 504}


def test_duplicate_stage(spark, base, table):
    rows = table.collect()
    firsts = {d for d, n, c in brute([(r.doc_id, r.text) for r in rows]) if d == c}
    got = STAGE["near_duplicates"](spark, table, base).collect()
    assert sorted(got) == sorted(r for r in rows if r.doc_id in firsts)


def test_secret_stage(spark):
    from tests.llm.test_secrets import base_spans

    base = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{base}/documents.parquet")
    got = {r.doc_id: r for r in STAGE["secret_scans"](spark, table, base).collect()}
    hits = 0
    for r in table.collect():
        spans = base_spans(r.text)
        hits += bool(spans)
        assert got[r.doc_id].n_chars == len(got[r.doc_id].text)
        assert (got[r.doc_id].text != r.text) if spans else (got[r.doc_id].text == r.text)
        assert not base_spans(got[r.doc_id].text)
    assert hits


def test_mixing_stage(spark, base, table):
    from custodia.llm.mixing import repetition_rates
    from tests.llm.test_mixing import drawn

    rates = {r.mix_source: r.rate for r in repetition_rates(table, 0.7).collect()}
    got = Counter(STAGE["source_mixing"](spark, table, base).collect())
    assert got == Counter({r: k for r in table.collect() if (k := drawn(str(r.doc_id), rates[r.source]))})


def test_whole_run(spark, base, table, library, tmp_path):  # noqa: F811
    docs = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, base), tmp_path / name)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
    last = docs.collect()
    pieces = corpus_pipeline.run(spark, base).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in last}
    tokens = Counter()
    for p in pieces:
        tokens[p.doc_id] += p.length
    want = Counter()
    for r in last:
        want[r.doc_id] += len(encoded(library, r.text)) + 1
    assert tokens == want


@pytest.mark.parametrize("name", list(STAGE))
def test_awkward_rows(spark, base, name):
    for rows in (ROWS, []):
        df = clashing(documents(spark, rows), "host", "copy", "k1", "kept")
        got = STAGE[name](spark, df, base)
        if name != "packing":
            assert got.columns == list(corpus_pipeline.COLUMNS)
        assert got.count() >= (1 if rows else 0)
