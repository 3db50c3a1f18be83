"""Quality rules by cross-document line frequency.

Lines are normalised (A-Z lowered, white space collapsed) and hashed. For every host the distinct documents
that hold a line are counted; lines in more than ``share`` of the host's documents, and in more than ``few``
(a line of that few documents is no habit of the host), are boilerplate and taken out: the same rule at every size.
A document that loses more than ``depleted`` of its words by that is rejected, besides those that fail the
per-document rules.

* Distinct documents are distinct texts: copies of a document do not make its lines frequent. A text without a line
  of words is a document of its host like any other.
* Texts are read once; what is stored per document are numbers and line hashes. Counting goes through
  (host, line, document) rows without texts, so a line in a third of all documents is summed per task first.
* A host has at most (lines per document) / ``share`` frequent lines, however large it grows.
* Null text: no words; it fails. Null source: one host without a name, as is the empty name. Rows alike in
  every column are judged alike and all returned. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import WordHashes, in_python, stored, windows

SYMBOLS = b"#*$%&|<>"
WINDOW = 8

_NAMES = ["doc_id", "host", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"]
_SCHEMA = (
    "doc_id long, host string, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, lines array<struct<line: long, words: long>>"
)
_LINES = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))
_ROWS_OUT = 2_000


def repeated_words(hashes: np.ndarray, width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more, the first included."""
    n = len(hashes)
    if n <= width:
        return 0
    keys = windows(hashes, width)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return 0
    starts = np.union1d(order[1:][same], order[:-1][same])
    depth = np.zeros(n + 1, np.int64)
    depth[starts] += 1
    np.subtract.at(depth, starts + width, 1)
    return int((np.cumsum(depth[:-1]) > 0).sum())


def line_key(line: Column) -> Column:
    """The hash that the Python side computes, as a column."""
    lowered = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.xxhash64(F.trim(F.regexp_replace(lowered, r"[\x20\x09-\x0D]+", " ")))


def measured(documents: DataFrame) -> DataFrame:
    """Word, symbol, line and repetition counts of every whole text, and its distinct lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        hashes = WordHashes()
        out: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            types = [pa.int64(), pa.string(), *[pa.int64()] * 6, _LINES]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], _NAMES)
            out.clear()
            return batch

        def signed(value: int) -> int:
            return value - (1 << 64) if value >> 63 else value

        for batch in batches:
            for doc_id, host, key, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                raw = text.encode()
                words = raw.split()
                space = len(raw) - sum(map(len, words))
                seen: set[bytes] = set()
                repeated = 0
                lines: dict[int, int] = {}
                for line in raw.split(b"\n"):
                    parts = line.split()
                    if not parts:
                        continue
                    if line in seen:
                        repeated += 1
                    seen.add(line)
                    name = signed(xxh64_intdigest(b" ".join(parts).lower(), 42))
                    lines[name] = lines.get(name, 0) + len(parts)
                out.append(
                    (
                        doc_id,
                        host,
                        key,
                        len(words),
                        len(text) - space,
                        len(raw) - len(raw.translate(None, SYMBOLS)),
                        repeated,
                        repeated_words(hashes.of(words)),
                        [{"line": k, "words": n} for k, n in lines.items()],
                    )
                )
                if len(out) >= _ROWS_OUT:
                    yield flushed()
        if out:
            yield flushed()

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("host"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return in_python(texts.select("doc_id", "host", F.xxhash64("text").alias("text_key"), "text"), run, _SCHEMA)


def frequent_lines(lines: DataFrame, documents: DataFrame, few: int, share: float) -> DataFrame:
    """(host, line) above the limits; one row per host, distinct document and line, and per host and distinct document."""
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("holders")).where(f"holders > {few}")
    sizes = documents.groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    limit = F.lit(float(share)) * F.col("documents")
    return counts.join(sizes, "host").where(F.col("holders") > limit).select("host", "line", "holders")


def _judged(
    documents: DataFrame,
    few: int = 3,
    share: float = 0.05,
    depleted: float = 0.8,
    min_words: int = 20,
    max_repeated: int = 30,
) -> DataFrame:
    """Counts and verdict of every document, and which of its lines are frequent (null if none is)."""
    base = stored(measured(documents), "line-counts")
    distinct = base.groupBy("host", "text_key").agg(F.first("lines").alias("lines"))
    lines = distinct.select("host", "text_key", F.inline("lines"))
    frequent = frequent_lines(lines, distinct, few, share)
    removed = (
        lines.join(frequent.select("host", "line"), ["host", "line"])
        .groupBy("host", "text_key")
        .agg(F.sum("words").alias("removed_words"), F.collect_list("line").alias("removed_lines"))
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    lost = F.col("removed_words") > F.lit(depleted) * F.col("n_words")
    return (
        base.drop("lines")
        .join(removed, ["host", "text_key"], "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            failed.alias("base_failed"),
            (~failed & ~lost).alias("kept"),
            "removed_words",
            "host",
            "text_key",
            "removed_lines",
        )
    )


def judge_lines(documents: DataFrame, **limits) -> DataFrame:
    """Counts and verdict of every document, with ``removed_words``: its words in frequent lines; ``limits`` as of ``_judged``."""
    return _judged(documents, **limits).drop("removed_lines")


def cleaned_documents(documents: DataFrame, **limits) -> DataFrame:
    """The documents that pass, without their frequent lines; ``n_chars`` is counted anew where lines went.

    One row per distinct text that fails or loses lines meets the documents; ``limits`` as of ``judge_lines``.
    """
    judged = _judged(documents, **limits).where(~F.col("kept") | F.col("removed_lines").isNotNull())
    touched = judged.groupBy("host", "text_key").agg(
        F.first("kept").alias("judged_kept"),
        F.first("removed_lines").alias("judged_lines"),
    )
    touched = touched.withColumnsRenamed({"host": "judged_host", "text_key": "judged_text"})
    same = (F.coalesce(documents["source"], F.lit("")) == touched["judged_host"]) & (
        F.xxhash64(F.coalesce(documents["text"], F.lit(""))) == touched["judged_text"]
    )
    joined = documents.join(touched, same, "left").where(F.coalesce(touched["judged_kept"], F.lit(True)))
    hit = touched["judged_lines"].isNotNull()
    left = F.filter(
        F.split(documents["text"], "\n"), lambda line: ~F.array_contains(touched["judged_lines"], line_key(line))
    )
    text = F.when(hit, F.array_join(left, "\n")).otherwise(documents["text"])
    changed = {"text": text}
    if "n_chars" in documents.columns:
        changed["n_chars"] = F.when(hit, F.length(text).cast("long")).otherwise(documents["n_chars"])
    return joined.select(*[changed[c].alias(c) if c in changed else documents[c] for c in documents.columns])
