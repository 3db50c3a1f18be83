"""Redaction, entity inventory, sentiment and topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions import text as tx
from custodia.operators import names as nm
from custodia.operators import valence as vl
from custodia.sources import fixtures as fx
from custodia.sources.snapshots import write_snapshot
from custodia.sources.tables import read_table
from custodia.workload import duck
from custodia.workload.registry import query


@query(f"SELECT doc_id, {duck.redact('text')} AS redacted FROM documents")
def redact_full(spark: SparkSession, base: str) -> DataFrame:
    """Whole documents, all entity types."""
    return read_table(spark, base, "documents").select("doc_id", tx.redact(F.col("text")).alias("redacted"))


@query(
    f"SELECT conv_id, turn, role, {duck.redact('text')} AS redacted FROM conversations"
)
def redact_conversations(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "conversations").select(
        "conv_id", "turn", "role", tx.redact(F.col("text")).alias("redacted")
    )


@query(
    duck.with_tables(
        "feedback",
        sql=f"""SELECT o_orderkey, {duck.redact('feedback')} AS full_redaction,
    {duck.redact('feedback', ('NAME', 'EMAIL'))} AS partial_redaction FROM feedback""",
    )
)
def redact_partial(spark: SparkSession, base: str) -> DataFrame:
    """Names and e-mails only, beside the full redaction."""
    note = F.col("feedback")
    return fx.feedback(spark, base).select(
        "o_orderkey",
        tx.redact(note).alias("full_redaction"),
        tx.redact(note, ["NAME", "EMAIL"]).alias("partial_redaction"),
    )


@query(
    duck.with_tables(
        "feedback",
        sql=f"""SELECT o_orderkey, o_custkey, o_orderdate, feedback AS original_feedback, {duck.redact('feedback')} AS redacted_feedback,
    {duck.AS_OF} AS redacted_at, 'governor' AS redacted_by FROM feedback""",
    )
)
def redaction_table(spark: SparkSession, base: str) -> DataFrame:
    """Original and redacted text with provenance, for all orders: stored, and read again."""
    redacted = fx.feedback(spark, base).select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        F.col("feedback").alias("original_feedback"),
        tx.redact(F.col("feedback")).alias("redacted_feedback"),
        fx.as_of().alias("redacted_at"),
        F.lit("governor").alias("redacted_by"),
    )
    return write_snapshot(redacted, "redaction-table")


def _learned_sql(rounds: int = 3, least: float = 0.5) -> str:
    """Name parts of the notes, counted position by position."""
    q = lambda pattern: pattern.replace("'", "''")
    capital, lower = f"regexp_matches({{0}}, '{q(nm.CAPITALISED)}')", f"regexp_matches({{0}}, '{q(nm.LOWER)}')"
    titles = duck.names(nm.HONORIFICS)
    steps = [
        f"""toks AS (SELECT regexp_extract_all(feedback, '{q(nm.TOKEN)}') AS t FROM feedback),
    tok AS (SELECT t[i] AS word, CASE WHEN i > 1 THEN t[i - 1] END AS b, CASE WHEN i > 2 THEN t[i - 2] END AS bb, t[i + 1] AS a, i
      FROM (SELECT t, unnest(range(1, len(t) + 1)) AS i FROM toks)),
    marked AS (SELECT *, {capital.format('word')} AND word NOT IN {titles} AS cap,
      coalesce(b IN {titles} OR (b = '.' AND bb IN {titles}), FALSE) AS title FROM tok),
    occ AS (SELECT word, CASE WHEN b NOT IN {titles} AND ({capital.format('b')} OR {lower.format('b')}) THEN b END AS before,
      CASE WHEN {capital.format('a')} OR {lower.format('a')} THEN a END AS after, title AS titled,
      NOT title AND (i = 1 OR coalesce(regexp_matches(b, '{nm.SENTENCE_END}'), FALSE)) AS start FROM marked WHERE cap),
    lows AS (SELECT word, count(*) AS low FROM tok WHERE {lower.format('word')} GROUP BY 1),
    spelled AS (SELECT occ.word, count(*) AS caps, count(*) FILTER (NOT start) AS mid, count(*) FILTER (titled) AS titled_n,
      coalesce(any_value(low), 0) AS low FROM occ LEFT JOIN lows ON lower(occ.word) = lows.word GROUP BY 1),
    known0 AS (SELECT word, 1.0::DOUBLE AS score FROM spelled WHERE titled_n > 0 AND mid >= 9 * low)"""
    ]
    for r in range(rounds):
        for side in ("before", "after"):
            steps.append(
                f"""{side}{r} AS (SELECT {side} AS c, count(k.word)::DOUBLE / (count(*) + 2) AS share FROM occ LEFT JOIN known{r} k USING (word)
      WHERE {lower.format(side)} GROUP BY 1 HAVING count(k.word) > 0)"""
            )
        steps.append(
            f"""sums{r} AS (SELECT occ.word, count(*) FILTER (kb.word IS NOT NULL OR ka.word IS NOT NULL) AS beside_n,
      count(DISTINCT coalesce(kb.word, ka.word)) AS neighbours, count(*) FILTER (NOT start AND NOT titled) AS placed_n,
      coalesce(sum(greatest(coalesce(b.share, 0), coalesce(a.share, 0))) FILTER (NOT start AND NOT titled), 0)::DOUBLE AS context
      FROM occ LEFT JOIN known{r} kb ON kb.word = before LEFT JOIN known{r} ka ON ka.word = after
      LEFT JOIN before{r} b ON b.c = before LEFT JOIN after{r} a ON a.c = after GROUP BY 1),
    usual{r} AS (SELECT sum(context) / sum(placed_n) AS u FROM sums{r} WHERE word IN (SELECT word FROM known{r})),
    scored{r} AS (SELECT word, CASE WHEN mid > 0 THEN mid::DOUBLE / (mid + low) WHEN neighbours >= 3 AND beside_n >= 0.9 * caps
        THEN caps::DOUBLE / (caps + low) ELSE 0 END * (1 - (1 - titled_n::DOUBLE / caps) * (1 - beside_n::DOUBLE / caps)
        * (1 - CASE WHEN u > 0 THEN least(context / (placed_n + 1) / u, 1.0::DOUBLE) ELSE 0 END)) AS score FROM spelled JOIN sums{r} USING (word), usual{r}),
    known{r + 1} AS (SELECT word, max(score) AS score FROM (SELECT * FROM scored{r} WHERE score >= {least} UNION ALL SELECT * FROM known0) GROUP BY 1)"""
        )
    return "WITH " + ",\n    ".join(steps) + f",\n    parts AS (SELECT * FROM known{rounds}) "


@query(duck.with_tables("feedback", sql=_learned_sql() + "SELECT word, round(score, 6) AS score FROM parts"))
def learned_names(spark: SparkSession, base: str) -> DataFrame:
    """Name parts that the notes give away by titles, company and context."""
    return nm.name_parts(fx.feedback(spark, base), "feedback").select("word", F.round("score", 6).alias("score"))


_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ''-"


@query(
    duck.with_tables(
        "feedback",
        sql=_learned_sql()
        + f"""SELECT o_orderkey, regexp_replace(feedback, '(^|[^{_LETTERS}])(?:(?:{'|'.join(nm.HONORIFICS)})[.]? )?(?:' || names || ')(?: (?:' || names || '))*',
      '\\1[NAME]', 'g') AS redacted FROM feedback, (SELECT string_agg(word, '|' ORDER BY word DESC) AS names FROM parts)""",
    )
)
def redact_learned_names(spark: SparkSession, base: str) -> DataFrame:
    """The notes without names, none of which is taken from a list."""
    notes = fx.feedback(spark, base).select("o_orderkey", F.col("feedback").alias("redacted"))
    return nm.redact_names(notes, "redacted", nm.name_parts(notes, "redacted"))


_INVENTORY = ", ".join(f"{duck.entity_count('text', e)} AS {e}" for e in tx.LABELS)


@query(
    f"""SELECT source, entity, sum(n)::BIGINT AS occurrences, count(CASE WHEN n > 0 THEN 1 END) AS documents
    FROM (UNPIVOT (SELECT doc_id, source, {_INVENTORY} FROM documents) ON {', '.join(tx.LABELS)} INTO NAME entity VALUE n)
    GROUP BY source, entity"""
)
def pii_inventory(spark: SparkSession, base: str) -> DataFrame:
    """Occurrences per entity type and source; each task sums before the shuffle."""
    counted = read_table(spark, base, "documents").select("source", *tx.entity_counts(F.col("text")))
    sums = []
    for label in tx.LABELS:
        sums += [F.sum(label).alias(label), F.count_if(F.col(label) > 0).alias(f"{label}_documents")]
    per_source = counted.groupBy("source").agg(*sums)
    entries = F.array(
        *[
            F.struct(F.lit(e).alias("entity"), F.col(e).alias("occurrences"), F.col(f"{e}_documents").alias("documents"))
            for e in tx.LABELS
        ]
    )
    return per_source.select("source", F.inline(entries))


@query(
    duck.with_tables(
        "feedback",
        sql=f"""SELECT o_orderkey, score AS sentiment_score, {duck.label('score', 0.5)} AS sentiment_category FROM (
    SELECT o_orderkey, {duck.sentiment('feedback')} AS score FROM feedback)""",
    )
)
def sentiment_rows(spark: SparkSession, base: str) -> DataFrame:
    """Scored on the redacted text; the check scores the original, which must not differ."""
    scored = fx.feedback(spark, base).select(
        "o_orderkey", tx.sentiment(tx.redact(F.col("feedback"))).alias("sentiment_score")
    )
    return scored.withColumn("sentiment_category", tx.sentiment_label(F.col("sentiment_score"), 0.5))


def _scored_sql(text: str) -> str:
    """The score of one text column ``note`` per ``k``, word by word."""
    times = " ".join(f"WHEN '{w}' THEN {vl.TURN}::DOUBLE" for w in map(lambda w: w.replace("'", "''"), vl.NEGATIONS))
    times += " " + " ".join(f"WHEN '{w}' THEN {x}::DOUBLE" for w, x in vl.DEGREES)
    factor = "1.0::DOUBLE"
    for back in range(vl.WINDOW, 0, -1):
        word = f"w[i - {back}]"
        factor = f"CASE WHEN i <= {back} THEN {factor} WHEN regexp_matches({word}, '{vl._MARK}') THEN 1.0::DOUBLE ELSE {factor} * (CASE {word} {times} ELSE 1.0::DOUBLE END) END"
    words = vl._WORD.replace("'", "''")
    listed = ", ".join([f"('{w}', 1.0::DOUBLE)" for w in tx.POSITIVE] + [f"('{w}', -1.0::DOUBLE)" for w in tx.NEGATIVE])
    return f"""v(word, valence) AS (VALUES {listed}),
    ws AS (SELECT o_orderkey AS k, regexp_extract_all(lower(regexp_replace({text}, '\\[[A-Z_]+\\]', ' ', 'g')), '{words}') AS w FROM feedback),
    hits AS (SELECT k, valence * ({factor}) AS x FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM ws) JOIN v ON word = w[i]),
    totals AS (SELECT k, sum(x) AS t FROM hits GROUP BY k)"""


@query(
    duck.with_tables(
        "feedback",
        sql=f"""WITH {_scored_sql(duck.redact('feedback'))} SELECT o_orderkey, round(coalesce(t, 0) / sqrt(coalesce(t, 0) * coalesce(t, 0) + 4), 4) AS sentiment
    FROM feedback LEFT JOIN totals ON k = o_orderkey""",
    )
)
def sentiment_scored(spark: SparkSession, base: str) -> DataFrame:
    """With negation and degree, from a table of valences."""
    notes = fx.feedback(spark, base).select("o_orderkey", "feedback")
    return vl.score_texts(notes, "feedback", vl.seed_table(spark)).select("o_orderkey", "sentiment")


@query("SELECT count(*) AS notes, 0::BIGINT AS differing FROM orders")
def sentiment_scored_invariance(spark: SparkSession, base: str) -> DataFrame:
    """Redaction must not move a scored sentiment either."""
    notes = fx.feedback(spark, base).select("feedback", tx.redact(F.col("feedback")).alias("hidden"))
    table = vl.seed_table(spark)
    both = vl.score_texts(vl.score_texts(notes, "feedback", table, "original"), "hidden", table, "redacted")
    return both.agg(
        F.count(F.lit(1)).alias("notes"), F.count_if(F.col("original") != F.col("redacted")).alias("differing")
    )


@query(f"SELECT doc_id, {duck.sentiment('text')} AS sentiment_score FROM documents")
def sentiment_documents(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "documents").select("doc_id", tx.sentiment(F.col("text")).alias("sentiment_score"))


@query(duck.with_tables("feedback", sql=f"SELECT o_orderkey, {duck.topic('feedback')} AS topic FROM feedback"))
def topic_rules(spark: SparkSession, base: str) -> DataFrame:
    return fx.feedback(spark, base).select("o_orderkey", tx.topic(F.col("feedback")).alias("topic"))


@query(
    duck.with_tables(
        "feedback",
        sql=f"""SELECT topic, feedback_count, avg_sentiment, {duck.label('avg_sentiment', 0.3)} AS sentiment_label FROM (
      SELECT topic, count(*) AS feedback_count, round(avg(score), 4) AS avg_sentiment FROM (
        SELECT {duck.topic('feedback')} AS topic, {duck.sentiment('feedback')} AS score FROM feedback
        WHERE trim(feedback) <> '') GROUP BY topic)""",
    )
)
def topic_report(spark: SparkSession, base: str) -> DataFrame:
    """Notes without content are left out."""
    written = fx.feedback(spark, base).filter(F.trim("feedback") != "")
    redacted = written.select(tx.redact(F.col("feedback")).alias("t"))
    report = (
        redacted.select(tx.topic(F.col("t")).alias("topic"), tx.sentiment(F.col("t")).alias("score"))
        .groupBy("topic")
        .agg(F.count(F.lit(1)).alias("feedback_count"), F.round(F.avg("score"), 4).alias("avg_sentiment"))
    )
    return report.withColumn("sentiment_label", tx.sentiment_label(F.col("avg_sentiment"), 0.3)).orderBy(
        F.desc("feedback_count")
    )


@query("SELECT count(*) AS notes, 0::BIGINT AS differing FROM orders")
def sentiment_invariance(spark: SparkSession, base: str) -> DataFrame:
    """Redaction must not move a score."""
    note = F.col("feedback")
    both = fx.feedback(spark, base).select(
        tx.sentiment(note).alias("original"), tx.sentiment(tx.redact(note)).alias("redacted")
    )
    return both.agg(
        F.count(F.lit(1)).alias("notes"), F.count_if(F.col("original") != F.col("redacted")).alias("differing")
    )
