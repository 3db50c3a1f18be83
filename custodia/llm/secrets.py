"""Secret scans: three base patterns and a randomness test battery for everything else.

Base spans are the matches of ``BASE``. The method looks at every other long run of key characters, which ``=`` ends
unless it pads the run, infers its encoding (the smallest alphabet that holds it) and tests the symbols. A run that mixes
``+/`` with ``-_`` fits no alphabet; its longest parts in base64 and in base64url are tested instead, and
overlapping parts that are secrets make one span:

* chi-squared uniformity over the alphabet, the number of runs above and below the alphabet's middle, and the
  lag-1 serial correlation; a run of which any test rejects randomness (Bonferroni at ``alpha``) is no secret;
* the same chi-squared statistic against ordinary text, whose letters repeat more often, times the chance that text
  stays inside a hexadecimal alphabet or holds so many digits. These p-values face a false-discovery
  control (Benjamini-Hochberg at ``rate``) within each class of lengths, over the candidates of the whole corpus.

All native. Positions come from the gaps between matches (``split``) and the matches themselves, so they are code
points; running sums and maxima over a text's matches are built by doubling steps, so a text with very many of them costs
n log n. Texts without the marks of a pattern skip it. Texts are read once: spans and tested candidates are stored with
what the caller needs of a document, and the corpus control is one histogram over them of at most 4 x 4,001 cells.
Null text: empty. Repeated rows and null ids are scanned and returned as they are; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import let, stored

#: Kind, pattern, group whose length counts, least length.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),  # as AKIA[A-Z0-9]+ of that length: a later start in a run is shorter
    ("hex", r"[0-9a-f]{32,}", 0, 32),  # runs are maximal, so short ones need not be matched to be dropped
)
#: What a text must hold for a pattern to match with the least length; cheap to look for.
_GATES = {
    "assign": r"""[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}""",
    "access": r"AKIA[A-Z0-9]{12}",
    "hex": r"[0-9a-f]{32}",
}
RANDOM = "random"
BASE_SPANS, ADDED_SPANS = "base_spans", "added_spans"
_PAD = r"(?:=+(?![A-Za-z0-9+/_=-]))?"
_RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}" + _PAD
_MIXED = r"[+/].*[_-]|[_-].*[+/]"
_PARTS = (r"[A-Za-z0-9+/]{20,}" + _PAD, r"[A-Za-z0-9_-]{20,}" + _PAD)
#: Letter coincidence of ordinary prose, its third moment, share of digits, and of a-f among letters.
_PAIRS, _TRIPLES, _DIGIT_SHARE, _HEX_SHARE = 0.0655, 0.0055, 0.02, 0.35
#: Encodings from the smallest alphabet up; the first that holds the run is taken. Decimal runs are numbers, not keys.
ENCODINGS = (
    ("decimal", r"^[0-9]+$", "0123456789"),
    ("hex", r"^(?=.*[0-9])[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", r"^(?=.*[0-9])[0-9A-F]+$", "0123456789ABCDEF"),
    ("lower", r"^[a-z]+$", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", r"^[A-Z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower36", r"^[a-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("upper36", r"^[A-Z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", r"^[A-Za-z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", r"^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", r"^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
#: Lower ends of the length classes.
LENGTHS = (20, 28, 40, 64)
_CELLS = 4000


def running(values: Column, combine) -> Column:
    """``combine`` over every value and all before it: distances 1, 2, 4, ... are taken in one after another."""
    rounds = F.when(F.size(values) > 1, F.ceil(F.log2(F.size(values).cast("double"))).cast("int")).otherwise(0)

    def doubled(x: Column, step: Column) -> Column:
        return F.transform(
            x, lambda v, i: F.when(i >= step, combine(v, F.get(x, (i - step).cast("int")))).otherwise(v)
        )

    steps = F.transform(
        F.slice(F.sequence(F.lit(0), rounds), F.lit(1), rounds), lambda r: F.pow(F.lit(2.0), r.cast("double")).cast("int")
    )
    return F.aggregate(steps, values, doubled)


def located(text: Column, pattern: str) -> Column:
    """(start, end, token) of all leftmost non-overlapping matches, in code points."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(gap: Column, tokens: Column) -> Column:
        ends = running(F.transform(tokens, lambda t, i: F.get(gap, i) + F.length(t)), lambda v, before: v + before)
        return let(
            ends,
            lambda e: F.transform(
                tokens,
                lambda t, i: F.struct(
                    (F.get(e, i) - F.length(t)).alias("start"), F.get(e, i).alias("end"), t.alias("token")
                ),
            ),
        )

    return let(gaps, lambda g: let(found, lambda t: placed(g, t)))


def base_spans(text: Column) -> Column:
    """All base spans of a text by start, then kind as listed."""
    parts = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        spans = located(text, pattern)
        if group:
            sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda g: F.length(g))
            long_enough = let(sizes, lambda n: F.filter(spans, lambda s, i: F.get(n, i) >= least))
        else:
            long_enough = F.filter(spans, lambda s: s["end"] - s["start"] >= least)
        named = F.transform(
            long_enough,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(order).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
            ),
        )
        empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
        parts.append(F.when(text.rlike(_GATES[kind]), named).otherwise(empty))
    return F.sort_array(F.concat(*parts))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, for z from 0 (a closed form good to a few percent)."""
    positive = F.greatest(z, F.lit(0.0))
    return 0.5 * F.exp(-0.717 * positive - 0.416 * positive * positive)


def _cases(token: Column, values: list, kind: str) -> Column:
    out = F.lit(None).cast(kind)
    for (_, pattern, _), value in reversed(list(zip(ENCODINGS, values))):
        out = F.when(token.rlike(pattern), F.lit(value)).otherwise(out)
    return out.cast(kind)


def tested(span: Column) -> Column:
    """A candidate with its length class, whether it passes as random, and its cell of -10 log10 p against text."""
    token = F.regexp_replace(span["token"], "=+$", "")
    name = _cases(token, [n for n, *_ in ENCODINGS], "string")
    alphabet = _cases(token, [letters for *_, letters in ENCODINGS], "string")
    symbols = let(
        alphabet, lambda a: F.transform(F.split(token, ""), lambda c: F.instr(a, c).cast("double") - 1.0)
    )

    def battery(x: Column, size: Column) -> Column:
        n = F.size(x).cast("double")
        times = F.transform(  # of every letter of the alphabet
            F.split(alphabet, ""), lambda c: (F.length(token) - F.length(F.replace(token, c, F.lit("")))).cast("double")
        )
        squares = F.aggregate(times, F.lit(0.0), lambda s, k: s + k * k)
        chi = size / n * squares - n
        uniform = (chi - (size - 1)) / F.sqrt(2 * (size - 1) * (1 - 1 / n))
        high = F.aggregate(x, F.lit(0.0), lambda s, c: s + F.when(c >= size / 2, 1.0).otherwise(0.0))
        pairs = F.slice(F.transform(x, lambda c, i: F.struct(c.alias("a"), F.get(x, i + 1).alias("b"))), F.lit(1), F.size(x) - 1)
        changes = F.aggregate(
            pairs, F.lit(0.0), lambda s, p: s + F.when((p["a"] >= size / 2) != (p["b"] >= size / 2), 1.0).otherwise(0.0)
        )
        expected = 2 * high * (n - high) / n + 1
        spread = F.sqrt(F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9)))
        runs = F.abs(changes + 1 - expected) / spread
        mean = F.aggregate(x, F.lit(0.0), lambda s, c: s + c) / n
        power = F.aggregate(x, F.lit(0.0), lambda s, c: s + (c - mean) * (c - mean))
        product = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["a"] - mean) * (p["b"] - mean))
        serial = F.abs(product / F.greatest(power, F.lit(1e-9)) + 1 / n) * F.sqrt(n)
        p_random = F.least(
            F.lit(1.0), 3 * F.least(_tail(uniform), 2 * _tail(runs), 2 * _tail(serial))
        )
        text_mean = (size - 1) + (n - 1) * (size * _PAIRS - 1)
        text_spread = F.sqrt(2 * size * size * _PAIRS**2 + 4 * n * size * size * (_TRIPLES - _PAIRS**2))
        digits = F.length(F.regexp_replace(token, "[^0-9]", "")).cast("double")
        rare = _DIGIT_SHARE * n
        log_digits = F.when(digits > rare, (digits - rare) + digits * F.log(rare / digits)).otherwise(0.0)
        log_hex = F.when(F.lower(name) == "hex", n * F.log(F.lit(_HEX_SHARE))).otherwise(log_digits)
        log_p = F.log(2 * _tail((text_mean - chi) / text_spread)) + log_hex
        cell = F.least(F.lit(_CELLS), F.greatest(F.lit(0), F.floor(-10 * log_p / F.log(F.lit(10.0))))).cast("int")
        band = sum((F.length(token) >= low).cast("int") for low in LENGTHS)
        return F.struct(
            span["start"].alias("start"),
            span["end"].alias("end"),
            band.alias("band"),
            cell.alias("cell"),
            p_random.alias("p_random"),
            name.alias("encoding"),
        )

    sizes = _cases(token, [float(len(a)) for *_, a in ENCODINGS], "double")
    return F.when(
        (name != "decimal") & (F.length(token) >= LENGTHS[0]),
        let(symbols, lambda x: let(sizes, lambda size: battery(x, size))),
    )


def parts(run: Column) -> Column:
    """The run itself, or its longest parts in either base64 alphabet if it mixes them."""

    def within(pattern: str) -> Column:
        return F.transform(
            located(run["token"], pattern),
            lambda p: F.struct(
                (run["start"] + p["start"]).alias("start"), (run["start"] + p["end"]).alias("end"), p["token"].alias("token")
            ),
        )

    return F.when(run["token"].rlike(_MIXED), F.concat(*[within(p) for p in _PARTS])).otherwise(F.array(run))


def candidates(text: Column) -> Column:
    """Tested runs of key characters; empty where a text has none."""
    runs = F.flatten(F.transform(located(text, _RUN), parts))
    found = F.filter(F.transform(runs, tested), lambda c: c.isNotNull())
    empty = F.array().cast(
        "array<struct<start:int,end:int,band:int,cell:int,p_random:double,encoding:string>>"
    )
    return F.when(text.rlike(_RUN), found).otherwise(empty)


def discovery_cells(scanned: DataFrame, rate: float) -> dict[int, int]:
    """Per length class the lowest cell that Benjamini-Hochberg accepts, over all candidates of the corpus."""
    cells = scanned.select(F.explode("candidates").alias("c")).groupBy("c.band", "c.cell").count().collect()
    lowest = {}
    for band in {r.band for r in cells}:
        own = sorted(((r.cell, r["count"]) for r in cells if r.band == band), reverse=True)
        total, seen = sum(n for _, n in own), 0
        for cell, n in own:
            seen += n
            if 10 ** (-cell / 10) <= rate * seen / total:
                lowest[band] = cell
    return lowest


def united(spans: Column) -> Column:
    """(start, end) of sorted spans, those that overlap as one."""

    def heads(sorted_spans: Column, reach: Column) -> Column:
        first = F.filter(
            F.transform(sorted_spans, lambda s, i: F.when((i == 0) | (s["start"] >= F.get(reach, i - 1)), i)),
            lambda i: i.isNotNull(),
        )
        return let(
            first,
            lambda at: F.transform(
                at,
                lambda i, k: F.struct(
                    F.get(sorted_spans, i)["start"].alias("start"),
                    F.get(reach, F.coalesce(F.get(at, k + 1), F.size(sorted_spans)) - 1).alias("end"),
                ),
            ),
        )

    return let(
        spans,
        lambda x: let(running(F.transform(x, lambda s: s["end"]), lambda v, before: F.greatest(v, before)), lambda reach: heads(x, reach)),
    )


def apart(found: Column, base: Column) -> Column:
    """Those of ``found`` that overlap nothing in ``base``; both are (start, end, ...) in any order."""
    place = lambda spans, own: F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(own).alias("own"), s["end"].alias("end"))
    )
    far = F.lit(2**31 - 1)

    def clear(both: Column) -> Column:
        ends = running(F.transform(both, lambda s: F.when(s["own"], 0).otherwise(s["end"])), lambda v, b: F.greatest(v, b))
        starts = F.reverse(
            running(
                F.reverse(F.transform(both, lambda s: F.when(s["own"], far).otherwise(s["start"]))), lambda v, b: F.least(v, b)
            )
        )
        return let(
            ends,
            lambda before: let(
                starts,
                lambda after: F.filter(
                    both, lambda s, i: s["own"] & (F.get(before, i) <= s["start"]) & (F.get(after, i) >= s["end"])
                ),
            ),
        )

    return let(F.sort_array(F.concat(place(found, True), place(base, False))), clear)  # base first where starts are equal


def secret_spans(documents: DataFrame, rate: float = 0.01, alpha: float = 0.001) -> DataFrame:
    """The documents' columns and two arrays of (start, rank, end, kind), which replace columns of their names."""
    text = F.coalesce(documents["text"], F.lit(""))
    kept = [documents[f"`{c.replace('`', '``')}`"] for c in documents.columns if c not in (BASE_SPANS, ADDED_SPANS)]
    return _settled(
        stored(documents.select(F.struct(*kept).alias("row"), base_spans(text).alias("base"), candidates(text).alias("candidates")), "spans"),
        rate,
        alpha,
    )


def _settled(scanned: DataFrame, rate: float, alpha: float) -> DataFrame:
    """row.*, base and added spans of scanned documents (row, base, candidates)."""
    lowest = discovery_cells(scanned, rate)

    def significant(c: Column) -> Column:
        least = F.lit(None).cast("int")
        for band, cell in lowest.items():
            least = F.when(c["band"] == band, F.lit(cell)).otherwise(least)
        return F.coalesce((c["cell"] >= least) & (c["p_random"] >= alpha), F.lit(False))

    added = F.transform(
        united(apart(F.filter("candidates", significant), F.col("base"))),
        lambda c: F.struct(
            c["start"].alias("start"), F.lit(len(BASE)).alias("rank"), c["end"].alias("end"), F.lit(RANDOM).alias("kind")
        ),
    )
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    added = F.when(F.size("candidates") > 0, added).otherwise(empty)
    return scanned.select("row.*", F.col("base").alias(BASE_SPANS), added.alias(ADDED_SPANS))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_secrets(documents: DataFrame, rate: float = 0.01, alpha: float = 0.001) -> DataFrame:
    """Counts and spans of every document."""
    text = F.coalesce("text", F.lit(""))
    row = F.struct(F.col("doc_id").cast("long").alias("doc_id"))
    scanned = documents.select(row.alias("row"), base_spans(text).alias("base"), candidates(text).alias("candidates"))
    found = _settled(stored(scanned, "spans"), rate, alpha)
    count = lambda kind: F.size(F.filter(BASE_SPANS, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind, *_ in BASE],
        F.sha2(listed(F.col(BASE_SPANS)).cast("binary"), 256).alias("base_sha256"),
        listed(F.sort_array(F.concat(BASE_SPANS, ADDED_SPANS))).alias("spans"),
        F.size(ADDED_SPANS).cast("long").alias(f"n_{RANDOM}"),
    )


#: Up to so many spans a text is cut by position, which is read from the start each time; beyond, it is taken apart once.
_FEW = 16


def without_spans(text: Column, spans: Column, mark: str) -> Column:
    """The text with ``mark`` for each of the spans, which are in order and do not overlap."""

    def joined(piece) -> Column:
        between = F.transform(
            spans, lambda s, i: F.when(i == 0, piece(F.lit(0), s["start"])).otherwise(piece(F.get(spans, i - 1)["end"], s["start"]))
        )
        tail = piece(F.get(spans, F.size(spans) - 1)["end"], F.length(text))
        return F.concat(F.array_join(between, mark), F.lit(mark), tail)

    by_position = joined(lambda a, b: F.substring(text, a + 1, b - a))
    apart_once = let(F.split(text, ""), lambda c: joined(lambda a, b: F.array_join(F.slice(c, a + 1, b - a), "")))
    return F.when(F.size(spans) == 0, text).when(F.size(spans) <= _FEW, by_position).otherwise(apart_once)


def redacted(documents: DataFrame, mark: str = "[SECRET]", rate: float = 0.01, alpha: float = 0.001) -> DataFrame:
    """The documents with every span replaced by ``mark`` and ``n_chars`` counted anew where that happened.

    Spans that overlap are one; equal rows are changed alike. Columns called like the two arrays of spans are dropped.
    """
    found = secret_spans(documents, rate, alpha)
    spans = F.concat(BASE_SPANS, ADDED_SPANS)
    hit = F.size(spans) > 0
    text = F.when(hit, let(united(F.sort_array(spans)), lambda s: without_spans(F.col("text"), s, mark))).otherwise(F.col("text"))
    changed = found.withColumn("text", text)
    if "n_chars" in documents.columns:
        changed = changed.withColumn(
            "n_chars", F.when(hit, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        )
    return changed.drop(BASE_SPANS, ADDED_SPANS)
