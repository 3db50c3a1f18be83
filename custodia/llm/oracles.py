"""The queries of this package that SQL can express, for DuckDB, written without the operators' methods."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


def jaccard_sql(similarity: int = 75, shingle: int = 5) -> str:
    """All pairs that share a shingle, then reachability."""
    words = _WORDS.format(f"translate(text, '{_UPPER}', '{_LOWER}')")
    return f"""WITH RECURSIVE d AS (SELECT doc_id, {words} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {shingle - 1}], ' ') AS g
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {shingle - 1}, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
              WHERE 100 * shared >= {similarity} * (x.n + y.n - shared)),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
    many AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low.b, d.doc_id)) AS component_id,
      coalesce(n_links, 0)::BIGINT AS n_links
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = d.doc_id LEFT JOIN many ON many.a = d.doc_id"""


def url_sql(rules: tuple[tuple[str, str, str], ...], default: str = "allow") -> str:
    """Every rule against every URL."""
    listed = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""WITH r(h, p, v) AS (VALUES {listed}),
    rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS t FROM pages),
    u AS (SELECT page_id, translate(regexp_extract(t, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
            regexp_extract(t, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    f AS (SELECT host, path, max((length(h || p), length(h), h || p, v)) AS best
          FROM (SELECT DISTINCT host, path FROM u) JOIN r
            ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
    SELECT page_id, host, path, best[3] AS rule, coalesce(best[4], '{default}') AS verdict FROM u LEFT JOIN f USING (host, path)"""


def lines_sql(few: int = 3, share: float = 0.05, depleted: float = 0.8, min_words: int = 20, repeated: int = 30) -> str:
    """Word windows and lines as rows."""
    line = r"trim(regexp_replace(translate(l, '{0}', '{1}'), '[\x20\x09-\x0D]+', ' ', 'g'))".format(_UPPER, _LOWER)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host, {_WORDS.format("coalesce(text, '')")} AS w
      FROM documents),
    win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) > 7)),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
    raw AS (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS l FROM d),
    lines AS (SELECT doc_id, host, text, l, {line} AS line, len({_WORDS.format('l')}) AS n FROM raw
      WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines FROM lines GROUP BY doc_id),
    size AS (SELECT host, count(DISTINCT text) AS documents FROM d GROUP BY host),
    frequent AS (SELECT host, line FROM (SELECT host, line, count(DISTINCT text) AS holders FROM lines GROUP BY host, line) JOIN size USING (host)
      WHERE holders > greatest({few}, {share} * documents)),
    removed AS (SELECT doc_id, sum(n) AS n FROM lines SEMI JOIN frequent USING (host, line) GROUP BY doc_id),
    m AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(removed.n, 0)::BIGINT AS removed_words
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN removed USING (doc_id))
    SELECT *, n_words < {min_words} OR 100 * n_repeat_words > {repeated} * n_words AS base_failed,
      NOT (n_words < {min_words} OR 100 * n_repeat_words > {repeated} * n_words) AND NOT removed_words > {depleted} * n_words AS kept FROM m"""


def mixing_sql(exponent: float = 0.7, seed: str = "mix", step: float = 64.0, terms: int = 200) -> str:
    """Cumulative probabilities as rows, counted up to each document's uniform value."""
    digest = f"substr(md5('{seed}' || name || ':' || j), 1, 13)"
    return f"""WITH RECURSIVE n AS (SELECT source, count(*) AS n, pow(count(*), {exponent}) AS w FROM documents GROUP BY source),
    r AS (SELECT source, (SELECT sum(n)::DOUBLE / sum(w) FROM n) * w / n AS rate FROM n),
    m AS (SELECT source, rate, greatest(ceil(rate / {step}), 1)::INT AS draws FROM r),
    cdf(source, k, p, c) AS (SELECT source, 0, exp(-(rate / draws)), exp(-(rate / draws)) FROM m
      UNION ALL SELECT cdf.source, k + 1, p * (rate / draws) / (k + 1), c + p * (rate / draws) / (k + 1)
      FROM cdf JOIN m ON cdf.source IS NOT DISTINCT FROM m.source WHERE k < {terms}),
    d AS (SELECT *, coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS name FROM documents),
    u AS (SELECT d.*, ((('0x' || {digest})::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
      FROM (SELECT d.*, unnest(range(1, draws + 1)) AS j FROM d JOIN m ON d.source IS NOT DISTINCT FROM m.source) d),
    counted AS (SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars, count(c) AS copies
      FROM u LEFT JOIN cdf ON u.source IS NOT DISTINCT FROM cdf.source AND c <= u AND c < 1.0 GROUP BY ALL)
    SELECT doc_id, text, lang, source, n_chars, unnest(range(1, copies + 1)) AS copy FROM counted"""


def collocations_sql(max_words: int = 3, least: int = 10, top: int = 2000, percent: int = 50) -> str:
    """Every phrase of every piece as a row."""
    pieces = r"string_split_regex(translate(coalesce(text, ''), '{0}', '{1}'), '[.,;:!?\x0A-\x0D]')".format(_UPPER, _LOWER)
    grams = " UNION ALL ".join(
        f"SELECT lang, array_to_string(w[i:i + {k - 1}], ' ') AS p, {k} AS k FROM"
        f" (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM pieces WHERE len(w) >= {k})"
        for k in range(1, max_words + 1)
    )
    return f"""WITH raw AS (SELECT coalesce(lang, 'und') AS lang, unnest({pieces}) AS piece FROM documents),
    pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM raw),
    f AS (SELECT lang, p, k, count(*) AS f FROM ({grams}) GROUP BY ALL),
    n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, p, k, f AS a, string_split(p, ' ') AS w FROM f WHERE k > 1 AND f >= {least}),
    cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
    parts AS (SELECT cuts.*, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score FROM cuts
      JOIN f x ON x.lang = cuts.lang AND x.p = array_to_string(w[1:cut], ' ')
      JOIN f y ON y.lang = cuts.lang AND y.p = array_to_string(w[cut + 1:], ' ')),
    best AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
    inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS p, max(a) AS longer
      FROM (SELECT lang, w, k, a, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY 1, 2),
    kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, p) WHERE longer IS NULL OR 100 * longer < {percent} * a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM kept)
    SELECT lang, rank, p AS phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {top}"""
