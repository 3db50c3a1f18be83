"""Periodic runs against a brute-force search over all periods, and the query against its contract in plain Python."""

import hashlib
import random
import zlib

from custodia.llm.periodic_runs import find_runs, periodic_runs, runs_of
from custodia.llm.queries import QUERIES
from tests.llm.helpers import ROWS, clashing, documents, rows


def brute_runs(words, least=12):
    """Maximal stretches for every period; the smallest period of equal stretches counts."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        i = 0
        while i + period < len(words):
            start = i
            while i + period < len(words) and words[i] == words[i + period]:
                i += 1
            length = i - start + period
            if i > start and length >= max(least, 2 * period):
                found.setdefault((start, length), period)
            i += 1
    return sorted((start, length, period) for (start, length), period in found.items())


def brute_collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return (text or "").encode().split()


def test_random_words():
    pick = random.Random(5)
    for _ in range(3000):
        kinds, n = pick.choice([1, 2, 3, 6, 40]), pick.randrange(100)
        words = [b"w%d" % pick.randrange(kinds) for _ in range(n)]
        if n and pick.random() < 0.6:
            start = pick.randrange(n)
            period = pick.randrange(1, max(2, (n - start) // 2 + 1))
            words = [words[i] if i < start else words[start + (i - start) % period] for i in range(n)]
        least = pick.choice([2, 7, 12])
        assert runs_of(b" ".join(words), words, least) == brute_runs(words, least)


def test_long_texts_stay_cheap():
    import time

    import numpy as np

    one, two = [0], [0, 1]
    while len(two) < 30_000:
        one, two = two, two + one
    far = [x for i in range(8_000) for x in (1, 2, 3, 4, 5, 6, 7 + i)]
    start = time.perf_counter()
    assert find_runs(np.zeros(100_000, np.int64)) == [(0, 100_000, 1)]
    assert len(find_runs(np.array(two))) > 5_000
    assert find_runs(np.array(far)) == []  # one phrase thousands of times, never close
    assert time.perf_counter() - start < 20


def test_awkward_rows(spark):
    extra = [(20, "A b\tc " * 7 + "d", "en", "a", 1), (21, "a a a a a a a a a a a", "en", "a", 1), (21, "x " * 12, "en", "a", 1)]
    df = clashing(documents(spark, [*ROWS, *extra]), "runs", "n_words", "collapsed")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(df).collect()]
    want = []
    for r in [*ROWS, *extra]:
        words = [w.decode() for w in split(r[1])]
        runs = brute_runs(words) if len(words) < 5000 else []
        want.append((r[0], len(words), runs, brute_collapsed(words, runs)))
    long = [w for w in want if w[1] >= 5000]
    assert all(x[:2] in [w[:2] for w in long] for x in got if x[1] >= 5000)
    assert sorted((x for x in got if x[1] < 5000), key=repr) == sorted((w for w in want if w[1] < 5000), key=repr)
    assert [w[2] for w in want if w[0] == 20] == [[(0, 21, 3)]]
    assert periodic_runs(documents(spark, [])).count() == 0


def test_query(spark, base):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want, with_runs = [], 0
    for r in spark.read.parquet(f"{base}/documents.parquet").collect():
        words = [w.decode() for w in split(r.text)]
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 4000:
            continue  # too slow for the search; the random words cover the rule
        runs = brute_runs(words)
        with_runs += bool(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want.append((r.doc_id, len(runs), *longest, digest(lines), digest(brute_collapsed(words, runs))))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    checked = {w[0] for w in want}
    got = QUERIES["op11_maximal_pair_runs"](spark, base)
    assert [x for x in rows(got, *names) if x[0] in checked] == sorted(want, key=repr)
    assert with_runs > 10


def test_query_on_awkward_rows(spark, tmp_path):
    documents(spark, [*ROWS, (41, "tail " * 30, "en", "a", 1)]).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op11_maximal_pair_runs"](spark, str(tmp_path)).count() == len(ROWS) + 1
