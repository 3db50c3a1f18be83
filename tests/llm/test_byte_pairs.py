"""Byte-level BPE against the public library on the same ranks."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from custodia.llm.byte_pairs import decode_documents, encode_documents, merge, vocabulary_of
from custodia.llm.queries import QUERIES
from tests.llm.helpers import ROWS, clashing, documents, rows

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(library, texts):
    state = vocabulary_of(RANKS)
    ids, offsets, counts = state.encode(texts)
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends, counts):
        mine, places = ids[end - n : end], offsets[end - n : end].astype(np.int64)
        assert mine.tolist() == library.encode_ordinary(text)
        raw = text.encode()
        assert state.decode(mine.astype(np.int64), places, len(raw)) == raw


def test_every_code_point(library):
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for k in range(0, len(points), 50_000):
        check(library, ["".join(f"a{c}1{c} {c}{c}x  " for c in points[k : k + 50_000])])


def test_random_texts(library):
    pick = random.Random(2)
    letters = list("abst'mdrvel 's  \n\t.!12é漢  \x85\x1c\U0001f600͸²")
    for _ in range(200):
        check(library, ["".join(pick.choice(letters) for _ in range(pick.randrange(200))) for _ in range(20)])
    check(library, ["", "", " ", "\n", "'s", "it's 's ''s  's\n's 'll've'r '\n\n x  y \t", "x" * 5000, "ab" * 300, " " * 4000])


def test_stretches(library, monkeypatch):
    """Scans in short stretches give the same, wherever they are cut."""
    from custodia.llm import byte_pairs

    pick = random.Random(3)
    text = "".join(pick.choice("ab's  l\n.1'll've") for _ in range(3000))
    for size in (1, 2, 3, 7, 1000):
        monkeypatch.setattr(byte_pairs, "_STRETCH", size)
        check(library, [text[: 200 * min(size, 15)], "", "it's"])


def test_long_pre_tokens_merge_alike(library):
    pick = random.Random(4)
    ranks = vocabulary_of(RANKS).pieces.ranks
    for n in (49, 60, 300, 2000):
        piece = "".join(pick.choice("abcdeth") for _ in range(n))
        assert merge(piece.encode(), ranks) == library.encode_ordinary(piece)


def test_cache_is_bounded(library, monkeypatch):
    from custodia.llm.byte_pairs import Pieces

    monkeypatch.setattr(Pieces, "LIMIT", 3)
    check(library, ["one two three four five six seven eight one two"])
    assert len(vocabulary_of(RANKS).pieces) <= 3 or Pieces.LIMIT == 3


def test_awkward_rows(spark, library):
    df = clashing(documents(spark), "ids", "offsets", "decoded")
    coded = encode_documents(df, RANKS, block_chars=300)
    got = rows(decode_documents(coded, RANKS), "doc_id", "ids", "decoded")
    want = [(r[0], library.encode_ordinary(r[1] or ""), bytearray((r[1] or "").encode())) for r in ROWS]
    assert got == sorted(want, key=repr)
    assert rows(encode_documents(df, RANKS, 300, decoded=True), "doc_id", "ids", "decoded") == got
    assert encode_documents(documents(spark, []), RANKS, decoded=True).count() == 0
    assert decode_documents(coded.limit(0), RANKS).count() == 0


def test_stretches_of_ids_decode_to_their_place(spark):
    from pyspark.sql import functions as F

    text = ROWS[0][1]
    coded = encode_documents(documents(spark, ROWS[:1]), RANKS)
    part = coded.select("doc_id", F.slice("ids", 4, 3).alias("ids"), F.slice("offsets", 4, 3).alias("offsets"))
    row = decode_documents(part, RANKS).first()
    assert text.encode()[row.offsets[0] :].startswith(bytes(row.decoded)) and row.decoded


def test_query(spark, base, library):
    want = []
    for r in spark.read.parquet(f"{base}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        want.append(
            (
                r.doc_id,
                len(ids),
                hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((r.text or "").encode()).hexdigest(),
            )
        )
    got = rows(QUERIES["op13_scanned_byte_pairs"](spark, base), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(want, key=repr)
