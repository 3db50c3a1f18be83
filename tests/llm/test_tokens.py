"""Packing and token counts against the tokenizers library itself."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from custodia.llm.packing import pack_documents
from custodia.llm.queries import QUERIES, vocabulary
from custodia.llm.token_counts import count_tokens
from tests.llm.helpers import ROWS, clashing, documents, rows


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def encoded(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def check_pieces(pieces, ids_by_doc, end=1):
    """Each id of every document in exactly one piece, sequences gapless and within the window."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert set(docs) == set(ids_by_doc)
    for doc_id, parts in docs.items():
        ids = [*ids_by_doc[doc_id], end]
        parts.sort(key=lambda p: p.start)
        assert [p.start for p in parts] == np.cumsum([0, *[p.length for p in parts]])[:-1].tolist()
        assert sum(p.length for p in parts) == len(ids)
        for p in parts:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    used = padded = 0
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        lengths = [p.length for p in parts]
        assert [p.offset for p in parts] == np.cumsum([0, *lengths])[:-1].tolist()
        total = sum(lengths)
        assert total <= 2048 and len({p.window for p in parts}) == 1
        used += total
        padded += total if total & (total - 1) == 0 else 2048
    return used, padded


def test_small_packing(spark, library):
    unique = [r for i, r in enumerate(ROWS) if i not in (8, 11)]
    df = clashing(documents(spark, unique), "start", "window", "ids").coalesce(1)
    pieces = pack_documents(df, *vocabulary()).collect()
    check_pieces(pieces, {r[0]: encoded(library, r[1]) for r in unique})


def test_repeated_rows_are_documents_of_their_own(spark):
    twice = documents(spark, [ROWS[0], ROWS[0]])
    assert len(pack_documents(twice, *vocabulary()).collect()) >= 2


def test_packing_of_the_table(spark, base, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    pieces = QUERIES["op8_tiered_packing"](spark, base).collect()
    used, padded = check_pieces(pieces, {d: encoded(library, t) for d, t in texts.items()})
    assert padded < 1.02 * used
    groups = defaultdict(set)
    for p in pieces:
        groups[p.step_group].add((p.window, p.sequence_id))
    for group in groups.values():
        assert len({w for w, _ in group}) == 1
        assert sum(w for w, _ in group) <= 32_768


def test_step_groups_are_counted_off_over_all_tasks(spark):
    """However many tasks there are, one group of each window size is short at most."""
    rows = [(i, " ".join(f"word{i}x{k}" for k in range(20 + 37 * i % 400)), "en", "a", 0) for i in range(300)]
    pieces = pack_documents(documents(spark, rows).repartition(7, "doc_id"), *vocabulary(), group_tokens=4096).collect()
    assert len({p.sequence_id >> 40 for p in pieces}) > 3
    groups = defaultdict(set)
    for p in pieces:
        groups[p.window, p.step_group].add(p.sequence_id)
    for window in {w for w, _ in groups}:
        sizes = sorted(len(s) for (w, _), s in groups.items() if w == window)
        assert all(n == 4096 // window for n in sizes[1:]) and sizes[-1] <= 4096 // window
    assert len({g for _, g in groups}) == len(groups)


def test_small_pools_pack_alike(spark, library):
    df = documents(spark, [r for i, r in enumerate(ROWS) if i not in (8, 11)]).coalesce(1)
    pieces = pack_documents(df, *vocabulary(), pool_tokens=500, tolerance=0).collect()
    check_pieces(pieces, {r[0]: encoded(library, r[1]) for i, r in enumerate(ROWS) if i not in (8, 11)})


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert pack_documents(empty, *vocabulary()).count() == 0
    assert count_tokens(empty, *vocabulary()).count() == 0


def test_small_counts(spark, library):
    got = rows(count_tokens(clashing(documents(spark), "n", "pieces", "copies"), *vocabulary(), limit=100),
               "doc_id", "n_bytes", "n_tokens", "over_limit")
    counts = [(r[0], len((r[1] or "").encode()), len(encoded(library, r[1]))) for r in ROWS]
    assert got == sorted(((*c, c[2] > 100) for c in counts), key=repr)


def test_counts_of_the_table(spark, base, library):
    texts = spark.read.parquet(f"{base}/documents.parquet").collect()
    got = rows(QUERIES["op10_token_counts"](spark, base), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = [(r.doc_id, len(r.text.encode()), len(encoded(library, r.text))) for r in texts]
    assert got == sorted(((*w, w[2] > 512) for w in want), key=repr)


def test_every_kind_of_character(library):
    """Each code point between letters, digits and spaces, against the library's own ids."""
    from custodia.llm.bpe import bpe

    state = bpe(*vocabulary())
    points = [chr(i) for i in [*range(0x3100), *range(0x1F5F0, 0x1F650), *range(0xE000, 0xE010), 0x10940, 0x323B0]]
    for k in range(0, len(points), 97):
        text = "".join(f"a{c}1{c} {c}{c}x  " for c in points[k : k + 97])
        assert np.frombuffer(state.ids(text), "<u4").tolist() == encoded(library, text)
