"""Exact n-gram Jaccard join with signature trees: near-duplicate documents and their components.

A document's set is its distinct 5-word shingles (64-bit hashes). Two documents link when
``100 * |A & B| >= similarity * |A | B|``.

1. Documents with equal sets are one class; only classes are compared.
2. Prefix filter: linked classes share one of their first ``n - ceil(t n) + 1`` shingles under any common order.
   The order puts the shingles whose hash lies in the lowest ``region`` of the range first, rarest first, then the
   rest by hash. The region holds a little more than a prefix needs, so only its shingles are counted over the
   corpus, and a prefix is filled with shingles of no other class before any that passages bring into many
   documents. Every set of shingles and every ``region`` give the same result. Counting moves difference-coded
   blocks; then rows move of shingles with several holders, and of a few that share a bit with one in a table of
   fixed size.
3. Candidates: classes that share a prefix shingle with few holders are paired and kept if the number of shared
   prefix shingles allows a link; holders of a wider shingle are tied to its first holder. Connected candidates
   form groups, and linked classes are always in one group.
4. Each group is joined by a signature tree: nodes hold size ranges and OR-combined shingle bitmaps; the dual
   traversal drops node pairs whose largest possible overlap is too small, and pairs already connected. What
   is left is compared set by set. Groups beyond ``group_shingles`` are cut into chunks by size and hash, and the
   trees of every two chunks of fitting sizes are traversed against each other.
5. The links that connect classes give the components. If links are to be counted, the traversal passes over no pair
   because it is connected, and leaves are compared with exact bitmaps over their own shingles.

Nothing is capped: all classes of a group meet. No task holds more than two chunks, one class at the least; rows that
move before step 4 are ids and hashes. Texts move compressed, once to their class and once to their group.

Null text: no words, an empty set, linked with nothing. Null ids: taken as any other row; a component of nothing
else has a null id. Repeated rows are returned as often as they came. Empty tables give no rows. Other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.common import bit_table, bits_at, bits_for, free_name, in_python, spread_join, stored, windows, word_hashes
from custodia.llm.components import components

SHINGLE = 5
#: A prefix shingle with at most so many holders is paired out; wider ones are tied to their first holder.
NARROW = 16
_LEAF = 32
_FAN = 8
_BITS = 1024
_ROWS_OUT = 400_000


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct shingle hashes of the words, A-Z lowered."""
    found = np.sort(windows(word_hashes(text.encode()), SHINGLE))
    return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def class_key(shingles: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    value = xxh64_intdigest(shingles.tobytes(), len(shingles))
    return value - (1 << 64) if value >> 63 else value


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def _bound(region: float) -> int:
    """The first hash behind the region, as an unsigned number of at most 63 bits."""
    return min(int(region * 2.0**64), 2**63 - 1)


def prefix_size(n: int, similarity: int) -> int:
    return n + (-similarity * n) // 100 + 1


def members(documents: DataFrame, region: float) -> DataFrame:
    """(doc_id, text_key, class, n, low): a document's class, its set's size, and how much of it lies in the region."""
    bound = np.uint64(_bound(region))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            sets = [shingle_set(column[i].as_py()) for i in range(len(column))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([class_key(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([int(np.searchsorted(s, bound)) for s in sets], pa.int64()),
                ],
                ["doc_id", "text_key", "class", "n", "low"],
            )

    texts = _texts(documents).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return in_python(texts, run, "doc_id long, text_key long, class long, n long, low long")


def _low_parts(batches: Iterator[pa.RecordBatch], similarity: int, region: float, most: int):
    """(hashes, classes, how many each class has): all shingles of the region, and as many more by hash as a prefix needs.

    Once per class and task, for the classes that the task has seen lately, in parts of about ``most`` hashes.
    """
    bound = np.uint64(_bound(region))
    seen: set[int] = set()
    keys: list[np.ndarray] = []
    classes: list[int] = []
    held = 0
    for batch in batches:
        column = batch.column(0)
        for i in range(len(column)):
            shingles = shingle_set(column[i].as_py())
            if not len(shingles):
                continue
            key = class_key(shingles)
            if key in seen:
                continue
            if len(seen) >= 1_000_000:
                seen.clear()
            seen.add(key)
            low = int(np.searchsorted(shingles, bound))
            keys.append(shingles[: max(low, prefix_size(len(shingles), similarity))])
            classes.append(key)
            held += len(keys[-1])
            if held >= most:
                yield keys, classes
                keys, classes, held = [], [], 0
    if keys:
        yield keys, classes


#: Bits at most of the tables that keep most shingles of one holder, and most texts that no task compares, from moving:
#: 32 MB each, whatever the corpus.
_KNOWN_BITS = 28


def known_numbers(rows: DataFrame, column: str):
    """The broadcast bit table of a column of hashes, and what finds the bits of numpy hashes in it."""
    bits = bits_for(rows.count(), _KNOWN_BITS)
    number = F.shiftrightunsigned(column, 8).bitwiseAND((1 << bits) - 1)
    table = rows.sparkSession.sparkContext.broadcast(bit_table(rows, number, bits))
    mask = np.int64((1 << bits) - 1)
    return lambda hashes: bits_at(table.value, (hashes >> np.int64(8)) & mask)


def low_shingles(documents: DataFrame, similarity: int, region: float, known) -> DataFrame:
    """(shingle, class) as of ``_low_parts``, of shingles that ``known`` finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, classes in _low_parts(batches, similarity, region, _ROWS_OUT):
            owner = np.repeat(np.array(classes, np.int64), [len(k) for k in keys])
            shingles = np.concatenate(keys).view(np.int64)
            held = known(shingles)
            if held.any():
                columns = [pa.array(shingles[held]), pa.array(owner[held])]
                yield pa.RecordBatch.from_arrays(columns, ["shingle", "class"])

    return in_python(_texts(documents).select("text"), run, "shingle long, class long")


_BLOCK = ["part", "first", "deltas", "width", "counts", "count_width"]
_BLOCK_SCHEMA = "part int, first long, deltas binary, width int, counts binary, count_width int"


def _block(part: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Sorted hashes as differences in as few bytes each as the largest needs, with their counts."""
    deltas = np.diff(keys, prepend=keys[:1])
    width = max((int(deltas.max()).bit_length() + 7) // 8, 1)
    packed = deltas.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    kind = np.min_scalar_type(int(counts.max()))
    values = [part, int(keys[:1].view(np.int64)[0]), packed, width, counts.astype(kind).tobytes(), kind.itemsize]
    types = [pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], _BLOCK)


def _unblocked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of all blocks of a table."""
    keys, counts = [], []
    for first, deltas, width, times, count_width in zip(*(table.column(c) for c in _BLOCK[1:])):
        raw = np.frombuffer(deltas.as_buffer(), np.uint8).reshape(-1, width.as_py())
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, : raw.shape[1]] = raw
        wide = wide.view("<u8").reshape(-1).astype(np.uint64)
        keys.append(np.cumsum(wide, dtype=np.uint64) + np.array([first.as_py()], np.int64).view(np.uint64)[0])
        counts.append(np.frombuffer(times.as_buffer(), f"u{count_width.as_py()}").astype(np.int64))
    return np.concatenate(keys), np.concatenate(counts)


def shared_shingles(documents: DataFrame, similarity: int, region: float, total: int, part_keys: int = 1_000_000) -> DataFrame:
    """(shingle, holders) of all low shingles that more than one row holds.

    What moves are sorted, difference-coded blocks: a shingle once per task and part, however many rows of the task hold
    it. A hash is dealt to a part by its remainder and coded by its quotient, so parts are alike however hashes lie;
    there are as many as keep one at about ``part_keys`` of the ``total`` hashes.
    """
    parts = np.uint64(1 + total // part_keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, _ in _low_parts(batches, similarity, region, part_keys):
            found, counts = np.unique(np.concatenate(keys), return_counts=True)
            part = found % parts
            order = np.argsort(part, kind="stable")
            found, counts, part = found[order] // parts, counts[order], part[order]
            begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist()
            for begin, end in zip(begins, [*begins[1:], len(part)]):
                yield _block(int(part[begin]), found[begin:end], counts[begin:end])

    def count(table: pa.Table) -> pa.Table:
        keys, counts = _unblocked(table)
        keys = keys * parts + np.uint64(table.column("part")[0].as_py())
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        holders = np.add.reduceat(counts, starts)
        many = holders > 1
        return pa.table({"shingle": keys[starts][many].view(np.int64), "holders": holders[many]})

    blocks = in_python(_texts(documents).select("text"), run, _BLOCK_SCHEMA)
    return blocks.groupBy("part").applyInArrow(count, "shingle long, holders long")


def prefixes(documents: DataFrame, sizes: DataFrame, similarity: int, region: float) -> DataFrame:
    """(shingle, class, n, holders) for the prefix shingles that more than one row holds; ``sizes`` is (class, n, low)."""
    # a class that several tasks have met counts as several holders, which only lengthens its prefix
    needed = f"greatest(low, n - cast(ceil({similarity} * n / 100.0) AS bigint) + 1)"
    total = sizes.agg(F.sum(F.expr(needed))).first()[0] or 0
    spread = stored(shared_shingles(documents, similarity, region, int(total)), "shared-shingles")
    known = known_numbers(spread, "shingle")
    shared = low_shingles(documents, similarity, region, known).join(spread, "shingle").distinct()
    inside = f"shingle >= 0 AND shingle < {_bound(region)}L"
    own = Window.partitionBy("class")
    ranked = shared.withColumns(
        {
            "in_region": F.expr(inside),
            "place": F.row_number().over(own.orderBy(F.expr(f"NOT ({inside})"), "holders", "shingle")),
            "shared_low": F.count_if(F.expr(inside)).over(own),
        }
    )
    # a prefix begins with the region's shingles of this class alone, of which there are low - shared_low
    left = f"n - cast(ceil({similarity} * n / 100.0) AS bigint) + 1 - (low - shared_low)"
    return (
        ranked.join(sizes, "class")
        .where(f"(in_region AND place <= {left}) OR (NOT in_region)")
        .select("shingle", "class", "n", F.col("holders").cast("int").alias("holders"))
    )


def candidates(rows: DataFrame, similarity: int) -> DataFrame:
    """(a, b) pairs of classes whose connected components hold all linked classes; ``rows`` as of ``prefixes``."""
    rows = stored(rows, "prefixes")
    wide = rows.where(f"holders > {NARROW}")
    first = wide.groupBy("shingle").agg(F.min("class").alias("first"))
    tied = wide.join(first, "shingle").where("class <> first").select(F.col("class").alias("a"), F.col("first").alias("b")).distinct()
    # shared prefix shingles + what stands behind the prefixes must reach the overlap that a link needs
    many = wide.groupBy("class").agg(F.count(F.lit(1)).alias("wide"))
    narrow = rows.where(f"holders <= {NARROW}").select("shingle", "class", "n")
    a = narrow.select("shingle", F.col("class").alias("a"), F.col("n").alias("na"))
    b = narrow.select("shingle", F.col("class").alias("b"), F.col("n").alias("nb"))
    pairs = (
        a.join(b, "shingle")
        .where(f"a < b AND 100 * na >= {similarity} * nb AND 100 * nb >= {similarity} * na")
        .groupBy("a", "b", "na", "nb")
        .agg(F.count(F.lit(1)).alias("common"))
    )
    behind = f"greatest(na, nb) * {similarity} / 100.0"
    needed = f"(na + nb) * {similarity} / {100 + similarity}.0"
    sure = pairs.where(f"common + 1 >= {needed} - {behind}").select("a", "b")
    short = pairs.where(f"NOT (common + 1 >= {needed} - {behind})")
    helped = (
        short.join(many.select(F.col("class").alias("a"), F.col("wide").alias("wide_a")), "a")
        .join(many.select(F.col("class").alias("b"), F.col("wide").alias("wide_b")), "b")
        .where(f"common + least(wide_a, wide_b) + 1 >= {needed} - {behind}")
        .select("a", "b")
    )
    return tied.unionByName(sure).unionByName(helped)


class Signatures:
    """Sets of one task with bitmaps, and the labels of what is connected so far."""

    def __init__(self, sets: list[np.ndarray], similarity: int) -> None:
        self.similarity = similarity
        self.sets = [frozenset(s.tolist()) for s in sets]
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.bitmaps = np.zeros((len(sets), _BITS // 64), np.uint64)
        for i, s in enumerate(sets):
            bit = s % np.uint64(_BITS)
            np.bitwise_or.at(self.bitmaps[i], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        self.excess = self.sizes - np.bitwise_count(self.bitmaps).sum(axis=1).astype(np.int64)
        self.parents = np.arange(len(sets))
        self.arrays = sets
        self.references: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def labels(self, items: np.ndarray) -> np.ndarray:
        """The first set of what each of the sets is connected with."""
        found = self.parents[items]
        while (found != (above := self.parents[found])).any():
            found = above
        return found

    def label(self, i: int) -> int:
        parents = self.parents
        while parents[i] != i:
            parents[i] = parents[parents[i]]
            i = parents[i]
        return int(i)

    def needed(self, a, b):
        """The least overlap of a link between sets of these sizes."""
        return -(-(self.similarity * (a + b)) // (100 + self.similarity))

    def reference(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All hashes of a leaf's sets, sorted, and which of them each set holds, as bits."""
        key = int(items[0])
        if key not in self.references:
            all_of_it = np.unique(np.concatenate([self.arrays[i] for i in items]))
            self.references[key] = (all_of_it, self.bits(items, all_of_it))
        return self.references[key]

    def bits(self, items: np.ndarray, of_these: np.ndarray) -> np.ndarray:
        flat = np.concatenate([self.arrays[i] for i in items])
        place = np.minimum(np.searchsorted(of_these, flat), len(of_these) - 1)
        held = of_these[place] == flat
        table = np.zeros((len(items), -(-len(of_these) // 64) * 64), bool)
        table[np.repeat(np.arange(len(items)), self.sizes[items])[held], place[held]] = True
        return np.packbits(table, axis=1).view(np.uint64)

    def linked(self, i: int, j: int) -> bool:
        both = len(self.sets[i] & self.sets[j])
        return 100 * both >= self.similarity * (len(self.sets[i]) + len(self.sets[j]) - both)

    def connect(self, i: int, j: int) -> None:
        low, high = sorted((self.label(i), self.label(j)))
        self.parents[high] = low


class Node:
    """A part of the tree: its sets' size range, OR-combined bitmap, and largest number of shared bits' excess."""

    def __init__(self, of: Signatures, items: np.ndarray, children: list[Node]) -> None:
        self.items, self.children = items, children
        if children:
            self.bitmap = np.bitwise_or.reduce([c.bitmap for c in children])
            self.low, self.high = min(c.low for c in children), max(c.high for c in children)
            self.excess = max(c.excess for c in children)
        else:
            self.bitmap = np.bitwise_or.reduce(of.bitmaps[items], axis=0)
            self.low, self.high = int(of.sizes[items].min()), int(of.sizes[items].max())
            self.excess = int(of.excess[items].max())


def tree(of: Signatures, items: np.ndarray) -> Node:
    """Leaves of sets that start alike, then nodes of ``_FAN`` neighbours up to the root."""
    first = [min(of.sets[i]) for i in items]
    items = items[np.lexsort((of.sizes[items], np.array(first, np.uint64)))]
    level = [Node(of, items[k : k + _LEAF], []) for k in range(0, len(items), _LEAF)]
    while len(level) > 1:
        level = [
            Node(of, np.concatenate([c.items for c in level[k : k + _FAN]]), level[k : k + _FAN])
            for k in range(0, len(level), _FAN)
        ]
    return level[0]


def traverse(of: Signatures, left: Node, right: Node, weights: np.ndarray | None = None) -> np.ndarray | None:
    """Connect what links, over all pairs of a set left and a set right.

    With ``weights`` no pair is passed over because it is connected already, and the weight of all that a set links
    with is returned for every set.
    """
    sums = None if weights is None else np.zeros(len(of.sizes), np.int64)
    stack = [(left, right)]
    while stack:
        x, y = stack.pop()
        t = of.similarity
        if 100 * x.high < t * y.low or 100 * y.high < t * x.low:
            continue
        most = int(np.bitwise_count(x.bitmap & y.bitmap).sum()) + min(x.excess, y.excess)
        if min(most, x.high, y.high) < of.needed(x.low, y.low):
            continue
        if sums is None:
            labels_x, labels_y = of.labels(x.items), of.labels(y.items)
            if (labels_x == labels_x[0]).all() and (labels_y == labels_x[0]).all():
                continue
        if x is y and x.children:
            kids = x.children
            stack.extend((kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids)))
        elif x.children or y.children:
            wider = x.children and (not y.children or len(x.items) >= len(y.items))
            stack.extend([(c, y) for c in x.children] if wider else [(x, c) for c in y.children])
        elif sums is None:
            _leaves(of, x.items, y.items, x is y)
        else:
            _count_leaves(of, x.items, y.items, x is y, weights, sums)
    return sums


def _possible(of: Signatures, a: np.ndarray, b: np.ndarray, same: bool) -> np.ndarray:
    """Pairs of two leaves that sizes and bitmaps allow to link."""
    na, nb = of.sizes[a][:, None], of.sizes[b][None, :]
    common = np.bitwise_count(of.bitmaps[a][:, None, :] & of.bitmaps[b][None, :, :]).sum(axis=2, dtype=np.int64)
    possible = common + np.minimum(of.excess[a][:, None], of.excess[b][None, :]) >= of.needed(na, nb)
    possible &= (100 * na >= of.similarity * nb) & (100 * nb >= of.similarity * na)
    return np.triu(possible, 1) if same else possible


def _count_leaves(of: Signatures, a: np.ndarray, b: np.ndarray, same: bool, weights: np.ndarray, sums: np.ndarray) -> None:
    possible = _possible(of, a, b, same)
    if not possible.any():
        return
    every, mine = of.reference(a)
    common = np.bitwise_count(mine[:, None, :] & of.bits(b, every)[None, :, :]).sum(axis=2, dtype=np.int64)
    linked = possible & (100 * common >= of.similarity * (of.sizes[a][:, None] + of.sizes[b][None, :] - common))
    sums[a] += linked @ weights[b]
    sums[b] += linked.T @ weights[a]
    while (new := linked & (of.labels(a)[:, None] != of.labels(b)[None, :])).any():
        p, q = np.unravel_index(int(new.argmax()), new.shape)
        of.connect(int(a[p]), int(b[q]))


def _leaves(of: Signatures, a: np.ndarray, b: np.ndarray, same: bool) -> None:
    possible = _possible(of, a, b, same)
    possible &= of.labels(a)[:, None] != of.labels(b)[None, :]
    for p, q in zip(*np.nonzero(possible)):
        i, j = int(a[p]), int(b[q])
        if of.label(i) != of.label(j) and of.linked(i, j):
            of.connect(i, j)


def tree_links(meeting: pd.DataFrame, similarity: int) -> pd.DataFrame:
    """class, first, links for every class of a meeting (group, class, side, packed, documents).

    ``first`` is the first class that a class is connected with in its group; ``links``, with numbers of documents, how many
    documents of other classes it links with, else 0.
    """
    return pd.concat([_group_links(g, similarity) for _, g in meeting.groupby("group")], ignore_index=True)


def _group_links(group: pd.DataFrame, similarity: int) -> pd.DataFrame:
    """One group: side 0 and 1 against each other, or 2 with itself."""
    group = group.drop_duplicates("class").sort_values("class", ignore_index=True)
    sets = [shingle_set(zlib.decompress(p).decode()) for p in group["packed"]]
    of = Signatures(sets, similarity)
    side = group["side"].to_numpy()
    weights = group["documents"].to_numpy(np.int64) if group["documents"].notna().all() else None
    sums = None
    if (side == 2).all():
        root = tree(of, np.arange(len(sets)))
        sums = traverse(of, root, root, weights)
    elif (side == 0).any() and (side == 1).any():
        sums = traverse(of, tree(of, np.flatnonzero(side == 0)), tree(of, np.flatnonzero(side == 1)), weights)
    keys = group["class"].to_numpy()
    first = keys[of.labels(np.arange(len(keys)))]
    return pd.DataFrame({"class": keys, "first": first, "links": 0 if sums is None else sums}, dtype="int64")


def packed_texts(documents: DataFrame, needed: DataFrame) -> DataFrame:
    """(text_key, packed): compressed texts of the needed keys, and of a few that share a bit with one in a table of fixed size.

    Once per task for those it has seen lately.
    """
    known = known_numbers(needed, "text_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            numbers, column = batch.column(0).to_numpy(), batch.column(1)
            keys, packed = [], []
            for i in np.flatnonzero(known(numbers)).tolist():
                key = int(numbers[i])
                if key in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(key)
                keys.append(key)
                packed.append(zlib.compress(column[i].as_py().encode(), 1))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(packed, pa.binary())], ["text_key", "packed"])

    texts = _texts(documents).select(F.xxhash64("text").alias("text_key"), "text")
    return in_python(texts, run, "text_key long, packed binary")


def class_links(
    documents: DataFrame, own: DataFrame, similarity: int, region: float, group_shingles: int, count: bool = False
) -> DataFrame:
    """class, first, links of every meeting, as of ``tree_links``; ``own`` is ``members`` without empties.

    With ``count`` every pair of different sets of a group that sizes and bitmaps allow is compared, also where other links
    connect the two: for a group of near copies that grows with the square of its different texts, cut into meetings of
    bounded chunks. Pairs are counted where they meet and never listed.
    """
    met = meetings(documents, own, similarity, region, group_shingles)
    if not count:
        met = met.withColumn("documents", F.lit(None).cast("long"))
    found = met.groupBy("meeting").applyInPandas(lambda g: tree_links(g, similarity), "class long, first long, links long")
    return stored(found, "class-links")


def meetings(documents: DataFrame, own: DataFrame, similarity: int, region: float, group_shingles: int) -> DataFrame:
    """(group, meeting, class, documents, side, packed): the classes that a task compares, with the text of each."""
    classes = own.groupBy("class").agg(
        F.max("n").alias("n"),
        F.max("low").alias("low"),
        F.min("text_key").alias("text_key"),
        F.count(F.lit(1)).alias("documents"),
    )
    rows = prefixes(documents, classes.select("class", "n", "low"), similarity, region)
    groups = components(candidates(rows, similarity))
    grouped = stored(
        groups.select(F.col("node").alias("class"), F.col("label").alias("group"))
        .join(classes.drop("low"), "class")
        .withColumn("band", F.expr(f"cast(floor(ln(n) / ln(100.0 / {min(similarity, 99)})) AS int)")),
        "groups",
    )
    # chunks: one for a group that fits, else by size band and hash
    sizes = grouped.groupBy("group").agg(F.sum("n").alias("total"))
    bands = grouped.groupBy("group", "band").agg(F.sum("n").alias("in_band"))
    whole = sizes.where(f"total <= {group_shingles}").select("group")
    parts = (
        bands.join(sizes.where(f"total > {group_shingles}"), "group")
        .select("group", "band", F.expr(f"cast(ceil(in_band / {group_shingles}) AS int)").alias("parts"))
    )
    # groups that fit meet in bundles, each group by itself
    held = sizes.where(f"total <= {group_shingles}").agg(F.sum("total")).first()[0] or 0
    bundle = F.expr(f"pmod(xxhash64(group), {1 + int(3 * held // group_shingles)})")
    single = grouped.join(whole, "group", "left_semi").select(
        "group", F.concat(F.lit("bundle "), bundle).alias("meeting"), "class", "documents", "text_key", F.lit(2).alias("side")
    )
    placed = grouped.join(parts, ["group", "band"]).select(
        "group", "class", "documents", "text_key", "band", F.expr("cast(pmod(xxhash64(class), parts) AS int)").alias("part")
    )
    other = parts.select("group", F.col("band").alias("band2"), F.explode(F.expr("sequence(0, parts - 1)")).alias("part2"))
    met = placed.join(other, "group").where("abs(band - band2) <= 1")
    mine, theirs = "format_string('%05d.%07d', band, part)", "format_string('%05d.%07d', band2, part2)"
    split = met.selectExpr(
        "group",
        f"concat(group, ' ', least({mine}, {theirs}), '+', greatest({mine}, {theirs})) AS meeting",
        "class",
        "documents",
        "text_key",
        f"CASE WHEN {mine} = {theirs} THEN 2 WHEN {mine} < {theirs} THEN 0 ELSE 1 END AS side",
    )
    needed = grouped.select("text_key").distinct()  # one text of each class; copies of it elsewhere are left out below
    texts = packed_texts(documents, needed).dropDuplicates(["text_key"])  # a text that is not needed meets nothing below
    met = single.unionByName(split).join(texts, "text_key")
    return met.select("group", "meeting", "class", "documents", "side", "packed")


def first_of_each(documents: DataFrame, similarity: int = 75) -> DataFrame:
    """One document of each component, the one with the lowest id (and text hash); documents without words all stay."""
    found = jaccard_components(documents, similarity)
    low = F.coalesce("doc_id", F.lit(-(2**63)))
    first = found.where("group_key is not null").groupBy("group_key").agg(F.min(F.struct(low.alias("k1"), "text_key")).alias("k"))
    empty = found.where("group_key is null").select(low.alias("join_id"), F.col("text_key").alias("join_text"))
    key = [free_name(c, documents.columns) for c in ("join_id", "join_text")]
    kept = first.select("k.k1", "k.text_key").toDF(*key).unionByName(empty.distinct().toDF(*key))
    own = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), F.xxhash64(F.coalesce("text", F.lit("")))]
    keyed = documents.withColumns(dict(zip(key, own)))
    return keyed.join(kept, key, "left_semi").dropDuplicates(key).drop(*key)


def jaccard_components(
    documents: DataFrame,
    similarity: int = 75,
    region: float = 0.32,
    group_shingles: int = 1_000_000,
    count_links: bool = False,
) -> DataFrame:
    """doc_id, n_shingles, component_id for every row; ``similarity`` is a percentage.

    With ``count_links`` also n_links, the number of other rows that the row links with, copies among them. Also
    ``text_key``, the hash of the row's text, and ``group_key``, which is the same for the rows of a component and null for
    empty sets.
    """
    own = stored(members(documents, region), "members")
    found = class_links(documents, own.where("n > 0"), similarity, region, group_shingles, count_links)
    # stars, which are joined up in fewer rounds than the links themselves
    labels = components(found.where("class <> first").select(F.col("class").alias("a"), F.col("first").alias("b")))
    firsts = own.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    lowest = (
        labels.join(firsts, labels.node == firsts["class"])
        .groupBy("label")
        .agg(F.min("first").alias("lowest"))
    )
    linked = labels.join(lowest, "label").select(F.col("node").alias("class"), "label", "lowest")
    known = firsts.join(linked, "class", "left")
    number = F.lit(0).cast("long")
    if count_links:
        known = known.join(found.groupBy("class").agg(F.sum("links").alias("links")), "class", "left")
        number = F.col("copies") - 1 + F.coalesce("links", F.lit(0))
    known = known.select(
        "class",
        F.coalesce("label", "class").alias("group_key"),
        F.coalesce("lowest", "first").alias("lowest"),
        number.alias("n_links"),
    )
    columns = [
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("doc_id")).alias("component_id"),
        "text_key",
        F.when(F.col("n") > 0, F.col("group_key")).alias("group_key"),
    ]
    if count_links:
        columns.append(F.when(F.col("n") > 0, F.col("n_links")).otherwise(0).alias("n_links"))
    return spread_join(own, known, "class", "doc_id", "left").select(*columns)
