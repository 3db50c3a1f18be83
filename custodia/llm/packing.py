"""Hierarchical multi-length packing of token ids into sequences of at most one window.

A document is its ids and an end id. Full windows are cut off its head; the rest is routed to the
smallest context size (tier) that holds it. Long tiers are packed first: a window opens with the longest
waiting piece of its tier, its gap is filled with the longest shorter pieces that fit, and what then is
still open is filled by cutting a piece. Windows of the short tiers are filled to the last id, so they
need no padding. Sequences of a window size are counted off into step groups of equal token numbers, over all
tasks, so at most one group of each size is short.

* Texts and ids stay where they are read. A task holds at most ``pool_tokens`` of ids and one document, and numbers
  its sequences with its partition in the high bits, so a repeated task gives the same pieces again. The pieces are
  stored; the sequences of each task and size are counted, one row each, and every piece gets its group from the
  count of the tasks before its own.
* Padding: up to ``tolerance`` ids in a window of the longest tier, and one last sequence per task.
* Null text: empty, one piece with the end id. Rows with equal or null ids are documents of their own.
  Empty tables give no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.bpe import bpe
from custodia.llm.common import in_python, stored

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " window long, step_group long"
)
TIERS = (256, 512, 1024, 2048)
_TASK_SHIFT = 40
_ROWS_OUT = 50_000


class Packer:
    """Packs the pieces of one task. A piece is (length, order, doc, start); doc is (id, ids, tokens)."""

    def __init__(self, tiers: tuple[int, ...], tolerance: int, pool_tokens: int) -> None:
        self.tiers, self.tolerance, self.pool_tokens = tuple(sorted(tiers)), tolerance, pool_tokens
        self.pool: list[tuple] = []
        self.held = self.order = self.sequences = 0
        self.full = dict.fromkeys(self.tiers, 0)
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        tokens, longest = len(ids) // 4, self.tiers[-1]
        doc = (doc_id, ids, tokens)
        cut = tokens - tokens % longest
        for start in range(0, cut, longest):
            self._close(longest, [(longest, 0, doc, start)])
        if tokens > cut:
            self._wait(doc, cut, tokens - cut)
        if self.held >= self.pool_tokens:
            self.pack(last=False)

    def _wait(self, doc: tuple, start: int, length: int) -> None:
        self.order += 1
        self.held += length
        insort(self.pool, (length, self.order, doc, start))

    def _take(self, index: int) -> tuple:
        piece = self.pool.pop(index)
        self.held -= piece[0]
        return piece

    def _tier(self, length: int) -> int:
        return next(t for t in self.tiers if t >= length)

    def _fill(self, window: int) -> tuple[list[tuple], int]:
        """The longest piece, then the longest that fits, then the head of a longer one."""
        pieces = [self._take(-1)]
        gap = window - pieces[0][0]
        while gap and self.pool:
            index = bisect_left(self.pool, (gap + 1,)) - 1
            if index >= 0:
                pieces.append(self._take(index))
                gap -= pieces[-1][0]
                continue
            if window == self.tiers[-1] and gap <= self.tolerance:
                break
            length, order, doc, start = self._take(0)
            pieces.append((gap, order, doc, start))
            self._wait(doc, start + gap, length - gap)
            gap = 0
        return pieces, gap

    def _allowed(self, window: int) -> int:
        return self.tolerance if window == self.tiers[-1] else 0

    def pack(self, last: bool) -> None:
        while self.pool:
            window = self._tier(self.pool[-1][0])
            pieces, gap = self._fill(window)
            if gap <= self._allowed(window):
                self._close(window, pieces)
                continue
            if not last:  # the pool ran out: wait for more documents
                for length, _, doc, start in pieces:
                    self._wait(doc, start, length)
                return
            self._close_rest(pieces)

    def _close_rest(self, pieces: list[tuple]) -> None:
        """What is left of a task: whole short windows, then one padded sequence."""
        left = sum(p[0] for p in pieces)
        queue = pieces[::-1]
        for window in reversed(self.tiers):
            while left >= window:
                self._close(window, self._head(queue, window))
                left -= window
        if left:
            self._close(self.tiers[-1], self._head(queue, left))

    @staticmethod
    def _head(queue: list[tuple], tokens: int) -> list[tuple]:
        out = []
        while tokens:
            length, order, doc, start = queue.pop()
            if length > tokens:
                queue.append((length - tokens, order, doc, start + tokens))
                length = tokens
            out.append((length, order, doc, start))
            tokens -= length
        return out

    def _close(self, window: int, pieces: list[tuple]) -> None:
        offset, place = 0, self.full[window]
        self.full[window] += 1
        for length, _, (doc_id, ids, tokens), start in pieces:
            crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
            self.rows.append((doc_id, start, length, crc, tokens, self.sequences, offset, window, place))
            offset += length
        self.sequences += 1


def pack_documents(
    documents: DataFrame,
    json_path: str,
    ranks_path: str,
    end_id: int = 1,
    tiers: tuple[int, ...] = TIERS,
    tolerance: int = 16,
    pool_tokens: int = 2_000_000,
    group_tokens: int = 32_768,
) -> DataFrame:
    """Pieces of all ``documents`` (doc_id, text); ``window`` is a sequence's padded length.

    ``step_group`` numbers the groups of ``group_tokens // window`` sequences of one window size, with
    the size's position in ``tiers`` in the bits from 40.
    """
    names = [c.split()[0] for c in PIECES.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, end = bpe(json_path, ranks_path), end_id.to_bytes(4, "little")
        base = TaskContext.get().partitionId() << _TASK_SHIFT
        packer = Packer(tiers, tolerance, pool_tokens)

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*packer.rows))
            columns[5] = [base + s for s in columns[5]]
            packer.rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for i, doc_id in enumerate(ids):
                packer.add(doc_id, state.ids(texts[i].as_py()) + end)
                if len(packer.rows) >= _ROWS_OUT:
                    yield flushed()
        packer.pack(last=True)
        if packer.rows:
            yield flushed()

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    pieces = stored(in_python(texts, run, PIECES), "pieces")  # step_group: the place among the task's sequences of a size
    return _grouped(pieces, tuple(sorted(tiers)), group_tokens)


def _grouped(pieces: DataFrame, tiers: tuple[int, ...], group_tokens: int) -> DataFrame:
    """Step groups over all tasks: a sequence's place among all of its size, counted off by tokens."""
    task = F.shiftrightunsigned("sequence_id", _TASK_SHIFT)
    counted = pieces.where("offset = 0").groupBy("window", task.alias("task")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("window").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    before = counted.select("window", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    position = F.array_position(F.array(*[F.lit(t).cast("long") for t in tiers]), F.col("window")) - 1
    group = F.expr(f"((before + step_group) * window) div {group_tokens}") + F.shiftleft(position, _TASK_SHIFT)
    columns = [c.split()[0] for c in PIECES.split(",")]
    return (
        pieces.withColumn("task", task)
        .join(before, ["window", "task"])
        .withColumn("step_group", group)
        .select(*columns)
    )
