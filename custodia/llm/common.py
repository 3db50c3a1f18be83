"""What the operators of this package share: reading, shared tables, words, and native let-bindings.

Words are the runs of ``[^\\x20\\x09-\\x0D]+``. On UTF-8 bytes that is exactly ``bytes.split()``, and
``bytes.lower()`` touches exactly A-Z, so the Python operators work on encoded texts.
"""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.session import fresh_path

#: Texts without null: a missing text is an empty one everywhere in this package.
TEXT = "coalesce(text, '')"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"

#: Odd multiplier of the rolling combination of word hashes (the golden ratio in 64 bits).
_STEP = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def in_python(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this library's code sent along, so that workers need not have it installed."""
    context = df.sparkSession.sparkContext
    root = Path(__file__).resolve().parents[1]
    if not getattr(context, "_sent_code", False) and root.is_dir():
        archive = f"{tempfile.mkdtemp()}/{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, str(source.relative_to(root.parent)))
        context.addPyFile(archive)
        context._sent_code = True
    return df.mapInArrow(function, schema)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the cluster's shared folder and read again.

    Cuts the lineage at a table that survives lost executors, and keeps Python work from running once
    per consumer.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, made longer until no column is called so; Spark minds no case."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside array functions."""
    return F.transform(F.array(value), body).getItem(0)


def bit_table(rows: DataFrame, number: Column, bits: int) -> np.ndarray:
    """One bit for every number below ``2 ** bits``, packed: does it occur? The driver gets at most that many bits."""
    place = number.cast("long") + 1
    pieces = (
        rows.groupBy(F.bitmap_bucket_number(place).alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))
        .collect()
    )
    out = np.zeros((max((1 << bits) // 32768, 1), 4096), np.uint8)
    for row in pieces:
        out[row.piece - 1] = np.frombuffer(row.bitmap, np.uint8)
    return out.reshape(-1)


def bits_for(rows: int, most: int = 28) -> int:
    """Width of a bit table in which so many numbers set about one bit in 32; at most ``2 ** most`` bits, fuller beyond."""
    return max(15, min(most, (32 * rows).bit_length()))


def bits_at(table: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether each number's bit is set."""
    return (table[numbers >> 3] >> (numbers & 7).astype(np.uint8)) & 1 == 1


#: A key of a join may have so many rows, and so many keys at most may have more.
_HOT_ROWS, _HOT_KEYS = 200_000, 100_000


def spread_join(many: DataFrame, one: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """``many`` joined to ``one`` (at most one row per ``key``), with the rows of very frequent keys dealt over several tasks.

    Keys of ``many`` with more rows than a limit are cut into parts by the hash of ``by``, and their row of ``one`` is
    repeated for every part. The limit grows with the table, so that the list of such keys, which is broadcast, never has
    more than ``_HOT_KEYS`` rows. Null keys meet nothing.
    """
    total = many.count()
    limit = max(_HOT_ROWS, total // _HOT_KEYS)
    hot = (
        many.groupBy(key).agg(F.count(F.lit(1)).alias("rows_of_key")).where(F.col("rows_of_key") > limit)
        .select(F.col(key), F.ceil(F.col("rows_of_key") / limit).cast("int").alias("parts_of_key"))
    )
    if hot.isEmpty():
        return many.join(one, key, how)
    hot = F.broadcast(stored(hot, "hot-keys"))
    part = F.coalesce(F.pmod(F.xxhash64(by), F.col("parts_of_key")), F.lit(0)).cast("int")
    dealt = many.join(hot, key, "left").withColumn("part_of_key", part).drop("parts_of_key")
    parts = F.sequence(F.lit(0), F.coalesce("parts_of_key", F.lit(1)) - 1)
    repeated = one.join(hot, key, "left").withColumn("part_of_key", F.explode(parts)).drop("parts_of_key")
    return dealt.join(repeated, [key, "part_of_key"], how).drop("part_of_key")


class WordHashes(dict):
    """64-bit hash of each word, remembered up to a bound."""

    LIMIT = 500_000

    def __init__(self) -> None:
        super().__init__()
        from xxhash import xxh64_intdigest

        self._digest = xxh64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = self._digest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every bit (murmur3's finaliser)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


_STRETCH = 1 << 20


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value of every byte (the same for A-Z and a-z, zero for white space), powers of an odd number, their inverses."""
    values = mixed(np.arange(1, 257, dtype=np.uint64))
    values[65:91] = values[97:123]
    values[[*range(9, 14), 32]] = 0
    inverse = np.uint64(pow(int(_STEP), -1, 2**64))
    powers, inverses = (np.cumprod(np.full(_STRETCH, x)) for x in (_STEP, inverse))
    return values, powers, inverses


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of every word of a UTF-8 text, A-Z lowered, without making the words.

    The sum of a word's byte values times consecutive powers, taken over the text and brought back to the word's
    start by the inverse power, then finalised.
    """
    values, powers, inverses = _tables()
    if len(raw) > _STRETCH:
        cut = max(raw.rfind(c, 0, _STRETCH) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut > 0:
            return np.concatenate([word_hashes(raw[:cut]), word_hashes(raw[cut:])])
        powers, inverses = (np.cumprod(np.full(len(raw), x[0])) for x in (powers, inverses))  # one endless word
    if not raw:
        return np.zeros(0, np.uint64)
    terms = values[np.frombuffer(raw, np.uint8)]
    inside = terms != 0
    starts = np.flatnonzero(inside[1:] > inside[:-1]) + 1
    if inside[0]:
        starts = np.concatenate([[0], starts])
    if not len(starts):
        return np.zeros(0, np.uint64)
    terms *= powers[: len(raw)]
    return mixed(np.add.reduceat(terms, starts) * inverses[starts])


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words; of the whole sequence if it is shorter; none if empty."""
    n = len(hashes)
    if n == 0:
        return hashes
    count = max(n - width + 1, 1)
    out = np.zeros(count, np.uint64)
    for i in range(min(width, n)):
        out = out * _STEP + hashes[i : i + count]
        out ^= out >> np.uint64(29)
    return mixed(out + np.uint64(min(width, n)))
