"""Value masks: one classification level, one expression, chosen by the column's type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custodia.functions.keyed import hash_long

# Classification levels, most severe first, and the text shown for hidden strings.
LEVELS = ("PII", "RESTRICTED", "SENSITIVE", "INTERNAL", "PUBLIC")
HIDDEN_TEXT = "***PII-REDACTED***"
PARTIAL_PREFIX = "***-"

_MASKED_LEVELS = frozenset(LEVELS[:3])


def severity(level: str | None) -> int:
    """Rank of a level, 1 = most severe; no level ranks last."""
    return LEVELS.index(level) + 1 if level in LEVELS else len(LEVELS) + 1


def most_severe(levels) -> str | None:
    known = [level for level in levels if level in LEVELS]
    return min(known, key=severity) if known else None


def severity_rank(level: Column) -> Column:
    """The same rank as a column, for ordering listings."""
    rank = F.lit(len(LEVELS) + 1)
    for i in reversed(range(len(LEVELS))):
        rank = F.when(level == LEVELS[i], i + 1).otherwise(rank)
    return rank


def mask_string(value: Column, level: str) -> Column:
    if level == "PII":
        return F.lit(HIDDEN_TEXT)  # also for NULL input
    if level == "RESTRICTED":
        return F.concat(F.lit(PARTIAL_PREFIX), F.right(value, F.lit(4)))
    return F.concat(F.left(value, F.lit(1)), F.repeat(F.lit("*"), F.length(value) - 1))


def mask_number(value: Column, level: str, dtype: T.DataType, salt: str = "") -> Column:
    if level == "PII":
        return F.lit(None).cast(dtype)
    if level == "RESTRICTED":
        # rounding up may leave a narrow type; such a value is hidden rather than failing the query
        wide = value.cast("int") if isinstance(dtype, (T.ByteType, T.ShortType)) else value
        return F.round(wide, -2).try_cast(dtype)
    # 60 bits fit bigint and double; narrower types take as many hex digits as they can hold
    digits = _hash_digits(dtype)
    return hash_long(value.cast("string"), salt, digits).cast(dtype)


def _hash_digits(dtype: T.DataType) -> int:
    if isinstance(dtype, T.ByteType):
        return 1
    if isinstance(dtype, T.ShortType):
        return 3
    if isinstance(dtype, T.IntegerType):
        return 7
    if isinstance(dtype, T.DecimalType):
        # d hex digits stay below 10 ** (1.21 d)
        return max(1, min(15, int((dtype.precision - dtype.scale) / 1.21)))
    return 15


def mask_date(value: Column, level: str) -> Column:
    if level == "PII":
        return F.lit(None).cast("date")
    return F.trunc(value, "year" if level == "RESTRICTED" else "month")


def mask_timestamp(value: Column, level: str, dtype: T.DataType) -> Column:
    if level == "PII":
        return F.lit(None).cast(dtype)
    return F.date_trunc("day" if level == "RESTRICTED" else "month", value).cast(dtype)


def mask(value: Column, level: str | None, dtype: T.DataType, salt: str = "") -> Column:
    """Dispatch on type. INTERNAL, PUBLIC and untagged pass; an unmaskable type is hidden whole."""
    if level not in _MASKED_LEVELS:
        return value
    if isinstance(dtype, T.StringType):
        return mask_string(value, level)
    if isinstance(dtype, T.NumericType):
        return mask_number(value, level, dtype, salt)
    if isinstance(dtype, T.DateType):
        return mask_date(value, level)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return mask_timestamp(value, level, dtype)
    return F.lit(None).cast(dtype)
