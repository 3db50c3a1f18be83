"""Reproducible pseudo-random values from md5, the same in any engine that has md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MANTISSA_HEX = 13  # 52 bits, exactly representable in a double


def hash_long(value: Column, salt: str = "", hex_digits: int = 15) -> Column:
    """Non-negative bigint of ``4 * hex_digits`` bits from a string value; NULL stays NULL."""
    digest = F.md5(F.concat(F.lit(salt), value).cast("binary"))
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("bigint")


def uniform(value: Column, salt: str = "") -> Column:
    """Uniform double in (0, 1); the half step keeps both ends out of reach."""
    return (hash_long(value, salt, _MANTISSA_HEX).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def uniform_between(value: Column, low: float, high: float, salt: str = "") -> Column:
    return F.lit(low) + uniform(value, salt) * F.lit(high - low)


def laplace(value: Column, scale: Column | float, salt: str = "") -> Column:
    """Laplace noise by inverse transform of the keyed uniform."""
    centred = uniform(value, salt) - F.lit(0.5)
    scale = scale if isinstance(scale, Column) else F.lit(float(scale))
    return -scale * F.signum(centred) * F.ln(F.lit(1.0) - F.lit(2.0) * F.abs(centred))
