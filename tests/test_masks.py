import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custodia.functions.masks import LEVELS, mask, most_severe, severity

STRINGS = [(0, None), (1, ""), (2, "a"), (3, "abc"), (4, "abcd"), (5, "abcde"), (6, "Zoë Ünal")]


def _masked(spark, level):
    df = spark.createDataFrame(STRINGS, "i int, s string")
    return [r[0] for r in df.orderBy("i").select(mask(F.col("s"), level, T.StringType())).collect()]


def test_pii_hides_null_too(spark):
    assert _masked(spark, "PII") == ["***PII-REDACTED***"] * len(STRINGS)


def test_restricted_keeps_last_four(spark):
    assert _masked(spark, "RESTRICTED") == [None, "***-", "***-a", "***-abc", "***-abcd", "***-bcde", "***-Ünal"]


def test_sensitive_keeps_first_and_length(spark):
    assert _masked(spark, "SENSITIVE") == [None, "", "a", "a**", "a***", "a****", "Z*******"]


@pytest.mark.parametrize("level", ["INTERNAL", "PUBLIC", None])
def test_low_levels_pass(spark, level):
    assert _masked(spark, level) == [s for _, s in STRINGS]


NUMBERS = [
    (T.LongType(), 1234567, 1234600),
    (T.IntegerType(), -1250, -1300),
    (T.ShortType(), 32760, None),  # the rounded value does not fit
    (T.ByteType(), 120, 100),
    (T.DoubleType(), 1863.84, 1900.0),
    (T.FloatType(), 149.0, 100.0),
    (T.DecimalType(10, 2), Decimal("1863.84"), Decimal("1900.00")),
]


@pytest.mark.parametrize("dtype,value,rounded", NUMBERS, ids=lambda x: str(x))
def test_number_masks_keep_type(spark, dtype, value, rounded):
    df = spark.createDataFrame([(value,), (None,)], T.StructType([T.StructField("v", dtype)]))
    out = df.select(*[mask(F.col("v"), level, dtype).alias(level) for level in LEVELS])
    assert [f.dataType for f in out.schema.fields] == [dtype] * len(LEVELS)
    row, null_row = out.collect()
    assert row["PII"] is None and row["RESTRICTED"] == rounded and row["INTERNAL"] == pytest.approx(value)
    assert row["SENSITIVE"] >= 0 and row["SENSITIVE"] != value
    assert null_row["SENSITIVE"] is None and null_row["RESTRICTED"] is None


def test_hash_depends_on_salt_and_value(spark):
    df = spark.createDataFrame([(1,), (2,), (1,)], "v bigint")
    first = [r[0] for r in df.select(mask(F.col("v"), "SENSITIVE", T.LongType(), "a")).collect()]
    second = [r[0] for r in df.select(mask(F.col("v"), "SENSITIVE", T.LongType(), "b")).collect()]
    assert first[0] == first[2] != first[1] and first[0] != second[0]


def test_dates_and_timestamps(spark):
    day, time = datetime.date(2024, 5, 17), datetime.datetime(2024, 5, 17, 13, 45, 10)
    df = spark.createDataFrame([(day, time, time)], "d date, t timestamp, n timestamp_ntz")
    types = {c: df.schema[c].dataType for c in df.columns}
    get = lambda level: df.select(*[mask(F.col(c), level, types[c]).alias(c) for c in df.columns])
    for level in LEVELS:
        assert [f.dataType for f in get(level).schema.fields] == list(types.values())
    midnight, month = datetime.datetime(2024, 5, 17), datetime.datetime(2024, 5, 1)
    assert tuple(get("PII").first()) == (None, None, None)
    assert tuple(get("RESTRICTED").first()) == (datetime.date(2024, 1, 1), midnight, midnight)
    assert tuple(get("SENSITIVE").first()) == (datetime.date(2024, 5, 1), month, month)


def test_unmaskable_type_is_hidden(spark):
    df = spark.createDataFrame([([1, 2], True)], "a array<int>, b boolean")
    types = {c: df.schema[c].dataType for c in df.columns}
    assert tuple(df.select(*[mask(F.col(c), "SENSITIVE", types[c]) for c in df.columns]).first()) == (None, None)


def test_severity_order():
    assert [severity(x) for x in (*LEVELS, None)] == [1, 2, 3, 4, 5, 6]
    assert most_severe(["INTERNAL", None, "RESTRICTED", "SENSITIVE"]) == "RESTRICTED"
    assert most_severe([None, "NONE"]) is None
