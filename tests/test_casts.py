"""Casts against Spark's own non-ANSI casts, which are what the row rules assume."""

import random

import pytest
from pyspark.sql import functions as F

from dqgate.functions.casts import parse_double, parse_int, parse_timestamp

NUMBERS = [
    None, "", " ", "5", "5.0", "3.7", "-0.5", " 5 ", "\t5\n", "1e3", "9999999999", "2147483647",
    "2147483648", "-2147483648", "-2147483649", "000000000000007", "00000000000000000000.9", "+4",
    "+", "-", ".", ".5", "-.7", "+.", "5.", "1.2.3", "1,000", "1_000", "NaN", "nan", "inf",
    "-Infinity", "1.0d", "0x10", "abc", "5 5", "٣", "5 ", "0.005", "0.01", "1.0f",
    "12345678901234567890", "--5", "5-", "- 5",
]
STAMPS = [
    None, "", "2026-03-20T01:02:03", "2026-03-20T01:02:03Z", "2026-03-20T01:02:03.5",
    "2026-03-20 01:02:03", "2026-02-30T00:00:00", "2024-02-29T00:00:00", "2026-3-20T01:02:03",
    " 2026-03-20T01:02:03", "2026-03-20T24:00:00", "2026-03-20T23:59:60", "0000-01-01T00:00:00",
    "2026-03-20t01:02:03", "+12026-03-20T01:02:03", "not-a-timestamp", "2026-03-20T01:02",
]


def _random_numbers(n):
    rng = random.Random(7)
    return ["".join(rng.choice("0123456789.+- eN") for _ in range(rng.randint(1, 7))) for _ in range(n)]


@pytest.fixture
def lenient(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield
    spark.conf.set("spark.sql.ansi.enabled", "true")


def _values(spark, texts, column):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(column.cast("string")).collect()]


@pytest.mark.parametrize(
    "texts, mine, plain",
    [
        (NUMBERS + _random_numbers(3000), parse_int, lambda c: c.cast("int")),
        (NUMBERS + _random_numbers(3000), parse_double, lambda c: c.cast("double")),
        (STAMPS, parse_timestamp, lambda c: F.to_timestamp(c, "yyyy-MM-dd'T'HH:mm:ss")),
    ],
    ids=["int", "double", "timestamp"],
)
def test_same_as_lenient_cast(spark, lenient, texts, mine, plain):
    want = _values(spark, texts, plain(F.col("t")))
    spark.conf.set("spark.sql.ansi.enabled", "true")
    got = _values(spark, texts, mine(F.col("t")))
    assert [x for x in zip(texts, got, want) if x[1] != x[2]] == []


def test_double_shapes_agree_with_the_lenient_cast(spark):
    texts = [
        "1", "+1", "-1.5", ".5", "5.", ".", "", " ", None, "1e5", "1E-5", "1e", "1e+", "1d", "1F", "1.5e3f", "1fd", "NaN",
        "nan", "-NaN", "inf", "-Inf", "+Infinity", "INFINITY", "infinit", " 7 ", "\t7\n", "7\x00", "1 2", "1,5", "0x1p3",
        "0x.8p1", "0x1", "--1", "+-1", "1..2", "1.2.3", "e5", "1_000", "١", "９", "1e400", "-1e400", "1e-400", "abc", "1a",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(parse_double(F.col("t")).alias("a"), F.col("t").try_cast("double").alias("b"))
    assert [repr(r.a) for r in got.collect()] == [repr(r.b) for r in got.collect()]
