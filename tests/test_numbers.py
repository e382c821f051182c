import random

from pyspark.sql import functions as F

from dqgate.functions.numbers import percent, rate, ratio, round_half_even


def test_rounding_and_percent_equal_python(spark):
    rng = random.Random(3)
    pairs = [(rng.randint(0, b), b) for b in (rng.choice([64, 128, 640, 80000, 333, 100000, 7]) for _ in range(4000))]
    pairs += [(1, 128), (3, 128), (1, 80000), (3, 80000), (0, 5), (5, 5), (1, 800)]
    rows = spark.createDataFrame(pairs, "a bigint, b bigint").select(
        "a", "b",
        F.expr(rate("a", "b")).alias("r"),
        F.expr(round_half_even("a / b", 2)).alias("r2"),
        F.expr(percent("a / b")).alias("p"),
    )
    wrong = [
        tuple(r) for r in rows.collect()
        if (r.r, r.r2, r.p) != (round(r.a / r.b, 6), round(r.a / r.b, 2), f"{r.a / r.b:.2%}")
    ]
    assert wrong == []


def test_nothing_to_divide_by(spark):
    row = spark.range(1).select(
        F.expr(ratio("5", "0")).alias("x"), F.expr(rate("5", "0")).alias("y"), F.expr(rate("NULL", "3")).alias("z")
    ).first()
    assert tuple(row) == (0.0, 0.0, 0.0)
