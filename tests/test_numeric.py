"""Sums of doubles that do not depend on order or partitions (A-4, R-3)."""
import random
from fractions import Fraction

from pyspark.sql import functions as F

from tidyload.functions.numeric import exact_sum


def test_the_same_sum_over_1_and_200_partitions(spark):
    rnd = random.Random(5)
    values = [rnd.choice([-1, 1]) * rnd.random() * 10.0 ** rnd.randrange(-3, 16) for _ in range(4000)]
    values += [-v for v in values[:2000]] + [1e15, 1e-3, -1e15, 0.1, 0.2, -0.3]
    df = spark.createDataFrame([(v, 1 + i % 3) for i, v in enumerate(values)] + [(None, 1)], "x double, n int")
    want = float(sum(Fraction(v) for v in values))
    weighted = float(sum(Fraction(v) * (1 + i % 3) for i, v in enumerate(values)))
    seen = set()
    for parts in (1, 7, 200):
        seen.add(tuple(df.repartition(parts).agg(exact_sum("x"), exact_sum("x", "n")).first()))
    assert len(seen) == 1
    one, two = seen.pop()
    assert abs(one - want) <= 1e-15 * abs(want) and abs(two - weighted) <= 1e-15 * abs(weighted)


def test_edges_of_the_sum(spark):
    sums = lambda values: spark.createDataFrame([(v,) for v in values], "x double").agg(exact_sum("x")).first()[0]
    assert sums([None]) is None and sums([0.0, -0.0]) == 0.0
    assert sums([1e300, 1.0]) == 1e300 and sums([float("inf"), 1.0]) == float("inf")
    assert sums([-1e-20, 1e-20, -2.5]) == -2.5 and sums([2.0 ** 62, -(2.0 ** 62), 0.5]) == 0.5
    assert spark.range(0).select(F.lit(1.0).alias("x")).agg(exact_sum("x")).first()[0] is None
