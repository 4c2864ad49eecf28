import math
import random

import pytest
from pyspark.sql import functions as F

from shelfgap.functions.exact import totals


def added(spark, values, parts=3):
    """Sum and mean; each value with a key of its own for the shuffle."""
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    row = totals(df, [], {"s": F.col("v")}, {"m": F.col("v")}, {"n": (F.count("v"), F.sum)}).first()
    return row["s"], row["m"]


def close_rows(spark, groups):
    """The sums of many groups at once."""
    data = [(k, v) for k, values in enumerate(groups) for v in values]
    df = spark.createDataFrame(data, "k int, v double").repartition(4)
    found = {r["k"]: r["s"] for r in totals(df, ["k"], {"s": F.col("v")}).collect()}
    return [found[k] for k in range(len(groups))]


def test_sums_are_exact_and_rounded_once(spark):
    assert added(spark, [0.1] * 10) == (1.0, 0.1)
    assert added(spark, [0.1, 0.2, None]) == (0.1 + 0.2, (0.1 + 0.2) / 2)
    assert added(spark, [1 / 3] * 3)[0] == math.fsum([1 / 3] * 3)
    assert added(spark, [1e300, 1.0, -1e300])[0] == 1.0
    assert added(spark, [1e300, 1e-300, -1e300])[0] == 1e-300
    assert added(spark, [5e-324] * 3)[0] == 1.5e-323
    assert added(spark, [1.7e308, 1e308, -1.7e308])[0] == 1e308
    assert added(spark, [8.9e9] * 2000)[0] == 8.9e9 * 2000
    assert added(spark, [-2.5, 2.5])[0] == 0.0


def test_values_that_are_no_numbers(spark):
    inf = float("inf")
    assert math.isnan(added(spark, [float("nan"), 1.0])[0])
    assert math.isnan(added(spark, [inf, -inf, 1.0])[0])
    assert added(spark, [inf, 1.0, inf])[0] == inf
    assert added(spark, [1.7e308] * 9)[0] == inf


def test_no_values(spark):
    assert added(spark, [None, None]) == (None, None)
    assert added(spark, [0.0, None]) == (0.0, 0.0)


def test_the_order_does_not_matter(spark):
    rnd = random.Random(1)
    values = [1e300, -1e300, 1e-300, 3e-300] + [round(rnd.uniform(-1e6, 1e6), 7) for _ in range(500)]
    values += [rnd.uniform(-1, 1) * 2.0 ** rnd.randint(-1000, 1000) for _ in range(300)]
    want = math.fsum(values)
    for k in range(20):
        rnd.shuffle(values)
        assert added(spark, values, parts=1 + k % 7)[0].hex() == want.hex()


def odd_doubles(rnd, n):
    """Values whose sums cancel, tie and span many bins."""
    values = []
    for _ in range(n):
        v = rnd.choice([1.0, 0.1, 2.0**53, 1 / 3, rnd.random(), float(rnd.randrange(1 << 60)), 5e-324, 1e300])
        v *= 2.0 ** rnd.choice([0, 0, 0, -1, -53, -54, 64, rnd.randint(-60, 60), rnd.randint(-900, 20)])
        values.append(rnd.choice([v, -v]) if abs(v) < 1e302 else 1e300)
    return values + [-v for v in values if rnd.random() < 0.3]


def test_any_doubles(spark):
    rnd = random.Random(7)
    groups = [odd_doubles(rnd, rnd.randint(1, 8)) for _ in range(3000)]
    groups += [[2.0**60, 2.0**7, x] for x in (0.0, 5e-324, -5e-324, 1.0, -1.0)]
    wrong = [(g, x) for g, x in zip(groups, close_rows(spark, groups)) if x != math.fsum(g)]
    assert not wrong, wrong[:5]


@pytest.mark.parametrize("power", [-1074, -1023, -1022, -33, -32, -31, 0, 31, 32, 33, 63, 64, 1022])
def test_the_edges_of_bins(spark, power):
    edge = 2.0**power
    groups = [[edge, edge], [edge, math.nextafter(edge, 0)], [math.nextafter(edge, math.inf), -edge], [edge, 1.0, -0.5]]
    assert close_rows(spark, groups) == [math.fsum(g) for g in groups]
