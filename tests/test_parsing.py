import datetime

import pytest
from pyspark.sql import functions as F

from shelfgap.functions import parsing
from shelfgap.specs import CATEGORY_LABELS


def evaluate(spark, values, build):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(build(F.col("v"))).collect()]


def test_trim_takes_spaces_only(spark):
    got = evaluate(spark, ["  A1 ", "   ", "\tA1", None], parsing.trimmed)
    assert got == ["A1", "", "\tA1", None]


def test_title_case(spark):
    got = evaluate(spark, ["men's t-shirt XL", "", None], parsing.title_case)
    assert got == ["Men's T-shirt Xl", "", None]


def test_canonical_label(spark):
    got = evaluate(
        spark,
        ["eLECTRONICS", "footwear", "toys & games", None],
        lambda c: parsing.canonical_label(c, CATEGORY_LABELS),
    )
    assert got == ["Electronics", "Footwear", "Toys & Games", None]


INTS = [
    ("12", 12),
    (" 12 ", 12),
    ("12.7", 12),
    (".5", 0),
    ("-3.9", -3),
    ("+4", 4),
    ("007", 7),
    ("0.99999999999999999999999", 0),
    (".", 0),
    ("abc", None),
    ("1e3", None),
    ("", None),
    ("-", None),
    ("1.2.3", None),
    ("\t12.7\n", 12),
    ("1-.5", None),
    ("1.-5", None),
    ("-.", 0),
    ("3000000000", None),
    ("99999999999999999999999999999999999999999999.5", None),
    (None, None),
]

DOUBLES = [
    ("1.5", 1.5),
    ("1e3", 1000.0),
    ("5d", 5.0),
    ("Infinity", float("inf")),
    ("1,000", None),
    ("abc", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        texts, wanted = zip(*INTS)
        assert evaluate(spark, texts, parsing.to_int) == list(wanted)
        texts, wanted = zip(*DOUBLES)
        assert evaluate(spark, texts, parsing.to_double) == list(wanted)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


DAY = datetime.date(2024, 1, 5)
DATES = [
    ("2024-01-05", DAY, DAY),
    ("2024-1-5", DAY, None),
    (" 2024-01-05", DAY, None),
    ("2024-01-05xyz", DAY, None),
    ("24-01-05", datetime.date(24, 1, 5), None),
    ("2024-02-30", None, None),
    ("05-01-2024", None, None),
    ("2024-01", None, None),
    ("2024", None, None),
    ("+2024-01-05", None, None),
    ("-2024-01-05", None, None),
    ("2024-01-05T10:00", DAY, None),
    ("2024-01-05-07", DAY, None),
    ("2024-001-05", DAY, None),
    ("2024-01-055", None, None),
    ("bad", None, None),
    ("", None, None),
    (None, None, None),
]


def test_dates(spark):
    texts, lenient, strict = zip(*DATES)
    assert evaluate(spark, texts, parsing.to_day) == list(lenient)
    assert evaluate(spark, texts, lambda c: parsing.to_day(c, "strict")) == list(strict)
    with pytest.raises(ValueError):
        parsing.to_day(F.col("v"), "loose")


def test_filled(spark):
    as_double = lambda c: parsing.filled(parsing.to_double(c), 0.0)
    assert evaluate(spark, ["NaN", "abc", "2.5", None], as_double) == [0.0, 0.0, 2.5, 0.0]
    as_int = lambda c: parsing.filled(parsing.to_int(c), 0)
    assert evaluate(spark, ["x", "7", None], as_int) == [0, 7, 0]


def test_no_caps(spark):
    """Leading zeros without limit, hexadecimal fractions and far years, as a plain cast takes them."""
    zeros = "0" * 30
    texts = [f"{zeros}12", f"+{zeros}12.7", f"-{zeros}3.9", f"{zeros}3000000000", "1" * 25, "0x1p3",
             " -0X1.8p1d ", "0x1", "12345-01-02", "12345-1-2 x", "0012345-01-02", "12345678-01-01"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    got = df.select(
        parsing.to_int(t).alias("i"), parsing.to_double(t).alias("d"), parsing.to_day(t).cast("string").alias("y")
    ).collect()
    assert [r.i for r in got[:5]] == [12, 12, -3, None, None]
    assert [r.d for r in got[5:8]] == [8.0, -3.0, None]
    assert [r.y for r in got[8:]] == ["+12345-01-02", "+12345-01-02", "+12345-01-02", None]
