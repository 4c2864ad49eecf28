import datetime

import pytest
from pyspark.sql import functions as F

from shelfgap.operators.cleaning import (
    clean,
    clean_company_sales,
    clean_competitor_sales,
    clean_seller_catalog,
)
from shelfgap.operators.quality import judge, quality_metrics, split
from shelfgap.plans.jobs import flat_quarantine
from shelfgap.specs import COMPANY_SALES, COMPETITOR_SALES, SELLER_CATALOG

AS_OF = datetime.date(2024, 6, 1)


def text(spark, spec, rows):
    return spark.createDataFrame(rows, spec.text_schema)


CATALOG_ROWS = [
    ("  s1 ", "i1", "men's t-shirt XL", "eLECTRONICS", "9.5", "3"),
    ("s1", "i2", "mug", "home", "NaN", "x"),
    ("s1", "i3", "mug", "home", None, "1"),
    ("s1", "i4", "mug", "home", "-1", "-2"),
    (None, "i5", "mug", "home", "1", "1"),
    ("s1", None, "mug", "home", "1", "1"),
    ("s1", "i7", None, "home", "1", "1"),
    ("s1", "i8", "mug", None, "1", "1"),
    ("s2", "i1", "ant", "home", "1", "1"),
    ("s2", "i1", "bee", "home", "1", "1"),
    ("   ", "i1", "mug", "home", "1", "1"),
]


def reasons(quarantine, column="item_id"):
    return sorted(
        ((r[column], r["dq_failure_reason"]) for r in quarantine.collect()), key=str
    )


def test_catalog(spark):
    cleaned = clean_seller_catalog(text(spark, SELLER_CATALOG, CATALOG_ROWS))
    good, quarantine = split(cleaned, SELLER_CATALOG.rules)
    got = {(r.seller_id, r.item_id): r for r in good.collect()}
    assert set(got) == {("s1", "i1"), ("s1", "i2"), ("s2", "i1"), ("", "i1")}
    first = got["s1", "i1"]
    assert (first.item_name, first.category) == ("Men's T-shirt Xl", "Electronics")
    assert got["s1", "i2"].stock_qty == 0 and got["s1", "i2"].marketplace_price != 0
    assert got["s2", "i1"].item_name == "Bee"
    assert reasons(quarantine) == sorted(
        [
            ("i3", "price_negative"),
            ("i4", "price_negative"),
            ("i4", "stock_negative"),
            ("i5", "seller_id_null"),
            (None, "item_id_null"),
            ("i7", "item_name_null"),
            ("i8", "category_null"),
        ],
        key=str,
    )


def test_null_verdicts(spark):
    cleaned = clean_seller_catalog(text(spark, SELLER_CATALOG, CATALOG_ROWS))
    ignoring = split(cleaned, SELLER_CATALOG.rules, null_policy="ignore")
    assert ("i3", "price_negative") not in reasons(ignoring.quarantine)
    assert ignoring.good.filter("item_id = 'i3'").isEmpty()
    metrics = quality_metrics(judge(cleaned, SELLER_CATALOG.rules, null_policy="ignore")).first()
    assert metrics.unjudged_rows == 1
    assert metrics.good_rows + metrics.rejected_rows + metrics.unjudged_rows == metrics.input_rows
    with pytest.raises(ValueError):
        judge(cleaned, SELLER_CATALOG.rules, null_policy="keep")


def test_company_dates(spark):
    rows = [
        ("i1", "1", "2.0", "2024-06-01"),
        ("i2", "1", "2.0", "2024-06-02"),
        ("i3", "1", "2.0", "2024-02-30"),
        ("i4", "1", "2.0", ""),
        ("i5", "1", "2.0", "2024-1-5"),
        ("i6", "abc", "NaN", "2024-01-05"),
        ("i6", "7", "1.0", "2023-01-05"),
        ("i7", "-3.9", "-0.5", "2024-01-05"),
    ]
    cleaned = clean_company_sales(text(spark, COMPANY_SALES, rows))
    good, quarantine = split(cleaned, COMPANY_SALES.rules, AS_OF)
    got = {r.item_id: r for r in good.collect()}
    assert set(got) == {"i1", "i5", "i6"}
    assert (got["i6"].units_sold, got["i6"].revenue) == (0, 0.0)
    assert reasons(quarantine) == [
        ("i2", "sale_date_invalid"),
        ("i3", "sale_date_invalid"),
        ("i4", "sale_date_invalid"),
        ("i7", "revenue_negative"),
        ("i7", "units_sold_negative"),
    ]
    strict = clean_company_sales(text(spark, COMPANY_SALES, rows), dates="strict")
    assert split(strict, COMPANY_SALES.rules, AS_OF).good.filter("item_id = 'i5'").isEmpty()


def test_repeated_bad_rows_collapse(spark):
    bad = ("s1", "i1", "-1", "1.0", "1.0", "2024-01-01")
    cleaned = clean_competitor_sales(text(spark, COMPETITOR_SALES, [bad, bad]))
    assert cleaned.count() == 2
    quarantine = split(cleaned, COMPETITOR_SALES.rules, AS_OF).quarantine
    assert reasons(quarantine) == [("i1", "units_sold_negative")]


def test_extra_columns_are_dropped_and_missing_ones_fail(spark):
    rows = text(spark, COMPANY_SALES, [("i1", "1", "2.0", "2024-06-01")])
    assert clean_company_sales(rows.withColumn("note", F.lit("x"))).columns == COMPANY_SALES.columns
    with pytest.raises(Exception, match="revenue"):
        clean_company_sales(rows.drop("revenue"))


def test_raw_values_beside_the_reason(spark):
    rows = text(spark, COMPANY_SALES, [(" i1 ", "-1.5", "abc", "2024-06-01")])
    cleaned = clean(rows, COMPANY_SALES, keep_raw=True)
    row = flat_quarantine(split(cleaned, COMPANY_SALES.rules, AS_OF).quarantine).first()
    assert (row.item_id, row.units_sold, row.revenue) == ("i1", -1, 0.0)
    assert (row.raw_item_id, row.raw_units_sold, row.raw_revenue) == (" i1 ", "-1.5", "abc")


def test_one_pass_equals_one_filter_per_rule(spark):
    cleaned = clean_competitor_sales(
        text(
            spark,
            COMPETITOR_SALES,
            [
                (s, i, u, "1.0", p, d)
                for s in ("s1", None)
                for i in ("i1", None)
                for u in ("1", "-1")
                for p in ("1", "-1")
                for d in ("2024-01-01", "2999-01-01", "bad")
            ],
        )
    )
    day = F.lit(AS_OF)
    branches = [
        cleaned.filter(~rule.holds(day)).withColumn("dq_failure_reason", F.lit(rule.reason))
        for rule in COMPETITOR_SALES.rules
    ]
    united = branches[0]
    for branch in branches[1:]:
        united = united.union(branch)
    got = split(cleaned, COMPETITOR_SALES.rules, AS_OF).quarantine
    assert sorted(map(str, got.collect())) == sorted(map(str, united.distinct().collect()))
