import random

import pytest
from pyspark.sql import functions as F

from shelfgap.operators import gaps, scoring
from shelfgap.operators.scoring import best_per_seller, recommend, score_company, scored_gaps
from shelfgap.operators.scoring import score_competitor
from shelfgap.sources.staging import Staging


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def catalog_of(spark, pairs):
    return spark.createDataFrame(pairs, "seller_id string, item_id string")


def numbered(spark, names):
    items = spark.createDataFrame([(n, n.upper()) for n in names], "item_id string, label string")
    return gaps.number_items(items, [F.asc("item_id")], Staging(spark))


def random_pairs(seed, sellers, items, share):
    rnd = random.Random(seed)
    pairs = [(s, i) for s in sellers for i in items if rnd.random() < share]
    return pairs + [(s, "elsewhere") for s in sellers]


def brute(pairs, items, n=None):
    held = set(pairs)
    out = []
    for seller in {s for s, _ in pairs}:
        out += [(seller, i, i.upper()) for i in sorted(items) if (seller, i) not in held][:n]
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 10, 70])
@pytest.mark.parametrize(
    "size, share", [(0, 0.5), (1, 0.5), (63, 0.9), (64, 0.97), (150, 0.6), (700, 0.99), (2500, 0.999)]
)
def test_gaps_equal_brute_force(spark, size, share, n):
    items = [f"i{k:04}" for k in range(size)]
    pairs = random_pairs(size, [f"s{k}" for k in range(12)], items, share)
    pairs += [("all", i) for i in items] + [("all", "elsewhere"), ("none", "elsewhere")]
    pairs += [("ends", i) for i in items[:64] + items[-64:]] + [("middle", i) for i in items[64:300]]
    ranked = numbered(spark, items)
    assert ranked.size == size
    assert rows(gaps.first_gaps(catalog_of(spark, pairs), ranked, n)) == brute(pairs, items, n)


def test_seller_that_lists_a_third_of_everything(spark):
    items = [f"i{k:04}" for k in range(700)]
    pairs = [("hot", i) for i in items if i != "i0555"] + [("s", "i0001"), ("s", "x")]
    catalog = catalog_of(spark, pairs + pairs).repartition(6)
    assert rows(gaps.first_gaps(catalog, numbered(spark, items), 10)) == brute(pairs, items, 10)


def test_null_seller_lists_nothing(spark):
    items = ["a", "b", "c"]
    catalog, ranked = catalog_of(spark, [(None, "a"), ("s", "b")]), numbered(spark, items)
    want = sorted(
        [(None, i, i.upper()) for i in items] + [("s", "a", "A"), ("s", "c", "C")], key=str
    )
    assert rows(gaps.first_gaps(catalog, ranked, 10)) == want


def test_numbers_over_many_range_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        scores = [(f"i{k}", k % 7) for k in range(500)]
        items = spark.createDataFrame(scores, "item_id string, score int")
        order = [F.desc("score"), F.asc("item_id")]
        ranked = gaps.number_items(items, order, Staging(spark))
        assert ranked.size == 500
        got = [tuple(r) for r in ranked.rows.orderBy("position").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(scores, key=lambda r: (-r[1], r[0]))
    assert got == [(i, s, k + 1) for k, (i, s) in enumerate(want)]


def test_without_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        items = [f"i{k:03}" for k in range(130)]
        pairs = random_pairs(5, [f"s{k}" for k in range(9)], items, 0.8)
        first = gaps.first_gaps(catalog_of(spark, pairs), numbered(spark, items), 10)
        assert rows(first) == brute(pairs, items, 10)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


COMPANY_TOP = (
    "item_id string, item_name string, category string, units_sold int, revenue double, rank int"
)
COMPETITOR_TOP = (
    "item_id string, item_name string, category string, total_units_sold bigint,"
    "total_revenue double, avg_marketplace_price double, num_sellers bigint, rank int"
)


def top_lists(spark):
    company = [("a", "A", "x", 2, 5.0, 1), ("b", "B", "x", 1, 5.0, 2), ("z", "Z", "y", 9, 1.0, 1)]
    competitor = [
        ("a", "A", "x", 30, 1.0, 2.0, 3, 1),
        ("b", "B", "x", 4, 1.0, 5.0, 4, 2),
        ("u", None, None, 7, 1.0, None, 1, 1),
    ]
    return (
        spark.createDataFrame(company, COMPANY_TOP),
        spark.createDataFrame(competitor, COMPETITOR_TOP),
    )


def test_recommendations_from_both_sources(spark):
    company, competitor = top_lists(spark)
    catalog = catalog_of(spark, [("s1", "z"), ("s2", "a"), ("s2", "b")])
    got = recommend(catalog, company, competitor, Staging(spark))
    assert [f.simpleString() for f in got.schema] == [
        "seller_id:string",
        "item_id:string",
        "item_name:string",
        "category:string",
        "market_price:double",
        "expected_units_sold:double",
        "expected_revenue:double",
    ]
    assert rows(got) == sorted(
        [
            ("s1", "a", "A", "x", 2.0, 10.0, 20.0),
            ("s1", "a", "A", "x", 5.0, 2.0, 10.0),
            ("s1", "b", "B", "x", 5.0, 1.0, 5.0),
            ("s1", "b", "B", "x", 5.0, 1.0, 5.0),
            ("s1", "u", None, None, None, 7.0, None),
            ("s2", "z", "Z", "y", 1.0, 9.0, 9.0),
            ("s2", "u", None, None, None, 7.0, None),
        ],
        key=str,
    )
    # The same rows by way of the best of either source.
    own, others = score_company(company), score_competitor(competitor)
    each = [scored_gaps(catalog, scored, Staging(spark)) for scored in (own, others)]
    assert rows(best_per_seller(each[0].unionByName(each[1]))) == rows(got)


def test_ties_go_to_the_smaller_item(spark):
    company = [(f"i{k:02}", "n", "c", 1, 1.0, k) for k in range(12)]
    company = spark.createDataFrame(company, COMPANY_TOP)
    nothing = top_lists(spark)[1].limit(0)
    got = recommend(catalog_of(spark, [("s", "x")]), company, nothing, Staging(spark))
    assert [r.item_id for r in got.orderBy("item_id").collect()] == [f"i{k:02}" for k in range(10)]


def test_no_gaps_and_no_items(spark):
    company, competitor = top_lists(spark)
    full = catalog_of(spark, [("s", i) for i in "abzu"])
    assert recommend(full, company, competitor, Staging(spark)).isEmpty()
    none = recommend(full, company.limit(0), competitor.limit(0), Staging(spark))
    assert none.isEmpty() and len(none.columns) == 7
    assert recommend(full.limit(0), company, competitor, Staging(spark)).isEmpty()


def test_unknown_price_basis(spark):
    with pytest.raises(ValueError):
        scoring.score_company(top_lists(spark)[0], "list")
