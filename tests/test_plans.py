"""The physical plans that matter at scale."""

import re

import pytest

import __spark_entry__ as contract
from contract.registry import REGISTRY
from contract.views import COMPETITOR_LINES, Source
from shelfgap.operators import toplists
from shelfgap.operators.cleaning import typed
from shelfgap.operators.keyed import latest_per_key
from shelfgap.operators.quality import split
from shelfgap.sources import tables
from shelfgap.specs import COMPETITOR_SALES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def src(spark):
    return Source(spark, SF_DIR)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern, text):
    return len(re.findall(pattern, text))


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_query_pairs_everything(spark, name):
    text = plan(REGISTRY[name](spark, SF_DIR))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "InPandas" not in text
    # Windows are split by group, so no task gets a whole table.
    assert "Exchange SinglePartition" not in text or name in ("dq_metrics", "recommendation_counts")


def test_quarantine_reads_its_input_once(src):
    cleaned = typed(src.raw_competitor_sales, COMPETITOR_SALES)
    text = plan(split(cleaned, COMPETITOR_SALES.rules).quarantine)
    assert count("FileScan", text) == 1
    assert count("Exchange hash", text) == 1


def test_rank_limits_come_before_the_shuffle(src):
    top = toplists.company_top_items(src.company_sales, toplists.item_dimension(src.catalog))
    text = plan(top)
    assert count("row_number\\(\\), 10, Partial", text) == 1
    assert count("row_number\\(\\), 10, Final", text) == 1


def test_latest_row_is_combined_before_the_shuffle(src):
    sales = src.all_competitor_sales
    text = plan(latest_per_key(sales, ["seller_id", "item_id"], "sold"))
    assert "partial_max" in text
    assert count("Exchange hash", text) == 1


def test_scans_read_needed_columns_and_filter_early(spark):
    text = plan(REGISTRY["seller_universe"](spark, SF_DIR))
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert all("p_name" not in columns for columns in schema)
    text = plan(REGISTRY["company_top_items"](spark, SF_DIR))
    assert "EqualTo(l_returnflag,N)" in text


def test_recommendations_combine_listings_before_the_shuffle(spark):
    text = plan(REGISTRY["recommendations"](spark, SF_DIR))
    assert "partial_bit_or" in text


def test_long_lists_have_the_same_plan(spark):
    def operators(name):
        return re.findall(r"(\w+(?:Join|Aggregate|Window)\w*) ", plan(REGISTRY[name](spark, SF_DIR)))

    assert operators("recommendations") == operators("recommendations_long_list")


def test_every_line_plays_a_role(src):
    lines = src.table("lineitem")
    roles = ["l_returnflag = 'A' and l_linestatus = 'F'", "l_returnflag = 'N'", COMPETITOR_LINES]
    assert sum(lines.filter(role).count() for role in roles) == lines.count()


def test_gaps_per_seller_and_source_are_bounded(spark):
    found = REGISTRY["all_scored_candidates"](spark, SF_DIR)
    assert found.groupBy("seller_id", "source").count().agg({"count": "max"}).first()[0] <= 10


def test_upsert_reads_touched_buckets_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    rows = spark.range(400).selectExpr("string(id) seller_id", "'i' item_id", "int(id) sale_date")
    tables.write_table(rows, path, COMPETITOR_SALES, buckets=16)
    written = []
    merge = tables.latest_per_key

    def spy(df, key, *more):
        if key[0] == tables._BUCKET:
            written.append({r[0] for r in df.select(tables._BUCKET).distinct().collect()})
        return merge(df, key, *more)

    monkeypatch.setattr(tables, "latest_per_key", spy)
    for k in range(3):
        tables.upsert_table(rows.where(f"seller_id = '{k}'"), path, COMPETITOR_SALES)
    # The first write after a replacement brings the other copy up; a later one writes its own
    # bucket and that of the write before.
    assert [len(b) for b in written] == [2, 2] and len(written[0] & written[1]) == 1
    assert tables.read_table(spark, path).count() == 400
