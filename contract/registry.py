"""Registered queries: name to a function of (spark, directory of the given tables)."""

from __future__ import annotations

import atexit
import contextlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.views import Source
from shelfgap.functions import parsing
from shelfgap.operators import gaps, scoring, toplists
from shelfgap.operators.cleaning import clean, typed
from shelfgap.operators.keyed import latest_per_key, merge_latest
from shelfgap.operators.quality import REASON, ROW_MALFORMED, judge, quality_metrics, split
from shelfgap.plans import jobs
from shelfgap.plans.config import DatasetPaths, JobConfig, ResultPaths
from shelfgap.sources.staging import Staging
from shelfgap.sources.tables import read_table, upsert_table, write_table
from shelfgap.sources.text import MALFORMED, read_text, write_text
from shelfgap.specs import (
    CATEGORY_LABELS,
    COMPANY_SALES,
    COMPETITOR_SALES,
    RECOMMENDATION_SCHEMA,
    SELLER_CATALOG,
    DatasetSpec,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
    REGISTRY[build.__name__] = lambda spark, sf_dir: build(Source(spark, sf_dir))
    return build


def _staging(src: Source) -> Staging:
    """A folder for one query, which is removed when the process ends: its result is lazy."""
    staging = Staging(src.spark)
    atexit.register(_clear, staging)
    return staging


def _clear(staging: Staging) -> None:
    with contextlib.suppress(Exception):  # the session may be gone
        staging.clear()


# Parsing of text columns.


@query
def trimmed_ids(src: Source) -> DataFrame:
    ids = [F.col("seller_id"), F.col("item_id")]
    return src.raw_catalog.select(
        *ids, *[parsing.trimmed(c).alias(n) for c, n in zip(ids, ("seller", "item"))]
    )


@query
def title_case_names(src: Source) -> DataFrame:
    name = F.col("item_name")
    return src.raw_catalog.select(name, parsing.title_case(parsing.trimmed(name)).alias("title"))


@query
def canonical_category(src: Source) -> DataFrame:
    text = F.col("category")
    label = parsing.canonical_label(parsing.trimmed(text), CATEGORY_LABELS)
    return src.raw_catalog.select(text, label.alias("label"))


@query
def parse_int_lenient(src: Source) -> DataFrame:
    text = F.col("units_sold")
    return src.raw_company_sales.select(text, parsing.to_int(text).alias("units"))


@query
def parse_double(src: Source) -> DataFrame:
    text = F.col("marketplace_price")
    return src.raw_competitor_sales.select(text, parsing.to_double(text).alias("price"))


@query
def parse_date(src: Source) -> DataFrame:
    text = F.col("sale_date")
    return src.raw_company_sales.select(text, parsing.to_day(text).alias("day"))


@query
def parse_date_strict(src: Source) -> DataFrame:
    text = F.col("sale_date")
    return src.raw_company_sales.select(text, parsing.to_day(text, "strict").alias("day"))


@query
def fill_defaults(src: Source) -> DataFrame:
    units, revenue = F.col("units_sold"), F.col("revenue")
    return src.raw_company_sales.select(
        units,
        revenue,
        parsing.filled(parsing.to_int(units), 0).alias("units"),
        parsing.filled(parsing.to_double(revenue), 0.0).alias("amount"),
    )


# Cleaning, rules and quarantine of the three datasets.


def _raw(src: Source, spec: DatasetSpec) -> DataFrame:
    return {
        "seller_catalog": lambda: src.raw_catalog,
        "company_sales": lambda: src.raw_company_sales,
        "competitor_sales": lambda: src.raw_competitor_sales,
    }[spec.name]()


def _cleaned(src: Source, spec: DatasetSpec) -> DataFrame:
    return clean(_raw(src, spec), spec)


@query
def typed_catalog(src: Source) -> DataFrame:
    return typed(src.raw_catalog, SELLER_CATALOG)


@query
def clean_catalog(src: Source) -> DataFrame:
    return _cleaned(src, SELLER_CATALOG)


@query
def clean_company_sales(src: Source) -> DataFrame:
    return _cleaned(src, COMPANY_SALES)


@query
def clean_competitor_sales(src: Source) -> DataFrame:
    return _cleaned(src, COMPETITOR_SALES)


@query
def dedup_catalog(src: Source) -> DataFrame:
    """One line per supplier and part, the one of the greatest status."""
    lines = src.table("lineitem").select(
        "l_suppkey", "l_partkey", "l_linestatus", "l_returnflag", "l_quantity"
    )
    return latest_per_key(lines, ["l_suppkey", "l_partkey"], "l_linestatus")


@query
def dedup_company_sales(src: Source) -> DataFrame:
    """One line per part, the newest."""
    lines = src.table("lineitem").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_quantity", "l_extendedprice"
    ).withColumn("l_shipdate", F.to_date("l_shipdate"))
    return latest_per_key(lines, ["l_partkey"], "l_shipdate")


def _split(src: Source, spec: DatasetSpec, null_policy: str = "reject"):
    keyed = spec.one_row_per_key_before_rules
    return split(_cleaned(src, spec), spec.rules, null_policy=null_policy, distinct_rows=keyed)


@query
def dq_catalog_good(src: Source) -> DataFrame:
    return _split(src, SELLER_CATALOG).good


@query
def dq_catalog_quarantine(src: Source) -> DataFrame:
    return _split(src, SELLER_CATALOG).quarantine


@query
def dq_catalog_quarantine_nulls_ignored(src: Source) -> DataFrame:
    return _split(src, SELLER_CATALOG, "ignore").quarantine


@query
def dq_company_good(src: Source) -> DataFrame:
    return _split(src, COMPANY_SALES).good


@query
def dq_company_quarantine(src: Source) -> DataFrame:
    return _split(src, COMPANY_SALES).quarantine


@query
def dq_competitor_good(src: Source) -> DataFrame:
    return _split(src, COMPETITOR_SALES).good


@query
def dq_competitor_quarantine(src: Source) -> DataFrame:
    return _split(src, COMPETITOR_SALES).quarantine


def _metrics(src: Source, spec: DatasetSpec, null_policy: str) -> DataFrame:
    judged = judge(_cleaned(src, spec), spec.rules, null_policy=null_policy)
    return quality_metrics(judged).select(F.lit(spec.name).alias("dataset"), "*")


@query
def dq_metrics(src: Source) -> DataFrame:
    return (
        _metrics(src, SELLER_CATALOG, "ignore")
        .unionByName(_metrics(src, COMPANY_SALES, "reject"))
        .unionByName(_metrics(src, COMPETITOR_SALES, "reject"))
    )


@query
def quarantine_with_raw(src: Source) -> DataFrame:
    cleaned = clean(src.raw_competitor_sales, COMPETITOR_SALES, keep_raw=True)
    return jobs.flat_quarantine(split(cleaned, COMPETITOR_SALES.rules).quarantine)


# Keyed tables.


@query
def latest_per_key_competitor(src: Source) -> DataFrame:
    good = _split(src, COMPETITOR_SALES).good
    return latest_per_key(good, COMPETITOR_SALES.key, COMPETITOR_SALES.version)


def _sales_by_status(src: Source, status: str) -> DataFrame:
    return src.table("lineitem").filter(F.col("l_linestatus") == status).select(
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").cast("int").alias("units_sold"),
        F.col("l_extendedprice").alias("revenue"),
        F.col("l_tax").alias("tax"),
        F.to_date("l_shipdate").alias("sale_date"),
    )


@query
def merge_latest_sales(src: Source) -> DataFrame:
    existing = _sales_by_status(src, "F")
    return merge_latest(
        existing, _sales_by_status(src, "O"), ["seller_id", "item_id"], "sale_date"
    )


@query
def merge_evolved(src: Source) -> DataFrame:
    existing = _sales_by_status(src, "F").drop("tax")
    incoming = _sales_by_status(src, "O").drop("revenue")
    return merge_latest(existing, incoming, ["seller_id", "item_id"], "sale_date", evolve=True)


def _narrow(sales: DataFrame) -> DataFrame:
    """The same sales with smaller types, as another system may deliver them."""
    return sales.withColumns(
        {
            "seller_id": F.col("seller_id").cast("int"),
            "units_sold": F.col("units_sold").cast("smallint"),
            "tax": F.col("tax").cast("float"),
        }
    )


@query
def merge_widened(src: Source) -> DataFrame:
    """A narrow table takes a wide delivery and becomes wide."""
    existing, incoming = _narrow(_sales_by_status(src, "F")), _sales_by_status(src, "O")
    return merge_latest(existing, incoming, ["seller_id", "item_id"], "sale_date", evolve=True)


@query
def upserted_table(src: Source) -> DataFrame:
    path = _staging(src).new_path()
    write_table(_sales_by_status(src, "F"), path, COMPETITOR_SALES)
    upsert_table(_sales_by_status(src, "O"), path, COMPETITOR_SALES)
    return read_table(src.spark, path)


@query
def upserted_in_parts(src: Source) -> DataFrame:
    """A bucketed table that takes narrower and wider deliveries in turn."""
    path = _staging(src).new_path()
    write_table(_narrow(_sales_by_status(src, "F")), path, COMPETITOR_SALES, buckets=8)
    later = _sales_by_status(src, "O")
    for k, part in enumerate([later, _narrow(later), later]):
        upsert_table(part.where(F.col("item_id") % 3 == k), path, COMPETITOR_SALES, evolve=True)
    return read_table(src.spark, path)


# Steps towards the recommendations.


@query
def item_dimension(src: Source) -> DataFrame:
    """Items as raw catalog rows name them; sellers disagree there."""
    return toplists.item_dimension(typed(src.raw_catalog, SELLER_CATALOG))


@query
def item_unit_prices(src: Source) -> DataFrame:
    return toplists.item_dimension(typed(src.raw_catalog, SELLER_CATALOG), unit_price=True)


@query
def held_pairs(src: Source) -> DataFrame:
    return gaps.held_pairs(typed(src.raw_catalog, SELLER_CATALOG))


@query
def seller_universe(src: Source) -> DataFrame:
    return gaps.seller_universe(typed(src.raw_catalog, SELLER_CATALOG))


def _items(src: Source, unit_price: bool = False) -> DataFrame:
    return toplists.item_dimension(src.catalog, unit_price)


@query
def company_sales_enriched(src: Source) -> DataFrame:
    return toplists.enrich_company_sales(src.company_sales, _items(src))


@query
def competitor_item_totals(src: Source) -> DataFrame:
    return toplists.competitor_item_totals(src.all_competitor_sales)


@query
def competitor_sales_enriched(src: Source) -> DataFrame:
    totals = toplists.competitor_item_totals(src.competitor_sales)
    return toplists.enrich_competitor_totals(totals, _items(src))


def _company_top(src: Source, unit_price: bool = False) -> DataFrame:
    return toplists.company_top_items(src.company_sales, _items(src, unit_price))


def _competitor_top(src: Source) -> DataFrame:
    return toplists.competitor_top_items(src.competitor_sales, _items(src))


@query
def company_top_items(src: Source) -> DataFrame:
    return _company_top(src)


@query
def competitor_top_items(src: Source) -> DataFrame:
    return _competitor_top(src)


def _company_scored(src: Source) -> DataFrame:
    return scoring.score_company(_company_top(src))


def _competitor_scored(src: Source) -> DataFrame:
    return scoring.score_competitor(_competitor_top(src))


def _first_gaps(src: Source, scored: DataFrame, n: int = toplists.TOP_N) -> DataFrame:
    return scoring.scored_gaps(src.catalog, scored, _staging(src), n)


@query
def company_gaps(src: Source) -> DataFrame:
    """The ten best company items that each seller does not list."""
    found = _first_gaps(src, _company_scored(src))
    return found.select("seller_id", "item_id", "item_name", "category", "source")


@query
def competitor_gaps(src: Source) -> DataFrame:
    found = _first_gaps(src, _competitor_scored(src))
    return found.select("seller_id", "item_id", "item_name", "category", "source")


@query
def company_scored(src: Source) -> DataFrame:
    return _first_gaps(src, _company_scored(src))


@query
def competitor_scored(src: Source) -> DataFrame:
    return _first_gaps(src, _competitor_scored(src))


def _scored(src: Source) -> DataFrame:
    found = (_first_gaps(src, scored(src)) for scored in (_company_scored, _competitor_scored))
    return next(found).unionByName(next(found))


@query
def all_scored_candidates(src: Source) -> DataFrame:
    """The ten best of either source for each seller."""
    return _scored(src)


@query
def best_per_seller(src: Source) -> DataFrame:
    return scoring.best_per_seller(_scored(src))


LONG_LIST = 400  # items per category, which make more than 4,000 in all


@query
def recommendations_long_list(src: Source) -> DataFrame:
    """The flagship over long top lists."""
    company = toplists.company_top_items(src.company_sales, _items(src), LONG_LIST)
    competitor = toplists.competitor_top_items(src.competitor_sales, _items(src), LONG_LIST)
    return scoring.recommend(src.catalog, company, competitor, _staging(src))


@query
def recommendations(src: Source) -> DataFrame:
    """The flagship: the ten unlisted items of highest expected revenue for each seller."""
    staging = _staging(src)
    return scoring.recommend(src.catalog, _company_top(src), _competitor_top(src), staging)


@query
def recommendations_unit_price(src: Source) -> DataFrame:
    staging = _staging(src)
    top = _company_top(src, unit_price=True)
    return scoring.recommend(src.catalog, top, _competitor_top(src), staging, price_basis="unit")


# Files and whole runs.


@query
def csv_round_trip(src: Source) -> DataFrame:
    path = _staging(src).new_path()
    write_text(src.raw_catalog, path)
    return read_text(src.spark, path)


@query
def parquet_round_trip(src: Source) -> DataFrame:
    path = _staging(src).new_path()
    write_table(_split(src, COMPETITOR_SALES).good, path, COMPETITOR_SALES)
    return read_table(src.spark, path)


@query
def bronze_round_trip(src: Source) -> DataFrame:
    """The raw text as an ingest keeps it."""
    paths = _ingested(src, COMPETITOR_SALES, jobs.Options())
    return src.spark.read.parquet(paths.bronze).drop(MALFORMED)


@query
def quarantine_round_trip(src: Source) -> DataFrame:
    """The quarantine as an ingest writes it."""
    paths = _ingested(src, COMPETITOR_SALES, jobs.Options(quarantine_format="parquet"))
    return src.spark.read.parquet(paths.quarantine).drop(MALFORMED)


@query
def malformed_quarantine(src: Source) -> DataFrame:
    """Lines of too few or too many values in the quarantine of an ingest, with their text."""
    root = _staging(src).new_path()
    paths = DatasetPaths(f"{root}/in", f"{root}/table", f"{root}/quarantine")
    src.write_uneven_lines(paths.input)
    jobs.ingest(src.spark, COMPANY_SALES, paths, jobs.Options(quarantine_format="parquet"))
    found = src.spark.read.parquet(paths.quarantine)
    return found.where(F.col(REASON) == ROW_MALFORMED).select(MALFORMED, REASON)


@query
def even_lines_table(src: Source) -> DataFrame:
    """The table that the same ingest makes of the lines that are not malformed."""
    root = _staging(src).new_path()
    paths = DatasetPaths(f"{root}/in", f"{root}/table", f"{root}/quarantine")
    src.write_uneven_lines(paths.input)
    jobs.ingest(src.spark, COMPANY_SALES, paths, jobs.Options(quarantine_format="parquet"))
    return read_table(src.spark, paths.table)


@query
def incremental_table(src: Source) -> DataFrame:
    """Three deliveries to one folder, each ingest reading the files that are new; the last one finds
    none."""
    root = _staging(src).new_path()
    paths = DatasetPaths(f"{root}/in", f"{root}/table", f"{root}/quarantine", ledger=f"{root}/ledger")
    options = jobs.Options(write="upsert", incremental=True)
    for k in range(3):
        part = src.raw_competitor_sales.where(f"pmod(hash(item_id), 3) = {k}")
        write_text(part, f"{paths.input}/{k}")
        jobs.ingest(src.spark, COMPETITOR_SALES, paths, options)
    jobs.ingest(src.spark, COMPETITOR_SALES, paths, options)
    return read_table(src.spark, paths.table)


@query
def line_break_round_trip(src: Source) -> DataFrame:
    """Text with line breaks, quotes and empty values through CSV files."""
    path = _staging(src).new_path()
    write_text(src.broken_lines, path)
    return read_text(src.spark, path, line_breaks=True)


@query
def replayed_table(src: Source) -> DataFrame:
    """A table made again from the bronze copies of two load days, the later one first."""
    root = _staging(src).new_path()
    paths = DatasetPaths(
        f"{root}/in", f"{root}/table", f"{root}/quarantine", f"{root}/bronze", f"{root}/ledger"
    )
    days = ["2100-01-01", "2100-01-02"]
    for k, day in enumerate(days):
        part = src.raw_competitor_sales.where(f"pmod(hash(item_id), 2) = {k}")
        write_text(part, f"{paths.input}/{k}")
        options = jobs.Options(write="upsert", incremental=True, as_of=day)
        jobs.ingest(src.spark, COMPETITOR_SALES, paths, options)
    again = replace(paths, table=f"{root}/again")
    for day in reversed(days):
        jobs.replay(src.spark, COMPETITOR_SALES, again, day)
    return read_table(src.spark, again.table)


def _ingested(src: Source, spec: DatasetSpec, options: jobs.Options) -> DatasetPaths:
    root = _staging(src).new_path()
    paths = DatasetPaths(f"{root}/in", f"{root}/table", f"{root}/quarantine", f"{root}/bronze")
    write_text(_raw(src, spec), paths.input)
    jobs.ingest(src.spark, spec, paths, options)
    return paths


@query
def recommendation_counts(src: Source) -> DataFrame:
    """What the recommendation job reports: rows in, top items and rows out."""
    tables = {
        "seller_catalog": src.catalog,
        "company_sales": src.company_sales,
        "competitor_sales": src.competitor_sales,
    }
    return jobs.recommend_with_report(tables, _staging(src))[1]


@query
def cleaned_recommendations(src: Source) -> DataFrame:
    """Raw text to recommendations, by staged tables."""
    staging = _staging(src)
    competitor = _split(src, COMPETITOR_SALES).good
    return jobs.recommendations(
        staging.save(_split(src, SELLER_CATALOG).good),
        _split(src, COMPANY_SALES).good,
        latest_per_key(competitor, COMPETITOR_SALES.key, COMPETITOR_SALES.version),
        staging,
    )


@query
def whole_run(src: Source) -> DataFrame:
    """The same through the jobs: CSV files in, tables and quarantine, result CSV out."""
    root = _staging(src).new_path()
    datasets = {}
    for spec in (SELLER_CATALOG, COMPANY_SALES, COMPETITOR_SALES):
        paths = DatasetPaths(
            input=f"{root}/in/{spec.name}",
            table=f"{root}/tables/{spec.name}",
            quarantine=f"{root}/quarantine/{spec.name}",
        )
        write_text(_raw(src, spec), paths.input)
        datasets[spec.name] = paths
    tables = {name: paths.table for name, paths in datasets.items()}
    jobs.run_all(src.spark, JobConfig(datasets, ResultPaths(tables, f"{root}/result")))
    result = read_text(src.spark, f"{root}/result")
    return result.select(*[F.col(f.name).cast(f.dataType) for f in RECOMMENDATION_SCHEMA])
