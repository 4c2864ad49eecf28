"""Expected revenue of a gap and the final list per seller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfgap.operators.gaps import first_gaps, number_items
from shelfgap.operators.ranking import top_n_per_group
from shelfgap.operators.toplists import TOP_N
from shelfgap.sources.staging import Staging

COMPANY = "company"
COMPETITOR = "competitor"
_ITEM_COLUMNS = ["item_id", "item_name", "category"]
_SCORES = ["market_price", "expected_units_sold", "expected_revenue"]


def score_company(rows: DataFrame, price_basis: str = "revenue") -> DataFrame:
    """Scores from own sales. The price is the item's revenue (``revenue``) or its mean
    catalog price (``unit``); the other columns of ``rows`` stay in front."""
    prices = {"revenue": "revenue", "unit": "unit_price"}
    if price_basis not in prices:
        raise ValueError(f"price basis must be one of {sorted(prices)}, not {price_basis!r}")
    units = F.col("units_sold").cast("double")
    price = F.col(prices[price_basis])
    return _scored(rows, price, units, COMPANY)


def score_competitor(rows: DataFrame) -> DataFrame:
    """Scores from competitor sales: units per selling competitor at their mean price."""
    units = F.try_divide(F.col("total_units_sold"), F.col("num_sellers"))
    return _scored(rows, F.col("avg_marketplace_price"), units, COMPETITOR)


def _scored(rows: DataFrame, price, units, source: str) -> DataFrame:
    seller = ["seller_id"] if "seller_id" in rows.columns else []
    return rows.select(
        *seller,
        *_ITEM_COLUMNS,
        price.alias("market_price"),
        units.alias("expected_units_sold"),
        (units * price).alias("expected_revenue"),
        F.lit(source).alias("source"),
    )


def _best_first():
    return [F.desc_nulls_last("expected_revenue"), F.asc("item_id"), F.asc("source")]


def scored_gaps(catalog: DataFrame, scored: DataFrame, staging: Staging, n: int = TOP_N) -> DataFrame:
    """The ``n`` best of the scored items that each seller does not list, with all columns of
    ``scored``. A score belongs to the item alone, so the items are one list for all sellers."""
    items = number_items(scored, _best_first(), staging)
    return first_gaps(catalog, items, n)


def best_per_seller(scored: DataFrame, n: int = TOP_N) -> DataFrame:
    """The ``n`` gaps of highest expected revenue for each seller, from scored gaps."""
    best = top_n_per_group(scored, ["seller_id"], _best_first(), n)
    return best.select("seller_id", *_ITEM_COLUMNS, *_SCORES)


def recommend(
    catalog: DataFrame,
    company_top: DataFrame,
    competitor_top: DataFrame,
    staging: Staging,
    n: int = TOP_N,
    price_basis: str = "revenue",
) -> DataFrame:
    """The ``n`` best unlisted items of both sources for each seller, without making all gaps: the
    scored top items are one list, best first, and a seller's recommendations are the first ``n``
    items of the list that it does not list.
    """
    scored = score_company(company_top, price_basis).unionByName(score_competitor(competitor_top))
    found = scored_gaps(catalog, scored, staging, n)
    return found.select("seller_id", *_ITEM_COLUMNS, *_SCORES)
