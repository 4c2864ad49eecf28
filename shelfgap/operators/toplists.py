"""Best-selling items per category, from own sales and from competitor sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfgap.functions.exact import totals
from shelfgap.operators.ranking import top_n_per_group

TOP_N = 10


def item_dimension(catalog: DataFrame, unit_price: bool = False) -> DataFrame:
    """One name and category per item: the smallest category, then name, any seller gives it; a
    missing one only if no seller gives any.

    With ``unit_price`` also the item's mean price over all sellers.
    """
    named = [F.isnull("category").alias("no_category"), "category"]
    named += [F.isnull("item_name").alias("no_name"), "item_name"]
    chosen = F.min(F.struct(*named))
    if unit_price:
        means = {"unit_price": F.col("marketplace_price")}
        items = totals(catalog, ["item_id"], means=means, others={"chosen": (chosen, F.min)})
    else:
        items = catalog.groupBy("item_id").agg(chosen.alias("chosen"))
    return items.select(
        "item_id",
        F.col("chosen.item_name").alias("item_name"),
        F.col("chosen.category").alias("category"),
        *(["unit_price"] if unit_price else []),
    )


def enrich_company_sales(sales: DataFrame, items: DataFrame) -> DataFrame:
    """Sales of catalogued items with name and category; other items are left out."""
    return sales.join(items, "item_id", "inner")


def competitor_item_totals(sales: DataFrame) -> DataFrame:
    """Totals per item; the mean price weighs every row alike."""
    found = totals(
        sales,
        ["item_id"],
        sums={"total_revenue": F.col("revenue")},
        means={"avg_marketplace_price": F.col("marketplace_price")},
        others={
            "total_units_sold": (F.sum("units_sold"), F.sum),
            "num_sellers": (F.count("seller_id"), F.sum),
        },
    )
    return found.select(
        "item_id", "total_units_sold", "total_revenue", "avg_marketplace_price", "num_sellers"
    )


def enrich_competitor_totals(totals: DataFrame, items: DataFrame) -> DataFrame:
    """Totals with name and category; items in no catalog stay, with neither."""
    return totals.join(items, "item_id", "left")


def company_top_items(sales: DataFrame, items: DataFrame, top_n: int = TOP_N) -> DataFrame:
    enriched = enrich_company_sales(sales, items)
    price = ["unit_price"] if "unit_price" in items.columns else []
    columns = ["item_id", "item_name", "category", "units_sold", "revenue", *price]
    order = [F.desc_nulls_last("units_sold"), F.asc("item_id")]
    return top_n_per_group(enriched.select(*columns), ["category"], order, top_n)


def competitor_top_items(sales: DataFrame, items: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """As for the company; items in no catalog compete as a category of their own."""
    enriched = enrich_competitor_totals(competitor_item_totals(sales), items)
    columns = [
        "item_id",
        "item_name",
        "category",
        "total_units_sold",
        "total_revenue",
        "avg_marketplace_price",
        "num_sellers",
    ]
    order = [F.desc_nulls_last("total_units_sold"), F.asc("item_id")]
    return top_n_per_group(enriched.select(*columns), ["category"], order, top_n)
