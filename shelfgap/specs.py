"""Declarations of the three input tables and of the result."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfgap.functions import parsing


@dataclass(frozen=True)
class Field:
    """One column: the kind decides how its text is parsed."""

    name: str
    kind: str  # id | title | label | int | double | date
    fill: int | float | None = None

    def parse(self, labels: Mapping[str, str], dates: str) -> Column:
        text = F.col(self.name)
        builders: dict[str, Callable[[], Column]] = {
            "id": lambda: parsing.trimmed(text),
            "title": lambda: parsing.title_case(parsing.trimmed(text)),
            "label": lambda: parsing.canonical_label(parsing.trimmed(text), labels),
            "int": lambda: parsing.to_int(text),
            "double": lambda: parsing.to_double(text),
            "date": lambda: parsing.to_day(text, dates),
        }
        value = builders[self.kind]()
        if self.fill is not None:
            value = parsing.filled(value, self.fill)
        return value.alias(self.name)


@dataclass(frozen=True)
class Rule:
    """A named condition that every accepted row meets; it may look at the latest allowed day."""

    reason: str
    holds: Callable[[Column], Column]


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    version: str
    rules: tuple[Rule, ...]
    one_row_per_key_before_rules: bool
    nearly_unique_key: bool = False  # few rows share a key
    labels: Mapping[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


def present(column: str) -> Rule:
    return Rule(f"{column}_null", lambda _day: F.col(column).isNotNull())


def not_negative(column: str, reason: str | None = None) -> Rule:
    return Rule(reason or f"{column}_negative", lambda _day: F.col(column) >= 0)


def dated_by(column: str) -> Rule:
    return Rule(
        f"{column}_invalid",
        lambda day: F.col(column).isNotNull() & (F.col(column) <= day),
    )


# Category spellings kept as given.
CATEGORY_LABELS = {
    "ELECTRONICS": "Electronics",
    "FOOTWEAR": "Footwear",
    "APPAREL": "Apparel",
    "HOME": "Home",
    "BOOKS": "Books",
}

SELLER_CATALOG = DatasetSpec(
    name="seller_catalog",
    fields=(
        Field("seller_id", "id"),
        Field("item_id", "id"),
        Field("item_name", "title"),
        Field("category", "label"),
        Field("marketplace_price", "double"),
        Field("stock_qty", "int", fill=0),
    ),
    key=("seller_id", "item_id"),
    version="item_name",
    rules=(
        present("seller_id"),
        present("item_id"),
        not_negative("marketplace_price", "price_negative"),
        not_negative("stock_qty", "stock_negative"),
        present("item_name"),
        present("category"),
    ),
    one_row_per_key_before_rules=True,
    nearly_unique_key=True,
    labels=CATEGORY_LABELS,
)

COMPANY_SALES = DatasetSpec(
    name="company_sales",
    fields=(
        Field("item_id", "id"),
        Field("units_sold", "int", fill=0),
        Field("revenue", "double", fill=0.0),
        Field("sale_date", "date"),
    ),
    key=("item_id",),
    version="sale_date",
    rules=(
        present("item_id"),
        not_negative("units_sold"),
        not_negative("revenue"),
        dated_by("sale_date"),
    ),
    one_row_per_key_before_rules=True,
)

COMPETITOR_SALES = DatasetSpec(
    name="competitor_sales",
    fields=(
        Field("seller_id", "id"),
        Field("item_id", "id"),
        Field("units_sold", "int", fill=0),
        Field("revenue", "double", fill=0.0),
        Field("marketplace_price", "double", fill=0.0),
        Field("sale_date", "date"),
    ),
    key=("seller_id", "item_id"),
    version="sale_date",
    rules=(
        present("item_id"),
        present("seller_id"),
        not_negative("units_sold"),
        not_negative("revenue"),
        not_negative("marketplace_price"),
        dated_by("sale_date"),
    ),
    one_row_per_key_before_rules=False,
    nearly_unique_key=True,
)

DATASETS = {s.name: s for s in (SELLER_CATALOG, COMPANY_SALES, COMPETITOR_SALES)}

RECOMMENDATION_SCHEMA = T.StructType(
    [
        T.StructField("seller_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("item_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("market_price", T.DoubleType()),
        T.StructField("expected_units_sold", T.DoubleType()),
        T.StructField("expected_revenue", T.DoubleType()),
    ]
)
