"""Raw text tables to typed tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfgap.operators.keyed import latest_per_key
from shelfgap.operators.quality import passes
from shelfgap.sources.text import MALFORMED
from shelfgap.specs import COMPANY_SALES, COMPETITOR_SALES, SELLER_CATALOG, DatasetSpec

RAW = "raw"


def typed(
    raw: DataFrame, spec: DatasetSpec, dates: str = "lenient", keep_raw: bool = False
) -> DataFrame:
    """The declared columns, parsed and filled; other columns of the input are dropped, but for the
    text of malformed rows."""
    columns = [f.parse(spec.labels, dates) for f in spec.fields]
    if MALFORMED in raw.columns:
        columns.append(F.col(MALFORMED))
    if keep_raw:
        columns.append(F.struct(*spec.columns).alias(RAW))
    return raw.select(*columns)


def clean(
    raw: DataFrame,
    spec: DatasetSpec,
    dates: str = "lenient",
    keep_raw: bool = False,
    as_of: datetime.date | str | None = None,
) -> DataFrame:
    """Typed rows, reduced to one per key where the dataset asks for it before its rules.

    A row that meets all rules is chosen before one that does not, so a bad row never takes the
    good ones of its key with it. Malformed rows have a key of their own, their text.
    """
    rows = typed(raw, spec, dates, keep_raw)
    if spec.one_row_per_key_before_rules:
        good = passes(spec.rules, as_of)
        key = [*spec.key, *([MALFORMED] if MALFORMED in rows.columns else [])]
        rows = latest_per_key(rows, key, spec.version, spec.nearly_unique_key, good)
    return rows


def clean_seller_catalog(raw: DataFrame) -> DataFrame:
    return clean(raw, SELLER_CATALOG)


def clean_company_sales(
    raw: DataFrame, dates: str = "lenient", as_of: datetime.date | str | None = None
) -> DataFrame:
    return clean(raw, COMPANY_SALES, dates, as_of=as_of)


def clean_competitor_sales(raw: DataFrame, dates: str = "lenient") -> DataFrame:
    return clean(raw, COMPETITOR_SALES, dates)
