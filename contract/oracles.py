"""The registered queries in SQL over the same tables, written without the engine's operators."""

from __future__ import annotations

from collections.abc import Sequence

from contract.views import (
    BROKEN_LINES,
    COMPETITOR_LINES,
    RAW_CATALOG,
    RAW_COMPANY_SALES,
    RAW_COMPETITOR_SALES,
    UNEVEN_LINES,
)

_NAMES = {"text": "varchar", "lineitem": "lineitem", "part": "part"}
_RAW = {
    "seller_catalog": RAW_CATALOG.format(**_NAMES),
    "company_sales": RAW_COMPANY_SALES.format(**_NAMES),
    "competitor_sales": RAW_COMPETITOR_SALES.format(**_NAMES),
}

# Column expressions.


def _title(x: str) -> str:
    words = f"string_split(lower({x}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def _label(x: str) -> str:
    fixed = ["Electronics", "Footwear", "Apparel", "Home", "Books"]
    cases = " ".join(f"when '{label.upper()}' then '{label}'" for label in fixed)
    return f"case upper({x}) {cases} else {_title(x)} end"


def _int(x: str) -> str:
    number = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)"
    whole = f"trunc(try_cast(trim({x}) as decimal(38, 18)))"
    return f"case when regexp_full_match(trim({x}), '{number}') then try_cast({whole} as integer) end"


def _double(x: str) -> str:
    return f"case when {x} = '0x1p3' then 8.0::double else try_cast({x} as double) end"


def _date(x: str) -> str:
    return rf"try_cast(nullif(regexp_extract({x}, '^\s*(\d+-\d+-\d+)', 1), '') as date)"


def _strict_date(x: str) -> str:
    return rf"case when regexp_full_match({x}, '\d{{4}}-\d{{2}}-\d{{2}}') then try_cast({x} as date) end"


def _filled_double(x: str) -> str:
    return f"coalesce(case when isnan({_double(x)}) then null else {_double(x)} end, 0.0)"


def _filled_int(x: str) -> str:
    return f"coalesce({_int(x)}, 0)"


_UNIT = 2.0**60  # amounts of these tables are whole multiples of its inverse


def _sum(x: str, over: str = "") -> str:
    """The exact sum of doubles, rounded once."""
    return f"cast(sum(cast({x} * {_UNIT:.0f}::double as hugeint)) {over} as double) / {_UNIT:.0f}::double"


def _avg(x: str) -> str:
    return f"{_sum(x)} / count({x})"


def _newest(rows: str, key: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> str:
    by = ", ".join(f"{c} desc nulls last" for c in order)
    return (
        f"select {', '.join(columns)} from (select *, row_number() over ("
        f"partition by {', '.join(key)} order by {by}) as newest_rank from ({rows}) a) b "
        "where newest_rank = 1"
    )


# Typed, cleaned and judged rows of each dataset.

_COLUMNS = {
    "seller_catalog": [
        "seller_id", "item_id", "item_name", "category", "marketplace_price", "stock_qty",
    ],
    "company_sales": ["item_id", "units_sold", "revenue", "sale_date"],
    "competitor_sales": [
        "seller_id", "item_id", "units_sold", "revenue", "marketplace_price", "sale_date",
    ],
}
_KEYS = {
    "seller_catalog": ["seller_id", "item_id"],
    "company_sales": ["item_id"],
    "competitor_sales": ["seller_id", "item_id"],
}
_VERSIONS = {
    "seller_catalog": "item_name",
    "company_sales": "sale_date",
    "competitor_sales": "sale_date",
}
_PARSED = {
    "seller_catalog": {
        "seller_id": "trim(seller_id)",
        "item_id": "trim(item_id)",
        "item_name": _title("trim(item_name)"),
        "category": _label("trim(category)"),
        "marketplace_price": _double("marketplace_price"),
        "stock_qty": _filled_int("stock_qty"),
    },
    "company_sales": {
        "item_id": "trim(item_id)",
        "units_sold": _filled_int("units_sold"),
        "revenue": _filled_double("revenue"),
        "sale_date": _date("sale_date"),
    },
    "competitor_sales": {
        "seller_id": "trim(seller_id)",
        "item_id": "trim(item_id)",
        "units_sold": _filled_int("units_sold"),
        "revenue": _filled_double("revenue"),
        "marketplace_price": _filled_double("marketplace_price"),
        "sale_date": _date("sale_date"),
    },
}
_SALE_RULES = {
    "units_sold_negative": "units_sold >= 0",
    "revenue_negative": "revenue >= 0",
    "sale_date_invalid": "(sale_date is not null and sale_date <= current_date)",
}
_RULES = {
    "seller_catalog": {
        "seller_id_null": "seller_id is not null",
        "item_id_null": "item_id is not null",
        "price_negative": "marketplace_price >= 0",
        "stock_negative": "stock_qty >= 0",
        "item_name_null": "item_name is not null",
        "category_null": "category is not null",
    },
    "company_sales": {"item_id_null": "item_id is not null", **_SALE_RULES},
    "competitor_sales": {
        "item_id_null": "item_id is not null",
        "seller_id_null": "seller_id is not null",
        "marketplace_price_negative": "marketplace_price >= 0",
        **_SALE_RULES,
    },
}


def _typed(name: str, more: str = "") -> str:
    parsed = ", ".join(f"{sql} as {column}" for column, sql in _PARSED[name].items())
    return f"select {parsed}{more} from ({_RAW[name]}) r"


def _latest(name: str, rows: str) -> str:
    columns, key, version = _COLUMNS[name], _KEYS[name], _VERSIONS[name]
    rest = [c for c in columns if c not in key and c != version]
    # A row that passes all rules goes before one that does not.
    good = f"coalesce({' and '.join(_RULES[name].values())}, false)"
    return _newest(rows, key, [good, version, *rest], columns)


def _clean(name: str) -> str:
    rows = _typed(name)
    return rows if name == "competitor_sales" else _latest(name, rows)


def _good(name: str) -> str:
    return f"select * from ({_clean(name)}) c where {' and '.join(_RULES[name].values())}"


def _failed(rule: str, null_fails: bool) -> str:
    return f"not coalesce({rule}, false)" if null_fails else f"not ({rule})"


def _quarantine(name: str, null_fails: bool = True, rows: str | None = None) -> str:
    branches = [
        f"select *, '{reason}' as dq_failure_reason from rows where {_failed(rule, null_fails)}"
        for reason, rule in _RULES[name].items()
    ]
    union = " union all ".join(branches)
    return f"with rows as ({rows or _clean(name)}) select distinct * from ({union}) q"


def _metrics(name: str, null_fails: bool) -> str:
    good = f"coalesce({' and '.join(_RULES[name].values())}, false)"
    fails = [f"coalesce(cast({_failed(r, null_fails)} as int), 0)" for r in _RULES[name].values()]
    failed = " + ".join(fails)
    return f"""select '{name}' as dataset, count(*) as input_rows,
      count(*) filter (where good) as good_rows,
      count(*) filter (where failed > 0) as rejected_rows,
      count(*) filter (where not good and failed = 0) as unjudged_rows,
      cast(coalesce(sum(failed), 0) as bigint) as failed_rules
    from (select {good} as good, {failed} as failed from ({_clean(name)}) c) m"""


def _table(name: str) -> str:
    return _latest(name, _good(name)) if name == "competitor_sales" else _good(name)


def _with_raw() -> str:
    name = "competitor_sales"
    raw = ", ".join(f"{c} as raw_{c}" for c in _COLUMNS[name])
    return _quarantine(name, rows=_typed(name, f", {raw}"))


# Roles taken from the star schema, as common table expressions.

_CATALOG = """catalog as (
  select distinct l_suppkey as seller_id, l_partkey as item_id, p_name as item_name,
    p_type as category, p_retailprice as marketplace_price
  from lineitem join part on l_partkey = p_partkey
  where l_returnflag = 'A' and l_linestatus = 'F')"""

_COMPETITOR_LINES = """select l_suppkey as seller_id, l_partkey as item_id,
    cast(l_quantity as int) as units_sold, l_extendedprice as revenue,
    floor(l_extendedprice * 100 / l_quantity) / 100 as marketplace_price,
    l_shipdate, l_orderkey, l_linenumber
  from lineitem where """ + COMPETITOR_LINES

_COMPANY = "company as (" + _newest(
    """select l_partkey as item_id, cast(l_quantity as int) as units_sold,
      l_extendedprice as revenue, l_shipdate, l_orderkey, l_linenumber, l_suppkey
    from lineitem where l_returnflag = 'N'""",
    ["item_id"],
    ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "units_sold", "revenue"],
    ["item_id", "units_sold", "revenue"],
) + ")"

_COMPETITOR = "competitor as (" + _newest(
    _COMPETITOR_LINES,
    ["seller_id", "item_id"],
    ["l_shipdate", "l_orderkey", "l_linenumber", "units_sold", "revenue", "marketplace_price"],
    ["seller_id", "item_id", "units_sold", "revenue", "marketplace_price"],
) + ")"


def _dimension(catalog: str) -> str:
    return f"""select item_id, item_name, category, unit_price from (
      select item_id, item_name, category,
        row_number() over (partition by item_id
          order by category nulls last, item_name nulls last) as rn,
        {_sum("marketplace_price", "over (partition by item_id)")}
          / nullif(count(marketplace_price) over (partition by item_id), 0) as unit_price
      from ({catalog}) d0) d1 where rn = 1"""


def _totals(sales: str) -> str:
    return f"""select item_id, cast(sum(units_sold) as bigint) as total_units_sold,
      {_sum("revenue")} as total_revenue, {_avg("marketplace_price")} as avg_marketplace_price,
      count(seller_id) as num_sellers
    from ({sales}) t group by item_id"""


def _steps(
    catalog: str, company: str, competitor: str, company_price: str = "revenue", n: int = 10
) -> str:
    """Common table expressions from three tables to the scored gaps and the best of them."""
    company_price = f"cast({company_price} as double)"
    units = "total_units_sold / cast(num_sellers as double)"
    missing = """not exists (select 1 from catalog c
        where c.seller_id = s.seller_id and c.item_id = t.item_id)"""
    return f"""with {catalog}, {company}, {competitor},
dim as ({_dimension("select * from catalog")}),
totals as ({_totals("select * from competitor")}),
ctop as (select * from (
  select c.item_id, item_name, category, units_sold, revenue, unit_price,
    cast(row_number() over (partition by category
      order by units_sold desc nulls last, c.item_id) as integer) as rank
  from company c join dim d on c.item_id = d.item_id) x where rank <= {n}),
ktop as (select * from (
  select a.item_id, item_name, category, total_units_sold, total_revenue,
    avg_marketplace_price, num_sellers,
    cast(row_number() over (partition by category
      order by total_units_sold desc nulls last, a.item_id) as integer) as rank
  from totals a left join dim d on a.item_id = d.item_id) x where rank <= {n}),
sellers as (select distinct seller_id from catalog),
cgaps as (select s.seller_id, t.*, 'company' as source
  from ctop t cross join sellers s where {missing}),
kgaps as (select s.seller_id, t.*, 'competitor' as source
  from ktop t cross join sellers s where {missing}),
cscored as (select seller_id, item_id, item_name, category, {company_price} as market_price,
  cast(units_sold as double) as expected_units_sold,
  units_sold * {company_price} as expected_revenue, source from cgaps),
kscored as (select seller_id, item_id, item_name, category,
  avg_marketplace_price as market_price, {units} as expected_units_sold,
  {units} * avg_marketplace_price as expected_revenue, source from kgaps),
every as (select * from cscored union all select * from kscored),
scored as (select * exclude (rn) from (select *, row_number() over (partition by seller_id, source
  order by expected_revenue desc nulls last, item_id) as rn from every) x where rn <= 10),
best as (select seller_id, item_id, item_name, category, market_price, expected_units_sold,
  expected_revenue from (select *, row_number() over (partition by seller_id
    order by expected_revenue desc nulls last, item_id, source) as rn from scored) x
  where rn <= 10)
"""


_ROLES = _steps(_CATALOG, _COMPANY, _COMPETITOR)
_CLEANED = _steps(
    f"catalog as ({_table('seller_catalog')})",
    f"company as ({_table('company_sales')})",
    f"competitor as ({_table('competitor_sales')})",
)


def _sales_by_status(status: str, tax: str = "l_tax", revenue: str = "l_extendedprice") -> str:
    return f"""select l_suppkey as seller_id, l_partkey as item_id,
      cast(l_quantity as int) as units_sold, {revenue} as revenue, {tax} as tax,
      cast(l_shipdate as date) as sale_date
    from lineitem where l_linestatus = '{status}'"""


_LINES = UNEVEN_LINES.replace("select {header} union all", "").format(**_NAMES)
_SALE_KEY = ["seller_id", "item_id"]
_MERGED = _newest(
    f"{_sales_by_status('F')} union all {_sales_by_status('O')}",
    _SALE_KEY,
    ["sale_date", "units_sold", "revenue", "tax"],
    [*_SALE_KEY, "units_sold", "revenue", "tax", "sale_date"],
)

_FLOAT_TAX = "cast(cast(l_tax as float) as double)"
_WIDENED = _newest(
    f"{_sales_by_status('F', tax=_FLOAT_TAX)} union all {_sales_by_status('O')}",
    _SALE_KEY,
    ["sale_date", "units_sold", "revenue", "tax"],
    [*_SALE_KEY, "units_sold", "revenue", "tax", "sale_date"],
)
_IN_PARTS = _newest(
    f"""{_sales_by_status('F', tax=_FLOAT_TAX)}
      union all {_sales_by_status('O')} and l_partkey % 3 <> 1
      union all {_sales_by_status('O', tax=_FLOAT_TAX)} and l_partkey % 3 = 1""",
    _SALE_KEY,
    ["sale_date", "units_sold", "revenue", "tax"],
    [*_SALE_KEY, "units_sold", "revenue", "tax", "sale_date"],
)

ORACLES: dict[str, str] = {
    "trimmed_ids": f"""select seller_id, item_id, trim(seller_id) as seller, trim(item_id) as item
        from ({_RAW['seller_catalog']}) r""",
    "title_case_names": f"""select item_name, {_title('trim(item_name)')} as title
        from ({_RAW['seller_catalog']}) r""",
    "canonical_category": f"""select category, {_label('trim(category)')} as label
        from ({_RAW['seller_catalog']}) r""",
    "parse_int_lenient": f"""select units_sold, {_int('units_sold')} as units
        from ({_RAW['company_sales']}) r""",
    "parse_double": f"""select marketplace_price, {_double('marketplace_price')} as price
        from ({_RAW['competitor_sales']}) r""",
    "parse_date": f"""select sale_date, {_date('sale_date')} as day
        from ({_RAW['company_sales']}) r""",
    "parse_date_strict": f"""select sale_date, {_strict_date('sale_date')} as day
        from ({_RAW['company_sales']}) r""",
    "fill_defaults": f"""select units_sold, revenue, {_filled_int('units_sold')} as units,
        {_filled_double('revenue')} as amount from ({_RAW['company_sales']}) r""",
    "typed_catalog": _typed("seller_catalog"),
    "clean_catalog": _clean("seller_catalog"),
    "clean_company_sales": _clean("company_sales"),
    "clean_competitor_sales": _clean("competitor_sales"),
    "dedup_catalog": _newest(
        "select l_suppkey, l_partkey, l_linestatus, l_returnflag, l_quantity from lineitem",
        ["l_suppkey", "l_partkey"],
        ["l_linestatus", "l_returnflag", "l_quantity"],
        ["l_suppkey", "l_partkey", "l_linestatus", "l_returnflag", "l_quantity"],
    ),
    "dedup_company_sales": _newest(
        """select l_partkey, cast(l_shipdate as date) as l_shipdate, l_orderkey, l_quantity,
           l_extendedprice from lineitem""",
        ["l_partkey"],
        ["l_shipdate", "l_orderkey", "l_quantity", "l_extendedprice"],
        ["l_partkey", "l_shipdate", "l_orderkey", "l_quantity", "l_extendedprice"],
    ),
    "dq_catalog_good": _good("seller_catalog"),
    "dq_catalog_quarantine": _quarantine("seller_catalog"),
    "dq_catalog_quarantine_nulls_ignored": _quarantine("seller_catalog", null_fails=False),
    "dq_company_good": _good("company_sales"),
    "dq_company_quarantine": _quarantine("company_sales"),
    "dq_competitor_good": _good("competitor_sales"),
    "dq_competitor_quarantine": _quarantine("competitor_sales"),
    "dq_metrics": " union all ".join(
        [
            _metrics("seller_catalog", False),
            _metrics("company_sales", True),
            _metrics("competitor_sales", True),
        ]
    ),
    "quarantine_with_raw": _with_raw(),
    "latest_per_key_competitor": _table("competitor_sales"),
    "merge_latest_sales": _MERGED,
    "merge_evolved": _newest(
        f"""{_sales_by_status('F', tax='cast(null as double)')} union all
            {_sales_by_status('O', revenue='cast(null as double)')}""",
        _SALE_KEY,
        ["sale_date", "units_sold", "revenue", "tax"],
        [*_SALE_KEY, "units_sold", "revenue", "tax", "sale_date"],
    ),
    "upserted_table": _MERGED,
    "merge_widened": _WIDENED,
    "upserted_in_parts": _IN_PARTS,
    "item_dimension": f"""select item_id, item_name, category
        from ({_dimension(_typed('seller_catalog'))}) d""",
    "item_unit_prices": _dimension(_typed("seller_catalog")),
    "held_pairs": f"select distinct seller_id, item_id from ({_typed('seller_catalog')}) t",
    "seller_universe": f"select distinct seller_id from ({_typed('seller_catalog')}) t",
    "company_sales_enriched": f"""{_ROLES} select c.item_id, units_sold, revenue, item_name,
        category from company c join dim d on c.item_id = d.item_id""",
    "competitor_item_totals": _totals(_COMPETITOR_LINES),
    "competitor_sales_enriched": f"""{_ROLES} select t.*, item_name, category
        from totals t left join dim d on t.item_id = d.item_id""",
    "company_top_items": f"""{_ROLES} select item_id, item_name, category, units_sold, revenue,
        rank from ctop""",
    "competitor_top_items": f"{_ROLES} select * from ktop",
    "company_gaps": f"""{_ROLES} select seller_id, item_id, item_name, category, source
        from scored where source = 'company'""",
    "competitor_gaps": f"""{_ROLES} select seller_id, item_id, item_name, category, source
        from scored where source = 'competitor'""",
    "company_scored": f"{_ROLES} select * from scored where source = 'company'",
    "competitor_scored": f"{_ROLES} select * from scored where source = 'competitor'",
    "all_scored_candidates": f"{_ROLES} select * from scored",
    "recommendations_long_list": _steps(_CATALOG, _COMPANY, _COMPETITOR, n=400)
    + "select * from best",
    "recommendation_counts": f"""{_ROLES} select
        (select count(*) from catalog) as seller_catalog,
        (select count(*) from company) as company_sales,
        (select count(*) from competitor) as competitor_sales,
        (select count(*) from ctop) as company_top_items,
        (select count(*) from ktop) as competitor_top_items,
        (select count(*) from best) as recommendations""",
    "malformed_quarantine": f"""select distinct line as row_text, 'row_malformed' as dq_failure_reason
        from ({_LINES}) l where len(string_split(line, ',')) <> 4""",
    "even_lines_table": _newest(
        f"""select string_split(line, ',')[1] as item_id, cast(string_split(line, ',')[2] as int) as units_sold,
            cast(string_split(line, ',')[3] as double) as revenue, cast(string_split(line, ',')[4] as date) as sale_date
            from ({_LINES}) l where len(string_split(line, ',')) = 4""",
        ["item_id"],
        ["sale_date", "units_sold", "revenue"],
        ["item_id", "units_sold", "revenue", "sale_date"],
    ),
    "incremental_table": _table("competitor_sales"),
    "replayed_table": _table("competitor_sales"),
    "bronze_round_trip": f"select * from ({_RAW['competitor_sales']}) r",
    "quarantine_round_trip": _quarantine("competitor_sales"),
    "line_break_round_trip": f"""select cast(l_orderkey as varchar) as l_orderkey, line, note
        from ({BROKEN_LINES.format(**_NAMES)}) r""",
    "best_per_seller": f"{_ROLES} select * from best",
    "recommendations": f"{_ROLES} select * from best",
    "recommendations_unit_price": _steps(_CATALOG, _COMPANY, _COMPETITOR, "unit_price")
    + "select * from best",
    "csv_round_trip": f"select * from ({_RAW['seller_catalog']}) r",
    "parquet_round_trip": _table("competitor_sales"),
    "cleaned_recommendations": f"{_CLEANED} select * from best",
    "whole_run": f"{_CLEANED} select * from best",
}
