"""The engine's input tables, derived from the given star schema.

Sellers are suppliers and items are parts. Lines with return flag A and status F are what
sellers list, lines with flag N are own sales, and the others, with flag R or with flag A and
status O, are competitor sales, so every line plays a role. The
text views take all lines for each role and put typical faults into them by column values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfgap.operators.keyed import latest_per_key

# Text views, in the SQL both engines share; {text} is the engine's name for strings.
RAW_CATALOG = """
select
  case when l_discount = 0.0 then null
       when l_discount = 0.01 then concat('  ', cast(l_suppkey as {text}), ' ')
       else cast(l_suppkey as {text}) end as seller_id,
  case when l_discount = 0.1 then null
       when l_discount = 0.09 then concat(' ', cast(l_partkey as {text}))
       else cast(l_partkey as {text}) end as item_id,
  case when l_tax = 0.0 and l_linenumber = 1 then null
       when l_tax = 0.01 then upper(p_name)
       when l_tax = 0.02 then concat(' ', p_name, '-x large  ')
       else p_name end as item_name,
  case l_linenumber
       when 7 then null
       when 6 then lower(p_type)
       when 5 then concat(' ', p_type, ' ')
       when 4 then 'eLECTRONICS'
       when 3 then 'toys & games'
       else p_type end as category,
  case when l_tax = 0.08 then null
       when l_tax = 0.07 then '-2.0'
       when l_tax = 0.06 then 'abc'
       when l_tax = 0.05 then '1e3'
       when l_tax = 0.04 and l_linenumber = 1 then '0x1p3'
       else cast(p_retailprice as {text}) end as marketplace_price,
  case cast(l_quantity as int)
       when 1 then '-3'
       when 2 then 'abc'
       when 3 then '12.7'
       when 4 then null
       when 5 then '.5'
       when 6 then '3000000000'
       when 7 then '-3.9'
       when 8 then '1e3'
       when 9 then ' 12 '
       when 10 then '0000000000000000000012'
       when 11 then '0000000000000000000012.7'
       else cast(cast(l_quantity as int) as {text}) end as stock_qty
from {lineitem} join {part} on l_partkey = p_partkey
"""

_SALE_COLUMNS = """
  case when l_discount = 0.1 then null
       when l_discount = 0.09 then concat(' ', cast(l_partkey as {text}))
       else cast(l_partkey as {text}) end as item_id,
  case cast(l_quantity as int)
       when 1 then '-3'
       when 2 then 'abc'
       when 3 then '12.7'
       when 4 then null
       when 5 then '.5'
       when 6 then '3000000000'
       when 7 then '-3.9'
       when 8 then '1e3'
       when 9 then ' 12 '
       when 10 then '0000000000000000000012'
       when 11 then '0000000000000000000012.7'
       else cast(cast(l_quantity as int) as {text}) end as units_sold,
  case when l_tax = 0.01 and l_linenumber = 1 then '-1.5'
       when l_tax = 0.02 and l_linenumber = 2 then 'NaN'
       when l_tax = 0.03 and l_linenumber = 3 then null
       when l_tax = 0.04 and l_linenumber = 4 then '1,000'
       else cast(l_extendedprice as {text}) end as revenue,
  case when l_discount = 0.0 then '2999-01-01'
       when l_discount = 0.01 and l_linenumber = 1 then 'bad'
       when l_discount = 0.01 and l_linenumber = 2 then '2001-02-30'
       when l_discount = 0.01 and l_linenumber = 3 then '05-01-2001'
       when l_discount = 0.02 and l_linenumber = 4 then ''
       when l_discount = 0.03 then concat(' ', cast(cast(l_shipdate as date) as {text}))
       when l_discount = 0.04 then concat(cast(cast(l_shipdate as date) as {text}), 'xyz')
       when l_discount = 0.05 then concat(cast(year(l_shipdate) as {text}), '-',
         cast(month(l_shipdate) as {text}), '-', cast(day(l_shipdate) as {text}))
       else cast(cast(l_shipdate as date) as {text}) end as sale_date
"""

COMPETITOR_LINES = "l_returnflag = 'R' or (l_returnflag = 'A' and l_linestatus = 'O')"

RAW_COMPANY_SALES = f"select {_SALE_COLUMNS} from {{lineitem}}"

RAW_COMPETITOR_SALES = f"""
select
  case when l_discount = 0.07 and l_linenumber = 7 then null
       else cast(l_suppkey as {{text}}) end as seller_id,
  case when l_tax = 0.05 and l_linenumber = 5 then '-0.01'
       when l_tax = 0.06 and l_linenumber = 6 then null
       when l_tax = 0.07 and l_linenumber = 7 then 'abc'
       when l_tax = 0.02 and l_linenumber = 3 then '0x1p3'
       else cast(floor(l_extendedprice * 100 / l_quantity) / 100 as {{text}}) end as marketplace_price,
  {_SALE_COLUMNS}
from {{lineitem}}
"""


BROKEN_LINES = """
select l_orderkey, cast(l_linenumber as {text}) as line,
  case l_linenumber
       when 1 then concat('two', chr(10), 'lines')
       when 2 then ''
       when 3 then null
       when 4 then 'say "so", then'
       when 5 then ' blanks '
       else concat('"', l_returnflag, '"') end as note
from {lineitem}
"""


#: Lines of a CSV file of company sales: some lack their last values, some have one too many.
UNEVEN_LINES = """
select {header} union all
select concat(cast(l_partkey as {text}), ',', cast(cast(l_quantity as int) as {text}),
  case when l_discount = 0.03 then '' else concat(',', cast(l_extendedprice as {text})) end,
  case when l_discount = 0.03 or l_tax = 0.04 then '' else concat(',', cast(cast(l_shipdate as date) as {text})) end,
  case when l_discount = 0.05 and l_tax <> 0.04 then ',extra' else '' end) as line
from {lineitem}
"""
UNEVEN_HEADER = "item_id,units_sold,revenue,sale_date"


class Source:
    """The given tables, each opened once, and the roles taken from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir
        self._open: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._open[name]

    def _raw(self, sql: str, *names: str) -> DataFrame:
        placeholders = {name: f"{{{name}}}" for name in names}
        tables = {name: self.table(name) for name in names}
        return self.spark.sql(sql.format(text="string", **placeholders), **tables)

    @property
    def raw_catalog(self) -> DataFrame:
        return self._raw(RAW_CATALOG, "lineitem", "part")

    @property
    def broken_lines(self) -> DataFrame:
        return self._raw(BROKEN_LINES, "lineitem").withColumn(
            "l_orderkey", F.col("l_orderkey").cast("string")
        )

    @property
    def uneven_lines(self) -> DataFrame:
        """The lines alone, as a column that has the header as its name."""
        sql = UNEVEN_LINES.replace("select {header} union all", "")
        return self._raw(sql, "lineitem").withColumnRenamed("line", UNEVEN_HEADER)

    def write_uneven_lines(self, path: str) -> None:
        """CSV files, each task's with the header first. The lines are written as they are: as the only
        column, which the header names, without quotes."""
        writer = self.uneven_lines.write.option("header", True).option("sep", "\x01").option("quote", "")
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        writer.csv(path)

    @property
    def raw_company_sales(self) -> DataFrame:
        return self._raw(RAW_COMPANY_SALES, "lineitem")

    @property
    def raw_competitor_sales(self) -> DataFrame:
        return self._raw(RAW_COMPETITOR_SALES, "lineitem")

    @property
    def catalog(self) -> DataFrame:
        lines = self.table("lineitem").filter("l_returnflag = 'A' and l_linestatus = 'F'")
        listed = lines.select(
            F.col("l_suppkey").alias("seller_id"), F.col("l_partkey").alias("item_id")
        ).distinct()
        parts = self.table("part").select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("marketplace_price"),
        )
        return listed.join(parts, "item_id").select("seller_id", "item_id", *parts.columns[1:])

    @property
    def company_sales(self) -> DataFrame:
        """The newest own sale of each item."""
        sold = self.table("lineitem").filter("l_returnflag = 'N'").select(
            F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").cast("int").alias("units_sold"),
            F.col("l_extendedprice").alias("revenue"),
            F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey").alias("sold"),
        )
        return latest_per_key(sold, ["item_id"], "sold").drop("sold")

    @property
    def all_competitor_sales(self) -> DataFrame:
        return self.table("lineitem").filter(COMPETITOR_LINES).select(
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").cast("int").alias("units_sold"),
            F.col("l_extendedprice").alias("revenue"),
            F.expr("floor(l_extendedprice * 100 / l_quantity) / 100").alias("marketplace_price"),
            F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("sold"),
        )

    @property
    def competitor_sales(self) -> DataFrame:
        """The newest competitor sale of each seller and item."""
        newest = latest_per_key(self.all_competitor_sales, ["seller_id", "item_id"], "sold")
        return newest.drop("sold")
