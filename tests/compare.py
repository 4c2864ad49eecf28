"""Rows of a Spark query and of its SQL counterpart as sorted lists of plain values."""

from __future__ import annotations

import glob
import os
import re

import duckdb
import pyarrow as pa


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"create view {name} as select * from '{path}'")
    return db


def _plain(table: pa.Table) -> tuple[dict[str, str], list[tuple]]:
    names = sorted(table.column_names)
    types = {n: re.sub("^large_", "", str(table.schema.field(n).type)) for n in names}
    columns = [table.column(n).to_pylist() for n in names]
    rows = list(zip(*columns)) if columns else []
    return types, sorted(rows, key=repr)


def spark_rows(df) -> tuple[dict[str, str], list[tuple]]:
    return _plain(df.toArrow())


def sql_rows(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[dict[str, str], list[tuple]]:
    return _plain(db.execute(sql).to_arrow_table())
