"""Which input files earlier runs have read.

A file is known by its path, modification time and size, as the file source reports them in its hidden
metadata, so a file that has been replaced counts as new. The ledger is a Parquet table that every run
appends to once its rows are in the table. A run that fails before that reads its files again, which
an upsert takes without harm.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfgap.sources.staging import path_exists

FILE = ["file_path", "file_modification_time", "file_size"]
_SCHEMA = "file_path string, file_modification_time timestamp, file_size long"


def input_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below ``path``, without reading any: its ``path``, and ``file_path``, the same
    as an address, with what else tells the file."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select("path", *[F.col(f"_metadata.{c}").alias(c) for c in FILE])


def files_digest(files: DataFrame) -> str:
    """A name for a set of files, which changes if one is added, removed or replaced."""
    # Of a sum and an exclusive or of hashes, neither depends on the order of the files.
    each = F.xxhash64(*FILE)
    row = files.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor(each), F.lit(0)).alias("x"),
        F.coalesce(F.sum(each.cast("decimal(38,0)")), F.lit(0)).alias("s"),
    ).first()
    return f"{row['n']}-{row['x']}-{row['s']}"


def read_files(spark: SparkSession, ledger: str) -> DataFrame:
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(ledger)


def new_files(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """The files below ``path`` that the ledger does not have."""
    return input_files(spark, path).join(read_files(spark, ledger), FILE, "left_anti")


def literal_path(path: str) -> str:
    """A path that a reader takes as it is, whatever pattern signs it has."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def note_files(files: DataFrame, ledger: str) -> None:
    files.select(*FILE).write.mode("append").parquet(ledger)
