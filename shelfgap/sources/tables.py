"""Keyed tables: one row per business key, replaced or merged.

A Parquet table is two copies, each partitioned by buckets of keys, and a pointer. A write of version
n goes to copy n modulo 2, to which the pointer has not led since version n - 2, and then adds one row
to the pointer. Readers start at the last pointer, so a write that fails leaves the former rows
readable, and a reader that has opened a version can go on through the next write; the write after
that replaces its files.

An upsert overwrites partitions by Spark's dynamic mode: the buckets that the delivery falls into and
those of the write before, which this copy has missed. All rows come from the current copy, so nothing
that a failed write has left behind is ever read. One writer at a time; two are told by the pointer.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfgap.functions.widening import aligned
from shelfgap.operators.keyed import latest_per_key, merge_latest
from shelfgap.sources.staging import path_exists
from shelfgap.specs import DatasetSpec

DEFAULT_FORMAT = "parquet"
#: Of Parquet. One task sorts and writes a bucket, whose rows in memory take several times as much. A
#: table is cut anew before its buckets become twice as large.
BUCKET_BYTES = 32 << 20
MOST_BUCKETS = 1 << 20
_BUCKET = "_bucket"
_POINTER = "version long, buckets int, schema string"
_WRITES = "version long, bucket int"
_ALL = -1  # in the list of writes: every bucket


class _Version(NamedTuple):
    version: int
    buckets: int
    schema: T.StructType


def _options(spec: DatasetSpec, table_format: str) -> dict[str, str]:
    """Writer settings for formats that keep keys themselves."""
    if table_format != "hudi":
        return {}
    return {
        "hoodie.table.name": spec.name,
        "hoodie.datasource.write.table.name": spec.name,
        "hoodie.datasource.write.operation": "upsert",
        "hoodie.datasource.write.recordkey.field": ",".join(spec.key),
        "hoodie.datasource.write.partitionpath.field": "",
        "hoodie.datasource.write.precombine.field": spec.version,
    }


def _opened(spark: SparkSession, schema: str, path: str) -> DataFrame | None:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


def _current(spark: SparkSession, path: str) -> _Version | None:
    """What the pointer says; None if there is no table of versions."""
    pointer = _opened(spark, _POINTER, f"{path}/_pointer")
    last = pointer.orderBy(F.desc("version")).limit(2).collect() if pointer is not None else []
    if not last:
        return None
    if len(last) > 1 and last[0]["version"] == last[1]["version"]:
        raise RuntimeError(f"two writers have written version {last[0]['version']} of {path}")
    return _Version(last[0]["version"], last[0]["buckets"], T.StructType.fromJson(json.loads(last[0]["schema"])))


def _point_to(spark: SparkSession, path: str, version: _Version) -> None:
    row = (version.version, version.buckets, version.schema.json())
    spark.createDataFrame([row], _POINTER).coalesce(1).write.mode("append").parquet(f"{path}/_pointer")
    _current(spark, path)


def _copy(path: str, version: int) -> str:
    return f"{path}/copy-{version % 2}"


def _rows(spark: SparkSession, path: str, now: _Version) -> DataFrame:
    """The rows of a version, with their bucket."""
    return spark.read.schema(now.schema).parquet(_copy(path, now.version))


def _bucket(key: tuple[str, ...], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _bytes(df: DataFrame) -> int:
    """Bytes of the files and other relations that ``df`` starts from, as the planner knows them
    without running anything; 0 if it does not know."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 60)


def _buckets_for(n_bytes: int) -> int:
    return max(1, min(MOST_BUCKETS, -(-n_bytes // BUCKET_BYTES)))


def read_table(spark: SparkSession, path: str, table_format: str = DEFAULT_FORMAT) -> DataFrame:
    """The table as its last complete write left it; a plain folder of Parquet files is read as
    it is."""
    path = path.rstrip("/")
    if table_format == DEFAULT_FORMAT:
        now = _current(spark, path)
        if now:
            return _rows(spark, path, now).drop(_BUCKET)
    return spark.read.format(table_format).load(path)


def _write_all(df: DataFrame, path: str, version: _Version, spec: DatasetSpec) -> None:
    """Replaces a whole copy and points to it."""
    # By number, not by hash: no two buckets meet in a task.
    dealt = df.withColumn(_BUCKET, _bucket(spec.key, version.buckets))
    dealt = dealt.repartitionById(version.buckets, F.col(_BUCKET))
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(_BUCKET).parquet(_copy(path, version.version))
    _point_to(df.sparkSession, path, version)


def _note(spark: SparkSession, path: str, version: int, buckets: Iterable[int]) -> None:
    """Says, before a write, in which buckets the other copy will be behind it."""
    rows = spark.createDataFrame([(version, b) for b in buckets], _WRITES)
    rows.coalesce(1).write.mode("append").parquet(f"{path}/_writes")


def _noted(spark: SparkSession, path: str, version: int) -> set[int]:
    """The buckets noted for a version: at most as many numbers as the table has buckets."""
    writes = _opened(spark, _WRITES, f"{path}/_writes")
    if writes is None:
        return set()
    return {r["bucket"] for r in writes.where(F.col("version") == version).distinct().collect()}


def write_table(
    df: DataFrame,
    path: str,
    spec: DatasetSpec,
    table_format: str = DEFAULT_FORMAT,
    buckets: int | None = None,
) -> None:
    """Replaces the table by the newest row per key, in as many buckets as its bytes ask for."""
    path = path.rstrip("/")
    if not spec.one_row_per_key_before_rules:
        df = latest_per_key(df, spec.key, spec.version, spec.nearly_unique_key)
    if table_format != DEFAULT_FORMAT:
        writer = df.write.format(table_format).options(**_options(spec, table_format))
        writer.mode("overwrite").save(path)
        return
    now = _current(df.sparkSession, path)
    buckets = buckets or _buckets_for(_bytes(df))
    target = _Version(now.version + 1 if now else 1, buckets, df.schema)
    _note(df.sparkSession, path, target.version, [_ALL])
    _write_all(df, path, target, spec)


def _grown(existing: DataFrame, incoming: DataFrame, n_new: int) -> int:
    """Bytes of the table with ``n_new`` more rows as large as those it has."""
    n_bytes, n_old = _bytes(existing), existing.count() if n_new else 0
    return n_bytes + (n_bytes * n_new // n_old if n_old else _bytes(incoming) if n_new else 0)


def upsert_table(
    incoming: DataFrame,
    path: str,
    spec: DatasetSpec,
    table_format: str = DEFAULT_FORMAT,
    evolve: bool = False,
) -> None:
    """Merges rows into the table: the newest row per key of both.

    Incoming columns are widened to the table's types; with ``evolve`` the table's are widened to the
    incoming ones and columns that one side lacks are NULL there. Other differences raise.

    Read and written are the buckets that the incoming rows fall into and those of the write before.
    The whole table is rewritten after a replacement, after a write that failed, if a type changes and
    if its buckets would become too large with the incoming rows.
    """
    spark, path = incoming.sparkSession, path.rstrip("/")
    if table_format != DEFAULT_FORMAT:
        existing = read_table(spark, path, table_format)
        existing = existing.select(*[c for c in existing.columns if not c.startswith("_hoodie_")])
        merged = merge_latest(existing, incoming, spec.key, spec.version, evolve)
        writer = merged.write.format(table_format).options(**_options(spec, table_format))
        writer.mode("overwrite").save(path)
        return
    now = _current(spark, path)
    if now is None:  # a plain folder becomes a table first
        write_table(read_table(spark, path), path, spec)
        now = _current(spark, path)
    existing = _rows(spark, path, now)
    rows, new = aligned(existing.drop(_BUCKET), incoming, evolve)
    retyped = any(f.dataType != now.schema[f.name].dataType for f in rows.schema)
    schema = rows.unionByName(new, allowMissingColumns=evolve).schema

    ahead = now.version + 1
    behind, failed = _noted(spark, path, now.version), _noted(spark, path, ahead)
    bucket = _bucket(spec.key, now.buckets)
    # At most as many rows as the table has buckets.
    fresh = {r["bucket"]: r["count"] for r in new.groupBy(bucket.alias("bucket")).count().collect()}
    wanted = _buckets_for(_grown(existing, incoming, sum(fresh.values())))
    fits = wanted <= 2 * now.buckets and not retyped
    _note(spark, path, ahead, sorted(fresh) if fits else [_ALL])
    if _ALL in behind or failed or not fits:
        both = rows.unionByName(new, allowMissingColumns=evolve)
        merged = latest_per_key(both, spec.key, spec.version, spec.nearly_unique_key)
        buckets = now.buckets if wanted <= 2 * now.buckets else wanted
        _write_all(merged, path, _Version(ahead, buckets, schema), spec)
        return
    if not fresh and schema == now.schema:
        return
    pending = sorted({*fresh, *behind})
    kept = existing.where(F.col(_BUCKET).isin(pending)).select(*rows.columns)
    both = kept.unionByName(new, allowMissingColumns=evolve)
    # One row per key leaves each task for the shuffle, however often a key is delivered.
    merged = latest_per_key(both, spec.key, spec.version, spec.nearly_unique_key).withColumn(_BUCKET, bucket)
    places = F.broadcast(spark.createDataFrame(list(enumerate(pending)), f"_place int, {_BUCKET} int"))
    dealt = merged.join(places, _BUCKET).repartitionById(max(1, len(pending)), F.col("_place"))
    writer = dealt.select(*merged.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(_BUCKET).parquet(_copy(path, ahead))
    _point_to(spark, path, _Version(ahead, now.buckets, schema))


def table_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)
