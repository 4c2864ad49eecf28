"""One current row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfgap.functions.widening import aligned


def latest_per_key(
    df: DataFrame,
    key: Sequence[str],
    version: str,
    nearly_unique: bool = False,
    first: Column | None = None,
) -> DataFrame:
    """The row with the greatest version for each key; a NULL version is oldest.

    ``first`` is a condition that goes before the version: a row that meets it wins over one that
    does not. Ties are broken by every other column, so the result depends on the rows alone. Rows
    whose key is NULL form one group. Either way each task sends at most one row per key to the
    shuffle, however many rows a key has: by an aggregate, which suits few keys with many rows
    each, or by rank (``nearly_unique``), which suits keys with few rows each, as it sorts narrow
    sort keys instead of merging wide rows.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    by_version = sorted(rest, key=lambda c: c != version)
    ahead = [] if first is None else [F.coalesce(first, F.lit(False))]
    if nearly_unique:
        order = [F.desc_nulls_last(c) for c in by_version]
        order = [*[c.desc() for c in ahead], *order]
        # Sorted by a hash first, a number that tells almost all keys apart without looking at them.
        rank = F.row_number().over(Window.partitionBy(F.xxhash64(*key), *key).orderBy(*order))
        return df.withColumn("_rank", rank).filter(F.col("_rank") <= 1).select(*df.columns)
    newest = F.max(F.struct(*[c.alias("_first") for c in ahead], *by_version)).alias("_newest")
    return df.groupBy(*key).agg(newest).select(
        *[F.col(c) if c in key else F.col(f"_newest.{c}").alias(c) for c in df.columns]
    )


def merge_latest(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    version: str,
    evolve: bool = False,
) -> DataFrame:
    """Upsert: the newest row per key of both tables.

    Incoming columns are widened to the existing types. With ``evolve`` existing columns are widened
    as well, and a column known to one side only is kept and is NULL in the other's rows. Merging the
    same rows again, or in the other order, changes nothing.
    """
    existing, incoming = aligned(existing, incoming, evolve)
    both = existing.unionByName(incoming, allowMissingColumns=evolve)
    return latest_per_key(both, key, version)
