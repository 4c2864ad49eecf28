"""Connected components of a graph given as edges, by alternating stars.

Each round links the larger neighbours of every node to the smallest node around it, then its
smaller neighbours and itself. The number of edges does not grow, and a round needs only
aggregates, which combine before the shuffle, and equi-joins. The edges of a node are dealt to parts
by their other end, and each part is told the smallest node, so a hub is joined by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfgap.llm.common import checkpointed


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], int(row["h"] or 0)


PARTS = 60  # of the edges of one node; a part is one bit of a long


def _part(other: str) -> Column:
    return F.pmod(F.xxhash64(other), F.lit(PARTS)).cast("int").alias("part")


def _least(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Every node with its smallest neighbour ``m`` and the parts of its edges as bits of ``parts``."""
    per_part = edges.groupBy(node, "part").agg(F.min(other).alias("m"))
    return per_part.groupBy(node).agg(
        F.min("m").alias("m"),
        F.bit_or(F.expr("shiftleft(1L, part)")).alias("parts"),
        F.min("part").alias("first"),
        F.max("part").alias("last"),
    )


def _told(least: DataFrame, node: str) -> DataFrame:
    """``node``, part and ``m`` for every part that has edges."""
    several = F.expr("filter(sequence(first, last), p -> getbit(parts, p) = 1)")
    parts = F.when(F.col("first") == F.col("last"), F.array("first")).otherwise(several)
    return least.select(node, "m", F.explode(parts).alias("part"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    both = both.select("u", "v", _part("v"))
    least = _least(both, "u", "v").withColumn("m", F.least("u", "m"))
    return (
        both.where(F.col("v") > F.col("u"))
        .join(_told(least, "u"), ["u", "part"])
        .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    edges = edges.select("hi", "lo", _part("lo"))
    least = _least(edges, "hi", "lo")
    rest = (
        edges.join(_told(least, "hi"), ["hi", "part"])
        .where(F.col("lo") != F.col("m"))
        .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    )
    return rest.unionAll(least.select("hi", F.col("m").alias("lo"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node of an edge between
    two different nodes that is not the smallest itself.

    ``edges`` has two columns of one ordered type. NULL ends, loops and repeated edges add
    nothing; an empty table gives an empty result.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    now = checkpointed(
        edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    )
    before, state = None, _state(now)
    while state != before and state[0]:
        now = checkpointed(_small_star(_large_star(now)))
        before, state = state, _state(now)
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
