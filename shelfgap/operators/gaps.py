"""Items a seller does not list, found without pairing every seller with every item.

The items are numbered 1..size in one fixed order, 64 positions to a block. What a seller lists of
a block is one 64-bit mask, made by one aggregate; a block that it lists nothing of has no row. The
first open positions lie in the first blocks with open bits, so a seller is only followed that far.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfgap.operators.ranking import top_n_per_group
from shelfgap.sources.staging import Staging

SELLER = "seller_id"
ITEM = "item_id"
POSITION = "position"
_BLOCK_BITS = 6
_BLOCK_SIZE = 1 << _BLOCK_BITS
_CHUNK = "_chunk"
_BLOCK = "_block"
_BIT = "_bit"
_MASK = "_mask"


class NumberedItems(NamedTuple):
    rows: DataFrame
    size: int


def held_pairs(catalog: DataFrame) -> DataFrame:
    return catalog.select(SELLER, ITEM).distinct()


def seller_universe(catalog: DataFrame) -> DataFrame:
    return catalog.select(SELLER).distinct()


def number_items(items: DataFrame, order: Sequence[Column], staging: Staging) -> NumberedItems:
    """Position 1..size by ``order``, which must tell all items apart.

    Range partitions are numbered one by one and shifted by the rows before them, so no task
    sorts the whole list. The partitions are staged first: their bounds come from sampling and
    have to be the same for counting and for numbering.
    """
    kept = staging.save(items)  # sampling would make them a second time
    ranged = staging.save(kept.repartitionByRange(*order).withColumn(_CHUNK, F.spark_partition_id()))
    # One count per range partition comes to the driver, never more than shuffle partitions.
    counts = dict(ranged.groupBy(_CHUNK).count().collect())
    sizes = [counts.get(chunk, 0) for chunk in range(max(counts, default=-1) + 1)]
    *starts, size = accumulate(sizes, initial=0)
    position = F.row_number().over(Window.partitionBy(_CHUNK).orderBy(*order)).cast("bigint")
    if len(starts) > 1:
        position = position + F.array(*map(F.lit, starts))[F.col(_CHUNK)]
    return NumberedItems(ranged.withColumn(POSITION, position).drop(_CHUNK), size)


def _place(position: Column) -> tuple[Column, Column]:
    """Block of a position and bit within the block, both from 0."""
    place = position - 1
    block = F.shiftright(place, _BLOCK_BITS)
    return block, place.bitwiseAND(_BLOCK_SIZE - 1).cast("int")


def _bit_value(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def first_gaps(catalog: DataFrame, items: NumberedItems, n: int) -> DataFrame:
    """The ``n`` first items of the list that each seller does not list.

    One scan of the catalog yields the sellers and their masks, combined before the shuffle to a
    row per seller, block and task; items that are not on the list fall into block -1. The planner
    chooses the joins by the size of the list.
    """
    none = F.lit(0).cast("bigint")
    block, bit = _place(F.col(POSITION))
    places = items.rows.select(ITEM, block.alias(_BLOCK), _bit_value(bit).alias(_BIT))
    listings = catalog.select(SELLER, ITEM).join(places, ITEM, "left")
    # A row without a seller lists nothing, as NULL equals nothing.
    known = F.col(SELLER).isNotNull() & F.col(_BLOCK).isNotNull()
    masks = listings.groupBy(SELLER, F.when(known, F.col(_BLOCK)).otherwise(-1).alias(_BLOCK)).agg(
        F.bit_or(F.when(known, F.col(_BIT)).otherwise(none)).alias(_MASK)
    )

    by_block = Window.partitionBy(SELLER).orderBy(_BLOCK)
    before = F.coalesce(F.lag(_BLOCK).over(by_block), F.lit(-1))
    after = F.lead(_BLOCK).over(by_block)
    last = F.lit(max(items.size - 1, 0) >> _BLOCK_BITS).cast("bigint")
    own_open = F.when(F.col(_BLOCK) < 0, 0).otherwise(_BLOCK_SIZE - F.bit_count(_MASK))
    stretches = masks.select(
        SELLER,
        _BLOCK,
        _MASK,
        (before + 1).alias("_from"),  # blocks without listings before this one
        F.coalesce(after - 1, last).alias("_to"),  # and after it, up to the next or the last
        (own_open + _BLOCK_SIZE * F.greatest(F.col(_BLOCK) - before - 1, none)).alias("_open"),
        after.isNull().alias("_ends"),
    )
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    open_before = F.coalesce(F.sum("_open").over(earlier), none)
    stretches = stretches.withColumn("_open_before", open_before).filter(F.col("_open_before") < n)

    # Of blocks without listings the first few are enough.
    enough = -(-n // _BLOCK_SIZE)

    def free(start: Column, end: Column) -> Column:
        found = F.sequence(start, F.least(end, start + enough - 1))
        blocks = F.transform(found, lambda b: F.struct(b.alias("b"), none.alias("m")))
        return F.when(start <= end, blocks).otherwise(F.array().cast(blocks_type))

    blocks_type = "array<struct<b: bigint, m: bigint>>"
    own = F.struct(F.col(_BLOCK).alias("b"), F.col(_MASK).alias("m"))
    following = F.when(F.col("_ends"), free(F.col(_BLOCK) + 1, F.col("_to")))
    looked_at = F.concat(
        free(F.col("_from"), F.col(_BLOCK) - 1),
        F.when(F.col(_BLOCK) >= 0, F.array(own)).otherwise(F.array().cast(blocks_type)),
        F.coalesce(following, F.array().cast(blocks_type)),
    )
    blocks = stretches.select(SELLER, F.inline(looked_at))
    bits = F.filter(F.sequence(F.lit(0), F.lit(_BLOCK_SIZE - 1)), lambda k: F.bit_get("m", k) == 0)
    opened = blocks.select(SELLER, "b", F.explode(bits).alias("k"))
    position = (F.col("b") * _BLOCK_SIZE + F.col("k") + 1).alias(POSITION)
    opened = opened.select(SELLER, position).filter(F.col(POSITION) <= items.size)
    gaps = top_n_per_group(opened, [SELLER], [F.asc(POSITION)], n)
    return gaps.select(SELLER, POSITION).join(items.rows, POSITION).drop(POSITION)
