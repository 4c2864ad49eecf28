"""Mixing sources to target weights by a low-discrepancy schedule.

The documents of a source, shuffled by a hash, make one stream of words, cut into blocks of equal
length; the stream may be gone through more than once. The mix has as many slots as all targets
together need blocks. Slot t belongs to the source in whose part of the cumulative targets the
golden-ratio point frac(t x 0.618...) falls, and the k-th slot of a source takes its block k. So
the points alone decide how many blocks a source gives, and any run of slots is near the weights.

Everything is aggregates, equi-joins and windows over bounded groups: positions in a stream and
ranks of slots are sums over chunks plus sums within a chunk, so no source is one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfgap.llm.common import free_name, n_words, staged

GOLDEN = 0.6180339887498949  # fractional part of the golden ratio
BLOCK_WORDS = 128
SLOT_CHUNK = 1 << 16
POINTS = 1 << 31  # places of the unit interval; whole numbers are exact at any slot
CELLS = 1 << 12  # of the unit interval, to find a slot's source by an equi-join
CHUNK_ROWS = 1 << 14  # rows of a chunk of a stream, about
PART_WORDS = 1 << 22  # words of a part of the written mix, or more


def _before(partition: Sequence[str], order: str) -> Window:
    """All earlier rows."""
    spec = Window.partitionBy(*partition) if partition else Window
    return spec.orderBy(F.col(order).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)


def sized(docs: DataFrame, text: str = "text", *more: Column) -> DataFrame:
    """doc_id, source, size in words (0 for a NULL text), the key that shuffles a source (of the
    text where doc_id is NULL), and more columns that tell rows apart."""
    of_id, of_text = F.md5(F.col("doc_id").cast("string").cast("binary")), F.md5(F.col(text).cast("binary"))
    return docs.select(
        F.col("doc_id"),
        F.col("source"),
        n_words(F.col(text)).alias("size"),
        F.coalesce(of_id, of_text, F.lit("")).alias("key"),
        *more,
    )


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size and target of every source.

    Sources in order of code points, NULL last, take ``weights`` in turn. Together they get
    ``share`` of all words. No target exceeds ``most`` times its source's size; the excess goes to
    the others by weight. That ends with min(cap, level x weight) for one common level, which is
    the largest that fits, tried at each source by rising cap/weight. The windows run over one row per source.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"),
    )
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    sources = sources.withColumn("bound", F.col("cap") / F.col("weight"))
    rising = Window.orderBy("bound", F.col("source").asc_nulls_last())
    here_on = rising.rowsBetween(0, Window.unboundedFollowing)
    full = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    all_words = F.sum("source_size").over(Window.partitionBy()) * float(share)
    level = (all_words - full) / F.sum("weight").over(here_on)
    sources = sources.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("bound"), F.col("level"))
    sources = sources.withColumn("level", F.max(fits).over(Window.partitionBy()))
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return sources.select("source", "source_size", target.alias("target"))


def n_slots(sources: DataFrame, block_words: int = BLOCK_WORDS) -> int:
    """Blocks that all targets together, each rounded down, need."""
    words = sources.agg(F.sum(F.floor("target").cast("long"))).first()[0] or 0
    return -(-words // block_words)


def schedule(sources: DataFrame, slots: int, golden: float = GOLDEN) -> DataFrame:
    """slot, source and block of slots 0 to ``slots`` - 1; the blocks of each source are numbered
    from 0 in the order of its slots.

    ``sources`` has source and target. A source gets a share of the slots that differs from its
    share of the targets by a few slots, as the points have a low discrepancy.
    """
    step = int(golden * POINTS) | 1  # odd, so that the points repeat after all POINTS places
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    wanted = F.floor("target").cast("long")
    parts = sources.select("source", wanted.alias("wanted")).where(F.col("wanted") > 0)
    share = F.sum("wanted").over(in_order).cast("double") / F.sum("wanted").over(Window.partitionBy())
    parts = parts.withColumn("hi", F.floor(share * POINTS).cast("long"))
    parts = parts.withColumn("lo", F.coalesce(F.lag("hi").over(in_order), F.lit(0)))
    cell = POINTS // CELLS
    cells = F.sequence(F.floor(F.col("lo") / cell), F.floor((F.col("hi") - 1) / cell))
    parts = parts.where(F.col("lo") < F.col("hi")).withColumn("cell", F.explode(cells))

    points = sources.sparkSession.range(slots).withColumnRenamed("id", "slot")
    points = points.withColumn("at", F.col("slot") % POINTS * step % POINTS)
    points = points.withColumn("cell", F.floor(F.col("at") / cell))
    dealt = points.join(parts, "cell").where((F.col("lo") <= F.col("at")) & (F.col("at") < F.col("hi")))
    dealt = dealt.select("slot", "source", F.floor(F.col("slot") / SLOT_CHUNK).alias("chunk"))

    counts = dealt.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("base", F.coalesce(F.sum("n").over(_before(["source"], "chunk")), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1
    ranked = dealt.withColumn("within", within).join(
        counts.select(F.col("source").alias("of"), F.col("chunk").alias("in_chunk"), "base"),
        F.col("source").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("in_chunk")),
    )
    return ranked.select("slot", "source", (F.col("base") + F.col("within")).cast("long").alias("block"))


def _streams(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Every row of ``sizes`` with the position of its first word in its source's stream.

    A chunk of a stream is all keys with the same first digits; their number follows the rows, and
    the positions are the same for any number."""
    rows = sizes.count()
    digits = next(d for d in range(1, 32) if rows <= CHUNK_ROWS * 16**d)
    rows = sizes.withColumn("chunk", F.substring("key", 1, digits))
    chunks = rows.groupBy("source", "chunk").agg(F.sum("size").alias("n"))
    chunks = chunks.select(
        F.col("source").alias("of"),
        F.col("chunk").alias("in_chunk"),
        F.coalesce(F.sum("n").over(_before(["source"], "chunk")), F.lit(0)).alias("base"),
    )
    rest = [F.col(c).asc_nulls_last() for c in sizes.columns if c not in ("source", "key")]
    order = Window.partitionBy("source", "chunk").orderBy("key", *rest)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(before), F.lit(0)))
    rows = rows.withColumn("row", F.row_number().over(order))
    rows = rows.join(
        chunks, F.col("source").eqNullSafe(F.col("of")) & F.col("chunk").eqNullSafe(F.col("in_chunk"))
    ).drop("of", "in_chunk")
    sources = sources.select(F.col("source").alias("of"), "source_size", "target")
    rows = rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = rows.withColumn("first", (F.col("base") + F.col("within")).cast("long"))
    return rows.drop("base", "within")


_KEY = ["source", "chunk", "row"]


def _pieces(rows: DataFrame, slots: DataFrame, most: float, block_words: int) -> DataFrame:
    """source, chunk, row, slot, pass, from_word and words of every block's part of a document."""
    start = F.col("first") + F.col("pass") * F.col("source_size")
    bound = F.floor(F.col("source_size") * float(most)).cast("long")
    passes = F.array(*[F.lit(k) for k in range(int(-(-most // 1)))])
    placed = rows.select(*_KEY, "size", "source_size", "first", F.explode(passes).alias("pass"))
    placed = placed.withColumn("from", start).withColumn("to", F.least(start + F.col("size"), bound))
    placed = placed.where(F.col("from") < F.col("to")).drop("size", "source_size", "first")
    per_block = F.sequence(
        F.floor(F.col("from") / block_words), F.floor((F.col("to") - 1) / block_words)
    )
    placed = placed.withColumn("in_block", F.explode(per_block))
    slots = slots.select("slot", F.col("source").alias("of"), "block")
    lo = F.greatest(F.col("from"), F.col("block") * block_words)
    hi = F.least(F.col("to"), (F.col("block") + 1) * block_words)
    return placed.join(
        slots, F.col("source").eqNullSafe(F.col("of")) & (F.col("in_block") == F.col("block"))
    ).select(*_KEY, "slot", "pass", (lo - F.col("from")).alias("from_word"), (hi - lo).alias("words"))


def _with(rows: DataFrame, more: DataFrame) -> DataFrame:
    """All rows, with what ``more`` has for them."""
    more = more.withColumnsRenamed({c: f"_{c}" for c in _KEY})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _KEY]
    return rows.join(more, same, "left").drop(*[f"_{c}" for c in _KEY])


def _dealt(
    sizes: DataFrame, weights: Sequence[float], share: float, most: float, block_words: int, golden: float
) -> tuple[DataFrame, DataFrame, int]:
    """The rows placed in their streams, the pieces that the mix takes, and the number of slots."""
    sources = staged(targets(sizes, weights, share, most), "targets")
    slots = n_slots(sources, block_words)
    rows = _streams(sizes, sources)
    dealt = schedule(sources.select("source", "target"), slots, golden)
    return rows, _pieces(rows, dealt, most, block_words), slots


def mixture(
    sizes: DataFrame,
    weights: Sequence[float],
    share: float,
    most: float,
    block_words: int = BLOCK_WORDS,
    golden: float = GOLDEN,
) -> DataFrame:
    """The mix in pieces: one row per document and block that takes words of it.

    ``sizes`` is what ``sized`` gives; it is read several times. Returns its columns with
    source_size, target, chunk and row (which with source tell rows apart), slot, pass (0 the
    first time through the source), from_word (of the document's words) and words. Documents that
    the mix leaves out have one row without slot. Blocks past ``most`` times a source are empty,
    and the last one before may be shorter.
    """
    rows, pieces, _ = _dealt(sizes, weights, share, most, block_words, golden)
    return _with(rows.drop("first"), pieces)


def taken_words(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = BLOCK_WORDS,
    text: str = "text",
    golden: float = GOLDEN,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_slot and n_pieces of every row of ``docs``:
    how many words the mix takes of it, repeats counted, in which slot it is first met and in how
    many pieces it comes (one per block and pass).

    A NULL or empty text has size 0 and is not taken: its first_slot is NULL. NULL sources are one
    source, the last. Documents with equal doc_ids follow each other in the stream, by size; equal
    rows may get different shares, but the rows of the result are the same on every run. A source's
    words add up to its slots times ``block_words``, a few blocks from its target at most, and
    never to more than ``most`` times its size. An empty table gives an empty result. Other columns
    are ignored.
    """
    sizes = staged(sized(docs, text), "sizes")
    rows, pieces, _ = _dealt(sizes, weights, share, most, block_words, golden)
    taken = pieces.groupBy(*_KEY).agg(
        F.sum("words").alias("words"), F.min("slot").alias("first_slot"), F.count(F.lit(1)).alias("pieces")
    )
    return _with(rows, taken).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("words", F.lit(0)).cast("long").alias("taken"),
        "first_slot",
        F.coalesce("pieces", F.lit(0)).cast("long").alias("n_pieces"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = BLOCK_WORDS,
    text: str = "text",
    golden: float = GOLDEN,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes its words, rounded to whole times, in
    the order of the slots: each copy stands where its pass through the source first meets it, and
    the parts of the result follow each other.

    Texts without words are in no block and go; a NULL source is one source, the last. Equal rows
    may come a different number of times. A long text stays whole, at its first slot. An empty
    table gives an empty result. All columns are kept, whatever their names.
    """
    of, nth, slot = (free_name(docs, n) for n in ("text_hash", "nth", "slot"))
    alike = Window.partitionBy("doc_id", "source", of).orderBy(of)
    rows = docs.withColumn(of, F.xxhash64(text)).withColumn(nth, F.row_number().over(alike))
    sizes = sized(docs, text, F.xxhash64(text).alias("text_hash"))
    alike = Window.partitionBy("doc_id", "source", "text_hash").orderBy("text_hash")
    sizes = staged(sizes.withColumn("nth", F.row_number().over(alike)), "sizes")
    placed, pieces, slots = _dealt(sizes, weights, share, most, block_words, golden)
    first = [F.min(F.when(F.col("pass") == k, F.col("slot"))) for k in range(int(-(-most // 1)))]
    taken = pieces.groupBy(*_KEY).agg(F.sum("words").alias("words"), F.array(*first).alias("slots"))
    copies = F.round(F.col("words") / F.col("size")).cast("int")
    names = {c: free_name(rows, f"mix_{c}") for c in ("doc_id", "source", "text_hash", "nth")}
    taken = _with(placed, taken).where(copies > 0).select(
        *[F.col(c).alias(n) for c, n in names.items()], F.explode(F.slice("slots", 1, copies)).alias(slot)
    )
    same = [
        F.col("doc_id").eqNullSafe(F.col(names["doc_id"])),
        F.col("source").eqNullSafe(F.col(names["source"])),
        F.col(of) == F.col(names["text_hash"]),
        F.col(nth) == F.col(names["nth"]),
    ]
    most_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(most_parts, slots * block_words // PART_WORDS))
    part = F.floor(F.col(slot) * parts / F.lit(max(slots, 1))).cast("int")
    many = rows.join(taken, same).repartitionById(parts, part)
    return many.sortWithinPartitions(slot, "doc_id").select(*docs.columns)
