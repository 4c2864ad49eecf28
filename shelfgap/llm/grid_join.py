"""Near-duplicate vectors by an epsilon grid order join.

Vectors of length one link by their cosine if their distance is at most epsilon. They are projected
on their leading principal dimensions, which cannot lengthen a distance, and sorted by the cells, of
side epsilon, of a grid over these: the grid order. The sorted sequence is cut into blocks. Intervals
of the sequence are joined recursively, the whole with itself first: a pair of intervals of which the
boxes are further apart than epsilon is skipped, any other is replaced by the pairs of their parts,
down to pairs of blocks. A task takes a block and some of its partners, goes on in the same way down
to runs of a few rows, and compares the rest as matrix products in double precision. Runs that are so
close together that all their pairs must link are not compared either.

A box also has the length of what the projection leaves out, as one more dimension; by the triangle
inequality this cannot lengthen a distance. Equal vectors are one row with a count from the start. A
task sends on, for each row, how many vectors it links to and one link of a spanning forest, so many
near copies of each other make no more rows than there are vectors and blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfgap.llm.common import staged
from shelfgap.llm.components import connected_components
from shelfgap.llm.union import roots, unite

BLOCK_BYTES = 4 << 20  # of a block in double precision
BLOCKS_PER_RANGE = 8
FAN_OUT = 8  # parts that an interval is cut into
PARTNERS = 4  # blocks that a task compares with its own
RUN_ROWS = 64  # rows of the shortest intervals
GRID_DIMENSIONS = 8
BOX_DIMENSIONS = 16
ROUNDING = 1e-9  # far more than doubles lose in a distance or cosine


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    """The vectors with length one, shorter ones filled up with zeros."""
    size = np.array(column.value_lengths(), np.int64)
    rows = np.zeros((len(size), width))
    rows[np.arange(width)[None, :] < size[:, None]] = np.asarray(column.flatten(), np.float64)
    rows /= np.abs(rows).max(1, keepdims=True)  # so that squares stay within doubles
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def principal_axes(vectors: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and orthonormal principal axes, by falling variance, of the column ``v`` with length one.

    The driver gets ``width`` x (``width`` + 1) sums. Another order of adding them turns the axes a
    little, which no result depends on.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        n = 0
        for batch in batches:
            rows = unit_rows(batch.column(0), width)
            total[0] += rows.sum(0)
            total[1:] += rows.T @ rows
            n += len(rows)
        values = np.append(total.ravel(), n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(values))), pa.array(values, pa.float64())], ["at", "x"]
        )

    sums = vectors.select("v").mapInArrow(add, "at long, x double").groupBy("at").agg(F.sum("x").alias("x"))
    flat = np.zeros((width + 1) * width + 1)
    for row in sums.collect():
        flat[row["at"]] = row["x"]
    n = max(flat[-1], 1.0)
    mean = flat[:width] / n
    spread = flat[width:-1].reshape(width, width) / n - np.outer(mean, mean)
    axes = np.linalg.eigh((spread + spread.T) / 2)[1][:, ::-1]
    return mean, np.ascontiguousarray(axes)


def coordinates(rows: np.ndarray, mean: np.ndarray, axes: np.ndarray, dimensions: int) -> np.ndarray:
    """Projections on the leading axes, and the length of the rest as the last column."""
    moved = rows - mean
    lead = moved @ axes[:, :dimensions]
    rest = np.sqrt(np.maximum((moved * moved).sum(1) - (lead * lead).sum(1), 0.0))
    return np.column_stack([lead, rest])


def _blocks(distinct: DataFrame, width: int, epsilon: float) -> DataFrame:
    """The rows (v, times, key) in grid order, cut into blocks: ``block`` numbers them in turn;
    ``vectors`` and ``at`` are the bytes of their unit vectors and coordinates, ``lo`` and ``hi`` the
    corners of the box around the latter."""
    mean, axes = principal_axes(distinct, width)
    dimensions = min(width, BOX_DIMENSIONS)
    grid = min(width, GRID_DIMENSIONS)
    rows_per_block = max(RUN_ROWS, BLOCK_BYTES // (8 * width))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = coordinates(unit_rows(batch.column(0), width), mean, axes, grid)[:, :grid]
            cells = np.floor(at / epsilon).astype(np.int32)
            offsets = pa.array(np.arange(len(cells) + 1) * grid, pa.int32())
            cell = pa.ListArray.from_arrays(offsets, pa.array(cells.ravel()))
            yield pa.RecordBatch.from_arrays([cell, *batch.columns], ["cell", "v", "times", "key"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema)
    placed = staged(distinct.mapInArrow(place, f"cell array<int>, {types}"), "cells")
    blocks = -(-placed.count() // rows_per_block)
    # By the vector within a cell, so that a full cell is dealt over ranges too.
    ranges = max(1, -(-blocks // BLOCKS_PER_RANGE))
    ordered = placed.repartitionByRange(ranges, "cell", "v").sortWithinPartitions("cell", "v")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, []
        for whole in batches:
            while whole.num_rows:
                room = rows_per_block - sum(b.num_rows for b in held)
                held.append(whole.slice(0, room))
                whole = whole.slice(room)
                if sum(b.num_rows for b in held) == rows_per_block:
                    yield block(part, seq, held)
                    seq, held = seq + 1, []
        if held:
            yield block(part, seq, held)

    def block(part: int, seq: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        column = table["v"].chunk(0)
        rows = unit_rows(column, width)
        at = coordinates(rows, mean, axes, dimensions)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([seq], pa.int32()),
                pa.array([rows.astype("<f8").tobytes()], pa.binary()),
                pa.array([at.astype("<f8").tobytes()], pa.binary()),
                pa.array([table["times"].to_pylist()], pa.list_(pa.int64())),
                pa.array([table["key"].to_pylist()], pa.list_(pa.int64())),
                pa.array([at.min(0).tolist()], pa.list_(pa.float64())),
                pa.array([at.max(0).tolist()], pa.list_(pa.float64())),
            ],
            ["part", "seq", "vectors", "at", "times", "keys", "lo", "hi"],
        )

    schema = (
        "part int, seq int, vectors binary, at binary, times array<long>, keys array<long>, "
        "lo array<double>, hi array<double>"
    )
    made = staged(ordered.select("v", "times", "key").mapInArrow(cut, schema), "blocks")
    # One row per range: what lies before it.
    sizes = made.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()
    before, starts = 0, {}
    for row in sorted(sizes, key=lambda r: r["part"]):
        starts[row["part"]] = before
        before += row["n"]
    offsets = made.sparkSession.createDataFrame(list(starts.items()), "part int, before long")
    return made.join(F.broadcast(offsets), "part").withColumn("block", F.col("before") + F.col("seq"))


def _corners(intervals: DataFrame, by: Column, dimensions: int) -> DataFrame:
    """Boxes (``i``, ``lo``, ``hi``) around the rows of equal ``by``."""
    least = [F.min(F.col("lo")[d]) for d in range(dimensions)]
    most = [F.max(F.col("hi")[d]) for d in range(dimensions)]
    return intervals.groupBy(by.alias("i")).agg(F.array(*least).alias("lo"), F.array(*most).alias("hi"))


def block_pairs(blocks: DataFrame, dimensions: int, epsilon: float) -> DataFrame:
    """``a`` and ``b``, ``a`` <= ``b``: pairs of blocks that may hold vectors within epsilon.

    ``blocks`` has block, lo and hi. From the whole sequence down, pairs of intervals are skipped or
    replaced by the pairs of their parts; a level is a join with the boxes of its intervals.
    """
    levels = [staged(blocks.select(F.col("block").alias("i"), "lo", "hi"), "boxes")]
    while levels[-1].count() > 1:
        wider = _corners(levels[-1], F.floor(F.col("i") / FAN_OUT).cast("long"), dimensions)
        levels.append(staged(wider, "boxes"))
    above = F.zip_with("l.lo", "r.hi", lambda x, y: x - y)
    below = F.zip_with("r.lo", "l.hi", lambda x, y: x - y)
    gap = F.zip_with(above, below, lambda x, y: F.greatest(x, y, F.lit(0.0)))
    apart = F.aggregate(gap, F.lit(0.0), lambda total, x: total + x * x)
    reach = F.lit((epsilon + ROUNDING) ** 2)
    pairs = levels[-1].select(F.col("i").alias("a"), F.col("i").alias("b"))
    parts = F.array(*[F.lit(k) for k in range(FAN_OUT)])
    for boxes in levels[-2::-1]:
        inner = (
            pairs.withColumn("x", F.explode(parts))
            .withColumn("y", F.explode(parts))
            .select((F.col("a") * FAN_OUT + F.col("x")).alias("a"), (F.col("b") * FAN_OUT + F.col("y")).alias("b"))
            .where("a <= b")
        )
        near = inner.join(boxes.alias("l"), F.col("a") == F.col("l.i"))
        near = near.join(boxes.alias("r"), F.col("b") == F.col("r.i"))
        pairs = staged(near.where(apart <= reach).select("a", "b"), "pairs")
    return pairs


class Block:
    """A block in the memory of a task, with the boxes and balls of its runs of rows."""

    def __init__(self, number: int, vectors: bytes, at: bytes, times: list[int]):
        self.number = number
        self.times = np.array(times, np.int64)
        self.rows = np.frombuffer(vectors, "<f8").reshape(len(times), -1)
        places = np.frombuffer(at, "<f8").reshape(len(times), -1)
        self.starts = np.arange(0, len(times), RUN_ROWS)
        self.levels = [(np.minimum.reduceat(places, self.starts), np.maximum.reduceat(places, self.starts))]
        while len(self.levels[-1][0]) > 1:
            lo, hi = self.levels[-1]
            pairs = np.arange(0, len(lo), 2)
            self.levels.append((np.minimum.reduceat(lo, pairs), np.maximum.reduceat(hi, pairs)))
        n = np.diff(np.append(self.starts, len(times)))
        self.centres = np.add.reduceat(self.rows, self.starts) / n[:, None]
        away = self.rows - np.repeat(self.centres, n, axis=0)
        self.radii = np.sqrt(np.maximum.reduceat((away * away).sum(1), self.starts))
        self.weights = np.add.reduceat(self.times, self.starts)

    def run(self, k: int) -> slice:
        return slice(int(self.starts[k]), int(min(self.starts[k] + RUN_ROWS, len(self.rows))))


def run_pairs(a: Block, b: Block, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the runs of a and of b that may hold rows within epsilon, by halving intervals; of a
    block with itself each pair once."""
    depth = max(len(a.levels), len(b.levels)) - 1
    i = j = np.zeros(1, np.int64)
    for level in range(depth, -1, -1):
        of_a, of_b = min(level, len(a.levels) - 1), min(level, len(b.levels) - 1)
        (lo_a, hi_a), (lo_b, hi_b) = a.levels[of_a], b.levels[of_b]
        near = np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 16):
            p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            gap = np.maximum(np.maximum(lo_a[p] - hi_b[q], lo_b[q] - hi_a[p]), 0.0)
            near[at : at + (1 << 16)] = (gap * gap).sum(1) <= (epsilon + ROUNDING) ** 2
        i, j = i[near], j[near]
        if level:
            i, j = _halves(i, j, of_a == level, of_b == level, a, b, level)
        if a is b:
            i, j = i[i <= j], j[i <= j]
    return i, j


def _halves(i, j, cut_a: bool, cut_b: bool, a: Block, b: Block, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of the parts of the intervals; a block with fewer levels is not cut yet."""
    if cut_a:
        i, j = np.concatenate([2 * i, 2 * i + 1]), np.concatenate([j, j])
        inside = i < len(a.levels[level - 1][0])
        i, j = i[inside], j[inside]
    if cut_b:
        i, j = np.concatenate([i, i]), np.concatenate([2 * j, 2 * j + 1])
        inside = j < len(b.levels[level - 1][0])
        i, j = i[inside], j[inside]
    return i, j


def exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def compare(a: Block, b: Block, least: float, links: list[np.ndarray], labels: np.ndarray, starts: list[int]) -> None:
    """Adds the links between the rows of a and b to the counts ``links`` of both, and joins their
    classes in ``labels``, where ``starts`` are their first places."""
    epsilon = math.sqrt(2.0 - 2.0 * least)
    i, j = run_pairs(a, b, epsilon)
    apart = np.sqrt(np.maximum(((a.centres[i] - b.centres[j]) ** 2).sum(1), 0.0))
    reach = a.radii[i] + b.radii[j]
    possible = apart - reach <= epsilon + ROUNDING
    i, j, surely = i[possible], j[possible], (apart + reach <= epsilon - ROUNDING)[possible]
    one = a is b
    for p, q in zip(i[surely].tolist(), j[surely].tolist()):
        x, y = a.run(p), b.run(q)
        links[0][x] += b.weights[q] - (a.times[x] if one and p == q else 0)
        if not (one and p == q):
            links[1][y] += a.weights[p]
        ends = np.concatenate([np.arange(x.start, x.stop) + starts[0], np.arange(y.start, y.stop) + starts[1]])
        unite(labels, ends[1:], np.full(len(ends) - 1, ends[0]))
    i, j = i[~surely], j[~surely]
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    cuts = np.flatnonzero(np.diff(i)) + 1
    for mine, theirs in zip(np.split(i, cuts), np.split(j, cuts)) if len(i) else ():
        x = a.run(int(mine[0]))
        for lo in range(0, len(theirs), 64):
            runs = theirs[lo : lo + 64]
            other = np.concatenate([np.arange(s.start, s.stop) for s in map(b.run, runs.tolist())])
            cosine = a.rows[x] @ b.rows[other].T
            linked = cosine >= least
            for u, v in zip(*np.nonzero(np.abs(cosine - least) < ROUNDING)):
                linked[u, v] = exact_cosine(a.rows[x.start + u], b.rows[other[v]]) >= least
            if one:  # each pair once
                linked &= np.arange(x.start, x.stop)[:, None] < other[None, :]
            if not linked.any():
                continue
            links[0][x] += linked @ b.times[other]
            np.add.at(links[1], other, a.times[x] @ linked)
            u, v = np.nonzero(linked)
            unite(labels, u + x.start + starts[0], other[v] + starts[1])


ROW_BITS = 24  # of a row's number within its block
_LINKS = "node long, n long, to long"


def _links(pairs: DataFrame, blocks: DataFrame, least: float) -> DataFrame:
    """``node``, ``n`` and ``to``: a row's links with other rows of the blocks that a task compares, and
    another row of its class there, itself at the first one."""
    data = blocks.select("block", "vectors", "at", "times")
    part = F.floor(F.col("b") / PARTNERS).cast("long").alias("part")
    asked = staged(pairs.select("a", "b", part), "asked")
    # The own block is sent once to each task, its partners with it.
    columns = ["a", "part", *data.columns]
    theirs = asked.where("a <> b").join(data, F.col("b") == F.col("block")).select(*columns)
    own = asked.select("a", "part", (F.col("a") == F.col("b")).alias("same"))
    own = own.groupBy("a", "part").agg(F.max("same").alias("same"))
    own = own.join(data, F.col("a") == F.col("block")).select(*columns, "same")
    rows = own.unionByName(theirs.withColumn("same", F.lit(False)))

    def task(key: tuple, table: pa.Table) -> pa.Table:
        number = key[0].as_py()
        blocks, same = [], False
        for k in range(table.num_rows):
            blocks.append(Block(*[table[c][k].as_py() for c in ("block", "vectors", "at", "times")]))
            same = same or table["same"][k].as_py()
        blocks.sort(key=lambda x: (x.number != number, x.number))
        starts = np.cumsum([0] + [len(x.rows) for x in blocks]).tolist()
        labels = np.arange(starts[-1])
        links = [np.zeros(len(x.rows), np.int64) for x in blocks]
        mine = blocks[0]
        if same:
            compare(mine, mine, least, [links[0], links[0]], labels, [0, 0])
        for k in range(1, len(blocks)):
            compare(mine, blocks[k], least, [links[0], links[k]], labels, [0, starts[k]])
        ids = np.concatenate([(x.number << ROW_BITS) + np.arange(len(x.rows)) for x in blocks])
        n = np.concatenate(links)
        found = np.flatnonzero(n)
        to = ids[roots(labels, found)]
        return pa.table({"node": pa.array(ids[found]), "n": pa.array(n[found]), "to": pa.array(to)})

    return rows.groupBy("a", "part").applyInArrow(task, _LINKS)


def near_duplicate_vectors(
    vectors: DataFrame, least: float = 0.95, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``.

    Two vectors link if their cosine is ``least`` (above 0) or more; n_links counts the other rows
    linked directly, copies included, component_id is the smallest vec_id reachable, NULL only if
    there is no other, and kept says whether it is the row's own. Vectors that are NULL, empty, zero
    or hold NULL or non-finite components link with nothing. Vectors shorter than the longest count as
    filled up with zeros. Repeated rows stay and link with each other. An empty table gives an empty
    result; other columns are ignored.
    """
    of = F.col(vector)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), of.alias("v"))
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    good = F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = rows.select("vec_id", F.when(good, v).alias("v"))
    distinct = rows.where(v.isNotNull()).groupBy("v")
    distinct = distinct.agg(F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("first"))
    distinct = staged(distinct.withColumn("key", F.monotonically_increasing_id()), "vectors")
    no_links = F.lit(0).cast("long").alias("n_links")
    alone = rows.where(v.isNull()).select("vec_id", no_links, F.col("vec_id").alias("component_id"))
    width = distinct.agg(F.max(F.size("v")).alias("n")).first()["n"]
    if width:
        found = staged(_classes(distinct, width, least), "classes")
        linked = ["vec_id", "n_links", "component_id"]
        single = found.where("times = 1").withColumn("vec_id", F.col("first")).select(*linked)
        copies = rows.join(found.where("times > 1").drop("vec_id"), "v").select(*linked)
        alone = alone.unionAll(single).unionAll(copies)
    return alone.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _classes(distinct: DataFrame, width: int, least: float) -> DataFrame:
    """``distinct`` (v, times, first, key) with the links of each vector and the smallest vec_id that
    it reaches."""
    epsilon = math.sqrt(2.0 - 2.0 * least)
    blocks = _blocks(distinct.select("v", "times", "key"), width, epsilon)
    pairs = block_pairs(blocks, min(width, BOX_DIMENSIONS) + 1, epsilon)
    links = staged(_links(pairs, blocks, least), "links")
    component = connected_components(links.where("node <> to").select("node", "to"))
    component = component.withColumnRenamed("component", "to")
    counts = links.groupBy("node").agg(F.sum("n").alias("n")).join(component, "node", "left")
    rows = blocks.select("block", F.posexplode("keys").alias("row", "key"))
    keyed = rows.select((F.shiftleft("block", ROW_BITS) + F.col("row")).alias("node"), "key")
    found = keyed.join(counts, "node").select("key", "n", F.coalesce("to", "node").alias("to"))
    # Staged, so that Spark may split the rows of a large component.
    found = staged(found.join(distinct.select("key", "first"), "key"), "found")
    smallest = staged(found.groupBy("to").agg(F.min("first").alias("component_id")), "smallest")
    found = found.join(smallest, "to").select("key", "n", "component_id")
    return distinct.join(found, "key", "left").select(
        "v",
        "times",
        "first",
        (F.coalesce("n", F.lit(0)) + F.col("times") - 1).cast("long").alias("n_links"),
        F.coalesce("component_id", "first").alias("component_id"),
    )
