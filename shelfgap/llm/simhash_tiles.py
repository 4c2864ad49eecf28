"""SimHash near-duplicates by exact comparison in tiles.

Fingerprints of equal population counts of both halves form cells, cells are cut into tiles of a
bounded size, and all pairs of tiles are compared whose counts differ by no more than the radius:
every differing bit moves a count by one at most. A comparison is numpy's exclusive-or and bit
count over whole tiles. A task sends on a spanning forest of the links that it has found, not the
links, so a group of many near copies gives no more rows than it has members; connected components
put the forests together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfgap.llm.common import free_name, staged
from shelfgap.llm.components import connected_components
from shelfgap.llm.prefixes import Order, late_shingles, near_links, prefix
from shelfgap.llm.shingle_sets import blocks_of, set_name, similar_pairs
from shelfgap.llm.union import roots as _roots, unite

SEED = 42
TILE_ROWS = 1 << 15
TILES_PER_GROUP = 64
GROUP_BYTES = 32 << 20  # of fingerprints that a task holds together, about
CELLS_AT_ONCE = 1 << 20  # of a comparison
HITS_AT_ONCE = 1 << 17  # of its cells that are compared in full
BITS_AT_ONCE = 1 << 16  # hashes unpacked together
ROWS_AT_ONCE = 1 << 10  # whose keys go on together
_ODD = 0x9E3779B97F4A7C15
_MIX = [(2 * k + 1) * _ODD % (1 << 64) for k in range(16)]  # odd factors, one per 64 bits


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of the word shingles, repeats included, A-Z in lower case; fewer words give one."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(words) - shingle + 1)
    last = np.minimum(np.arange(n) + shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), (ends[last] - 1).tolist())]
    return np.array(found, np.uint64)


def fingerprint_of(hashes: np.ndarray, words: int = 1) -> bytes:
    """64 x ``words`` bits, little-endian: a bit is 1 if more than half of the hashes have it. The
    first 64 bits are those of the hashes, the others of hashes mixed from them."""
    out = []
    for k in range(words):
        mixed = hashes
        if k:
            mixed = (hashes ^ hashes >> np.uint64(32)) * np.uint64(_MIX[k])
            mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(_MIX[0])
            mixed ^= mixed >> np.uint64(32)
        ones = np.zeros(64, np.int64)
        for lo in range(0, len(mixed), BITS_AT_ONCE):
            part = mixed[lo : lo + BITS_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(np.packbits(ones * 2 > len(mixed), bitorder="little").tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, shingle: int, words: int = 1, text: str = "text") -> DataFrame:
    """doc_id, text_hash (a long) and fingerprint (8 x ``words`` bytes) of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint_of(shingle_hashes(t.as_py() or b"", shingle), words) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.binary())],
                ["doc_id", "text_hash", "fingerprint"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).cast("binary").alias("text"),
    )
    return rows.mapInArrow(compute, "doc_id long, text_hash long, fingerprint binary")


def _matrix(column: list[bytes], words: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u8").reshape(-1, words)


def _tile(rows: pa.ListScalar, words: int) -> np.ndarray:
    """The fingerprints of a tile, without an object for each."""
    fixed = rows.values.cast(pa.binary(8 * words))
    found = np.frombuffer(fixed.buffers()[1], "<u8", len(fixed) * words, fixed.offset * 8 * words)
    return found.reshape(-1, words)


def _column(parts: list[np.ndarray], words: int) -> pa.Array:
    rows = np.concatenate([np.zeros((0, words), "<u8"), *parts])
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * words), len(rows), [None, pa.py_buffer(rows)])
    return fixed.cast(pa.binary())


def _quarters(first: np.ndarray) -> np.ndarray:
    """Population counts of the four quarters of the leading 64 bits."""
    parts = np.ascontiguousarray(first).view("<u2").reshape(-1, 4)
    return np.bitwise_count(parts).astype(np.int64)


def near_pairs(
    a: np.ndarray, b: np.ndarray, radius: int, first_radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of a and of b at most ``radius`` bits apart, and at most ``first_radius`` in
    the leading 64 bits, a part at a time. Large tiles are cut again, by the population counts of
    quarters, and pairs of parts skipped alike."""
    rows = np.arange(len(a))
    if len(a) * len(b) > 4 * CELLS_AT_ONCE:
        of_a, of_b = _quarters(a[:, 0]), _quarters(b[:, 0])
        key = of_a @ np.array([17**3, 17**2, 17, 1])
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        parts = np.split(order, cuts)
        # One at a time: with a large radius each part meets nearly all of b.
        picks = ((p, np.flatnonzero(np.abs(of_b - of_a[p[0]]).sum(1) <= first_radius)) for p in parts)
    else:
        picks = iter([(rows, np.arange(len(b)))])
    for mine, theirs in picks:
        if not len(theirs):
            continue
        other = b[theirs]
        step = max(1, CELLS_AT_ONCE // len(theirs))
        for lo in range(0, len(mine), step):
            part = a[mine[lo : lo + step]]
            bits = np.bitwise_count(part[:, 0][:, None] ^ other[:, 0][None, :])
            hits = np.flatnonzero(bits <= first_radius)
            for at in range(0, len(hits), HITS_AT_ONCE):
                i, j = np.divmod(hits[at : at + HITS_AT_ONCE], len(theirs))
                if part.shape[1] > 1:
                    close = np.bitwise_count(part[i] ^ other[j]).sum(1, dtype=np.int64) <= radius
                    i, j = i[close], j[close]
                if len(i):
                    yield mine[lo + i], theirs[j]


def _bins(radius: int) -> int:
    """Width of the bins of a population count: 1 for small radii."""
    return max(1, radius // 4)


def links(distinct: DataFrame, radius: int, words: int = 1, first_radius: int | None = None) -> DataFrame:
    """``a`` and ``b``: fingerprints, enough to connect all that reach each other by links.

    ``distinct`` has a column ``fingerprint`` without repeats. Two link if they differ in at most
    ``radius`` bits, and in at most ``first_radius`` of the first 64 (as many, if not given).
    """
    first_radius = radius if first_radius is None else first_radius
    width = _bins(first_radius)
    # Population counts of the halves of the first 64 bits, which are little-endian bytes.
    number = lambda at: F.conv(F.hex(F.substring("fingerprint", at, 4)), 16, 10).cast("long")
    binned = lambda at: F.floor(F.bit_count(number(at)) / width).cast("int")
    cells = distinct.select("fingerprint", binned(1).alias("lo"), binned(5).alias("hi"))
    counts = cells.groupBy("lo", "hi").agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).alias("parts"))
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    tile = ((F.col("lo") * 128 + F.col("hi")).cast("long") * (1 << 32) + part).alias("tile")
    # There are at most 33 x 33 cells.
    tiled = cells.join(F.broadcast(counts), ["lo", "hi"]).select("lo", "hi", tile, "fingerprint")
    packed = tiled.groupBy("tile", "lo", "hi").agg(F.collect_list("fingerprint").alias("rows"))
    packed = staged(packed, "tiles")

    # Bins k apart hold counts that differ by (k - 1) x width + 1 at least.
    least = lambda k: 0 if k == 0 else (k - 1) * width + 1
    reach = range(-(first_radius // width) - 1, first_radius // width + 2)
    offsets = [(x, y) for x in reach for y in reach if least(abs(x)) + least(abs(y)) <= first_radius]
    offset = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in offsets]))
    ids = packed.select("tile", "lo", "hi")
    together = max(1, min(TILES_PER_GROUP, GROUP_BYTES // (TILE_ROWS * 8 * words)))
    groups = max(1, -(-ids.count() // together))
    around = ids.select("tile", "lo", "hi", offset.alias("o")).select(
        F.col("tile").alias("a"), (F.col("lo") + F.col("o.x")).alias("lo"), (F.col("hi") + F.col("o.y")).alias("hi")
    )
    pairs = around.join(ids, ["lo", "hi"]).where(F.col("a") <= F.col("tile"))
    pairs = pairs.select("a", "tile", F.pmod(F.xxhash64("tile"), F.lit(groups)).alias("part"))
    data = packed.select("tile", "rows")
    theirs = pairs.join(data, "tile").select("a", "part", F.lit(False).alias("own"), "tile", "rows")
    owners = pairs.select(F.col("a").alias("tile"), "part").distinct()
    own = owners.join(data, "tile").select(
        F.col("tile").alias("a"), "part", F.lit(True).alias("own"), "tile", "rows"
    )

    def compare(table: pa.Table) -> pa.Table:
        tiles, names = table["rows"], table["tile"].to_pylist()
        mine = table["own"].to_pylist().index(True)
        a = _tile(tiles[mine], words)
        labels = np.arange(len(a))
        members, roots = [], []
        for k, name in enumerate(names):
            if k == mine:
                continue
            if name == names[mine]:  # the tile with itself
                for i, j in near_pairs(a, a, radius, first_radius):
                    unite(labels, i, j)
                continue
            # Rows of another tile link to rows of this one only, so their roots are here.
            b = _tile(tiles[k], words)
            labels = np.concatenate([labels, len(a) + np.arange(len(b))])
            for i, j in near_pairs(a, b, radius, first_radius):
                unite(labels, i, j + len(a))
            joined = np.flatnonzero(labels[len(a) :] != len(a) + np.arange(len(b)))
            members.append(b[joined])
            roots.append(a[_roots(labels, len(a) + joined)])
            labels = labels[: len(a)].copy()
        joined = np.flatnonzero(labels != np.arange(len(a)))
        members.append(a[joined])
        roots.append(a[_roots(labels, joined)])
        return pa.table({"a": _column(members, words), "b": _column(roots, words)})

    return theirs.unionAll(own).groupBy("a", "part").applyInArrow(compare, "a binary, b binary")


def components(
    prints: DataFrame, radius: int, words: int = 1, first_radius: int | None = None
) -> DataFrame:
    """fingerprint, component and component_id for every distinct fingerprint of ``prints`` (doc_id,
    fingerprint): a fingerprint that names the component, and the smallest doc_id in it."""
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    distinct = staged(distinct, "distinct")
    found = connected_components(links(distinct, radius, words, first_radius))
    placed = distinct.join(found, F.col("fingerprint") == F.col("node"), "left")
    placed = placed.withColumn("component", F.coalesce("component", "fingerprint"))
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    return placed.join(least, "component").select("fingerprint", "component", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of ``docs``.

    A NULL text counts as empty; texts without words have fingerprint 0 and link like others, so
    they are one group. Equal texts share a fingerprint, repeated rows stay. A NULL doc_id is never
    a component_id, unless a group has no other. Long texts are read whole. An empty table gives an
    empty result; other columns are ignored.
    """
    prints = staged(fingerprints(docs, shingle, text=text).select("doc_id", "fingerprint"), "prints")
    found = prints.join(components(prints, radius), "fingerprint")
    digits = F.lower(F.hex("fingerprint"))
    # The bytes are little-endian; digits start with the highest.
    big_endian = F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in range(7, -1, -1)])
    return found.select("doc_id", big_endian.alias("fingerprint"), "component_id")


def set_prints(
    docs: DataFrame, shingle: int, words: int, similarity: float, order: Order, text: str = "text"
) -> DataFrame:
    """doc_id, text_hash, node (16 bytes that name the set of shingles), fingerprint (8 x ``words``
    bytes, of the set), n (shingles in the set), lead (the first 64 bits of the fingerprint) and keys
    (the shingles one of which sets of ``similarity`` share) of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (b.slice(k, ROWS_AT_ONCE) for b in batches for k in range(0, b.num_rows, ROWS_AT_ONCE))
        for batch in parts:
            sets = (np.unique(shingle_hashes(t.as_py() or b"", shingle)) for t in batch.column(2))
            found = [
                (set_name(s), fingerprint_of(s, words), len(s), prefix(s, similarity, order).astype("<u8").tobytes())
                for s in sets
            ]
            node, prints, n, keys = list(zip(*found)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(node, pa.binary()),
                    pa.array(prints, pa.binary()),
                    pa.array(n, pa.int64()),
                    pa.array([int.from_bytes(p[:8], "little", signed=True) for p in prints], pa.int64()),
                    pa.array(keys, pa.binary()),
                ],
                ["doc_id", "text_hash", "node", "fingerprint", "n", "lead", "keys"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).cast("binary").alias("text"),
    )
    return rows.mapInArrow(
        compute, "doc_id long, text_hash long, node binary, fingerprint binary, n long, lead long, keys binary"
    )


def _sets_of(docs: DataFrame, wanted: DataFrame, shingle: int, text: str) -> DataFrame:
    """near, blocks, node and shingles (the set as bytes) of every row of ``wanted``, once."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t.as_py() or b"", shingle)) for t in batch.column("text")]
            shingles = pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())
            columns = [batch.column(c) for c in ("near", "blocks", "node")]
            yield pa.RecordBatch.from_arrays([*columns, shingles], ["near", "blocks", "node", "shingles"])

    texts = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(text).alias("hash"),
        F.col(text).cast("binary").alias("text"),
    )
    same = F.col("id").eqNullSafe(F.col("first.doc_id")) & (F.col("hash") == F.col("first.text_hash"))
    rows = texts.join(wanted, same).select("near", "blocks", "node", "text")
    sets = rows.mapInArrow(compute, "near binary, blocks long, node binary, shingles binary")
    return sets.dropDuplicates(["node"])  # rows with the same doc_id and text


def drop_near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    similarity: float = 0.8,
    words: int = 8,
    radius: int = 115,
    first_radius: int = 22,
    text: str = "text",
) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest doc_id, NULL last.

    Two texts are near duplicates if their sets of word shingles share at least ``similarity`` of
    all shingles of both; groups are connected by such pairs. Fingerprints only say which texts are
    compared: those that ``radius`` connects, directly or through others. Fingerprints are compared
    where sets share a shingle that similar sets have to share (``prefixes``), so the work does not
    grow with the square of the different texts. Two sets of which the
    cosine is c differ in about arccos(c) / pi of the bits. A similarity of 0.8 is a cosine of 0.89
    at least and 78 +- 8 of 512 bits at most, one of 0.6 is 118 +- 10; unrelated texts differ in
    half of them. Texts with equal sets are one from the start, so are texts without words. Of rows
    with the same doc_id and text one stays. All columns are kept.
    """
    late = late_shingles(docs, partial(shingle_hashes, shingle=shingle), text)
    prints = staged(set_prints(docs, shingle, words, similarity, late, text), "prints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = prints.groupBy("node", "fingerprint", "lead", "n").agg(F.min(order).alias("first"))
    nodes = staged(nodes, "nodes")
    edges = near_links(prints, nodes.select("node", "lead", "fingerprint"), radius, words, first_radius)
    near = connected_components(edges)
    placed = nodes.drop("fingerprint", "lead").join(near, "node", "left")
    placed = staged(placed.withColumn("near", F.coalesce("component", "node")), "placed")
    sizes = placed.groupBy("near").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("n"))
    sizes = sizes.where(F.col("members") > 1).select("near", blocks_of(F.col("n")).alias("blocks"))
    # Staged before the join, so that Spark may split a large group.
    wanted = placed.join(staged(sizes, "sizes"), "near").select("near", "blocks", "node", "first", "n")
    wanted = staged(wanted, "wanted")
    n = wanted.agg(F.sum("n").alias("n")).first()["n"] or 0
    edges = similar_pairs(_sets_of(docs, wanted, shingle, text), similarity, n)
    found = nodes.join(connected_components(edges), "node", "left")
    found = found.withColumn("component", F.coalesce("component", "node"))
    kept = found.groupBy("component").agg(F.min("first").alias("k")).select("k.doc_id", "k.text_hash")
    hashed = free_name(docs, "hash")
    rows = docs.withColumn(hashed, F.xxhash64(text))
    doc_id, of = free_name(rows, "kept_id"), free_name(rows, "kept_hash")
    kept = kept.select(F.col("doc_id").alias(doc_id), F.col("text_hash").alias(of))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id)) & (F.col(hashed) == F.col(of))
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", hashed]).drop(hashed)
