"""Codes of vectors by codebooks of their parts, with distances taken along a trie.

Vectors become integers and are cut into parts. The distinct parts at one position, in order, are
the leaves of a trie whose levels are the dimensions: parts that begin alike share a path. A node
holds the squared distances of its prefix to all entries of the codebook, which are those of its
parent plus one dimension, so what several parts have in common is added up once. Leaves take the
nearest entry and add their components, times how often the part occurs, to its sums.

Leaves are visited depth first, in blocks of a bounded number; within a block each level is one
numpy operation over its nodes. The distinct parts are dealt by ranges, so that tasks hold
neighbouring subtrees; what leaves a task is one sum per position and entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfgap.llm.common import free_name, staged

LEAVES_AT_ONCE = 1 << 14
VECTORS_AT_ONCE = 1 << 16  # whose parts a task counts before it sends them on
PARTS_PER_RANGE = 1 << 18
LARGEST = 1 << 26  # components in size, so that squared distances fit into a long
_SUM = pa.decimal128(38, 0)


def distinct_parts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows in lexicographic order, and for each row the number of its equal."""
    if not len(rows) or not rows.shape[1]:
        return rows[:1], np.zeros(len(rows), np.int64)
    order = np.lexsort(rows.T[::-1])
    ordered = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(1)
    number = np.empty(len(rows), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], number


def nearest_entries(leaves: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the lower of equal ones, and its squared distance, for every row
    of ``leaves``: integers in lexicographic order."""
    n, width = leaves.shape
    entry, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for lo in range(0, n, LEAVES_AT_ONCE):
        block = leaves[lo : lo + LEAVES_AT_ONCE]
        # A row opens nodes below the first dimension in which it differs from the row before.
        opens = np.zeros(len(block), bool)
        opens[0] = True
        node = np.zeros(len(block), np.int64)
        sums = np.zeros((1, len(codebook)), np.int64)
        for d in range(width):
            opens[1:] |= block[1:, d] != block[:-1, d]
            first = np.flatnonzero(opens)
            sums = sums[node[first]] + (block[first, d][:, None] - codebook[:, d][None, :]) ** 2
            node = np.cumsum(opens) - 1
        best = sums.argmin(1)
        entry[lo : lo + len(block)] = best[node]
        distance[lo : lo + len(block)] = sums[np.arange(len(best)), best][node]
    return entry, distance


def entry_sums(leaves: np.ndarray, times: np.ndarray, entry: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Per entry how many parts it has and their componentwise sums, as whole numbers of any size."""
    weight = times.astype(object) if times.max(initial=0) * max(1, len(times)) > 1 << 36 else times
    counts = np.zeros(entries, object)
    sums = np.zeros((entries, leaves.shape[1]), object)
    order = np.argsort(entry, kind="stable")
    found, at = np.unique(entry[order], return_index=True)
    if len(found):
        counts[found] = np.add.reduceat(weight[order], at).astype(object)
        sums[found] = np.add.reduceat(leaves[order] * weight[order][:, None], at, axis=0).astype(object)
    return counts, sums


def _scaled(column: pa.Array, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the vectors that are kept, and floor(``scale`` x component) of these."""
    size = np.array(column.value_lengths().fill_null(-1), np.int64)
    rows = np.flatnonzero(size == width)
    flat = column.take(pa.array(rows)).flatten()
    gaps = np.zeros(len(flat), bool) if not flat.null_count else np.array(flat.is_null())
    values = np.asarray(flat.fill_null(0.0), np.float64).reshape(len(rows), width)
    with np.errstate(over="ignore", invalid="ignore"):
        good = (np.abs(values * scale) < LARGEST).all(1) & ~gaps.reshape(len(rows), width).any(1)
        whole = np.floor(values[good] * scale)
    return rows[good], whole.astype(np.int64)


def _counted_parts(vectors: DataFrame, width: int, parts: int, scale: int) -> DataFrame:
    """``position``, ``part`` and ``n`` of the different parts, in order, staged in ranges."""
    each = width // parts

    def count(blocks: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(blocks)
        for k in range(parts):
            found, number = distinct_parts(rows[:, k * each : (k + 1) * each])
            n = np.bincount(number, minlength=len(found))
            offsets = np.arange(len(found) + 1) * each
            values = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found.astype(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), k, np.int32)), values, pa.array(n, pa.int64())], ["position", "part", "n"]
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, held = [], 0
        for batch in batches:
            rows = _scaled(batch.column(0), width, scale)[1]
            if len(rows):
                blocks.append(rows)
                held += len(rows)
            if held >= VECTORS_AT_ONCE:
                yield from count(blocks)
                blocks, held = [], 0
        if held:
            yield from count(blocks)

    # Staged, so that the ranges are drawn from counted parts.
    counted = staged(vectors.mapInArrow(cut, "position int, part array<int>, n long"), "parts")
    ranges = max(1, -(-counted.count() // PARTS_PER_RANGE))
    ranged = counted.repartitionByRange(ranges, "position", "part")
    summed = ranged.groupBy("position", "part").agg(F.sum("n").alias("n"))
    return staged(summed.sortWithinPartitions("position", "part"), "leaves")


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, width)


def trained(leaves: DataFrame, codebooks: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks after ``rounds`` assignments of all parts, each followed by the means of the
    entries' parts, rounded down. Entries without parts stay.

    ``leaves`` has position, part and n; a round is one pass, of which the driver gets one sum per
    position and entry.
    """
    parts, entries, width = codebooks.shape
    names = [f"s{j}" for j in range(width)]
    for _ in range(rounds):
        now = codebooks

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros((parts, entries), object)
            sums = np.zeros((parts, entries, width), object)
            for batch in batches:
                position = np.asarray(batch.column(0))
                rows, times = _lists(batch.column(1), width), np.asarray(batch.column(2), np.int64)
                for k in np.unique(position).tolist():
                    mine = np.flatnonzero(position == k)
                    found, number = distinct_parts(rows[mine])  # in order already, if not read in pieces
                    n = np.zeros(len(found), np.int64)
                    np.add.at(n, number, times[mine])
                    entry, _ = nearest_entries(found, now[k])
                    c, s = entry_sums(found, n, entry, entries)
                    counts[k] += c
                    sums[k] += s
            k, e = np.nonzero(counts)
            columns = [pa.array(k, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[k, e].tolist(), _SUM)]
            columns += [pa.array(sums[k, e, j].tolist(), _SUM) for j in range(width)]
            yield pa.RecordBatch.from_arrays(columns, ["position", "entry", "n", *names])

        schema = "position int, entry int, n decimal(38,0)" + "".join(f", {c} decimal(38,0)" for c in names)
        found = leaves.mapInArrow(add, schema).groupBy("position", "entry")
        codebooks = now.copy()
        for row in found.agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).collect():
            codebooks[row["position"], row["entry"]] = [int(row[c]) // int(row["n"]) for c in names]
    return codebooks


def codebooks_digest(codebooks: np.ndarray) -> str:
    """sha256 of all components as decimal numbers, by part, entry and place, with commas between."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def encoded(
    vectors: DataFrame, codebooks: np.ndarray, scale: int, vec_id: str, vector: str, label: str
) -> DataFrame:
    """vec_id, label, code and error of every vector that is kept."""
    parts, _, each = codebooks.shape

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, rows = _scaled(batch.column(2), parts * each, scale)
            codes, error = np.zeros((len(kept), parts), np.int64), np.zeros(len(kept), np.int64)
            for k in range(parts):
                found, number = distinct_parts(rows[:, k * each : (k + 1) * each])
                entry, distance = nearest_entries(found, codebooks[k])
                codes[:, k] = entry[number]
                error += distance[number]
            at = pa.array(kept)
            code = pa.array([c.tobytes().hex() for c in codes.astype(np.uint8)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), code, pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    fields = [T.StructField("vec_id", vectors.schema[vec_id].dataType)]
    fields += [T.StructField("label", vectors.schema[label].dataType)]
    fields += [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    return vectors.select(vec_id, label, vector).mapInArrow(encode, T.StructType(fields))


def vector_codes(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that is kept.

    Components become floor(``scale`` x component). Codebooks start as the parts of the vectors of the
    ``entries`` (256 at most) smallest vec_ids, NULL last and ties by the vector, and are trained for
    ``rounds`` rounds; code has two hexadecimal digits per part, error is the squared distance to the
    chosen entries, label_error its sum over equal labels, NULLs together.

    Vectors are dropped if they are NULL, empty, hold NULL or non-finite components or such beyond
    ``LARGEST`` when scaled, or are not as long as the kept one of the smallest vec_id, whose length
    has to be divisible by ``parts``. Of fewer vectors than entries each is an entry; repeated rows
    stay and count each time. An empty table gives an empty result; other columns are ignored.
    """
    of = F.col(vector)
    finite = F.forall(of, lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < LARGEST))
    whole = F.transform(of, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    usable = vectors.where(of.isNotNull() & (F.size(of) > 0) & finite)
    order = [F.col(vec_id).asc_nulls_last(), F.col("whole")]
    least = usable.select(vec_id, whole.alias("whole")).orderBy(*order)
    head = least.limit(1).collect()
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if not head:
        return vectors.sparkSession.createDataFrame([], schema)
    width = len(head[0]["whole"])
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    first = least.where(F.size("whole") == width).limit(entries).collect()
    start = np.array([r["whole"] for r in first], np.int64)
    codebooks = start.reshape(len(start), parts, width // parts).transpose(1, 0, 2).copy()

    leaves = _counted_parts(vectors.select(vector), width, parts, scale)
    codebooks = trained(leaves, codebooks, rounds)
    coded = staged(encoded(vectors, codebooks, scale, vec_id, vector, label), "codes")
    # Staged, so that Spark may split a hot label.
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = staged(totals, "totals").withColumnRenamed("label", free_name(coded, "of"))
    same = coded["label"].eqNullSafe(totals[free_name(coded, "of")])
    return coded.join(totals, same).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256")
    )
