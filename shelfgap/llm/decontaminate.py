"""Benchmark decontamination by spaced seeds.

A seed is the hash of the tokens that a fixed mask keeps at one position; the ignored ones may
differ. Seeds of the test items meet seeds of the documents. Around each hit both texts are laid
side by side, and the longest stretch of good agreement decides, so substituted tokens do not hide
a passage.

Tokens are the letters and digits of words in lower case; words without any are skipped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfgap.llm.common import free_name

# Every stretch of 8 to 25 tokens with at most a fifth of them substituted has a hit of one of these;
# the last is for stretches of 10.
MASKS = ("11111", "110111", "111101", "10001111")
MIN_TOKENS = 8  # shorter items are no passages
MIN_MATCHES = 12  # fewer for items of fewer tokens: four fifths of them
MISMATCH = 4  # matches that make up for one mismatch: at least four fifths agree
SEEDS_PER_BLOCK = 2_000_000
CACHED_WORDS = 400_000

_BARE = re.compile(r"[\W_]+")
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
     0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9],
    np.uint64,
)


class _Tokens(dict):
    """64-bit tokens of words; 0 for a word without letters and digits."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        bare = _BARE.sub("", word.decode("utf-8", "replace")).lower()
        token = xxhash.xxh64_intdigest(bare.encode("utf-8", "surrogatepass")) or 1 if bare else 0
        self[word] = token
        return token


def tokens_of(text: bytes, known: _Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a text and the numbers of their words."""
    words = text.split()
    tokens = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    at = np.flatnonzero(tokens)
    return tokens[at], at


def seeds_of(tokens: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """The mask's seed at every position where it fits."""
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, salt + 1, np.uint64)
    for k, at in enumerate(i for i, kept in enumerate(mask) if kept == "1"):
        out += tokens[at : at + n] * _FACTORS[k]
    return (out ^ out >> np.uint64(31)) * _FACTORS[7]


@dataclass(frozen=True)
class SeedIndex:
    """Sorted seeds of test items with item row and position, and the items' tokens; ``near`` has
    a bit for the upper digits of every seed."""

    seeds: np.ndarray
    items: np.ndarray
    places: np.ndarray
    near: np.ndarray
    tokens: list[np.ndarray]
    item_ids: list[int | None]

    NEAR_BITS = 22

    @classmethod
    def of(cls, items: list[tuple[int | None, np.ndarray]]) -> SeedIndex:
        seeds, owners, places = [], [], []
        for row, (_, tokens) in enumerate(items):
            for salt, mask in enumerate(MASKS):
                found = seeds_of(tokens, mask, salt)
                seeds.append(found)
                owners.append(np.full(len(found), row))
                places.append(np.arange(len(found)))
        none = [np.zeros(0, np.uint64)]
        seed = np.concatenate(seeds or none)
        owner = np.concatenate(owners or none).astype(np.int64)
        place = np.concatenate(places or none).astype(np.int64)
        order = np.argsort(seed, kind="stable")
        near = np.zeros(1 << cls.NEAR_BITS, bool)
        near[(seed >> np.uint64(64 - cls.NEAR_BITS)).astype(np.int64)] = True
        return cls(
            seed[order], owner[order], place[order], near, [t for _, t in items], [i for i, _ in items]
        )

    def diagonals(self, tokens: np.ndarray) -> set[tuple[int, int]]:
        """(item row, shift) of all hits, where item position p meets token p + shift."""
        out: set[tuple[int, int]] = set()
        for salt, mask in enumerate(MASKS):
            found = seeds_of(tokens, mask, salt)
            at = np.flatnonzero(self.near[(found >> np.uint64(64 - self.NEAR_BITS)).astype(np.int64)])
            lo = np.searchsorted(self.seeds, found[at], "left")
            hi = np.searchsorted(self.seeds, found[at], "right")
            for k in np.flatnonzero(hi > lo):
                hits = slice(lo[k], hi[k])
                shift = at[k] - self.places[hits]
                out.update(zip(self.items[hits].tolist(), shift.tolist()))
        return out


def best_stretch(item: np.ndarray, tokens: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Matches, first and end token (of ``tokens``) of the aligned stretch with the most matches
    among those in which at least four fifths agree; the first of equal ones."""
    first, end = max(0, shift), min(len(tokens), shift + len(item))
    equal = tokens[first:end] == item[first - shift : end - shift]
    matches = np.concatenate([[0], np.cumsum(equal)])
    sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, -MISMATCH))])
    # From the earliest place whose sum is no greater to each end.
    low = np.minimum.accumulate(sums)
    starts = np.searchsorted(-low, -sums, "left")
    stop = int((matches - matches[starts]).argmax())
    start = int(starts[stop])
    while start < stop and not equal[start]:
        start += 1
    while start < stop and not equal[stop - 1]:
        stop -= 1
    return int(matches[stop] - matches[start]), first + start, first + stop


def overlaps_of(tokens: np.ndarray, index: SeedIndex) -> list[tuple[int, int, int, int]]:
    """(item row, matches, first token, end token) of the best overlap with every item that the
    text holds enough of; of equal ones the first."""
    best: dict[int, tuple[int, int, int]] = {}
    for row, shift in sorted(index.diagonals(tokens)):
        item = index.tokens[row]
        found = best_stretch(item, tokens, shift)
        if found[0] >= min(MIN_MATCHES, -(-4 * len(item) // 5)) and found[0] > best.get(row, (0,))[0]:
            best[row] = found
    return [(row, *found) for row, found in sorted(best.items())]


def _test_items(test: DataFrame, text: str) -> DataFrame:
    """item_id, tokens and the number of seeds of every item of at least MIN_TOKENS tokens."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Tokens()
        for batch in batches:
            found = [tokens_of(t.as_py() or b"", known)[0] for t in batch.column(1)]
            known.clear()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([t.astype("<u8").tobytes() for t in found], pa.binary()),
                    pa.array([len(t) for t in found], pa.int64()),
                ],
                ["item_id", "tokens", "n"],
            )

    rows = test.select(F.col("item_id").cast("long"), F.col(text).cast("binary").alias("text"))
    rows = rows.mapInArrow(tokenize, "item_id long, tokens binary, n long")
    return rows.where(F.col("n") >= MIN_TOKENS)


OVERLAPS = "doc_id long, item_id long, n_matched long, first_word long, end_word long"


def overlaps(
    docs: DataFrame,
    test: DataFrame,
    text: str = "text",
    test_text: str = "text",
    seeds_per_block: int = SEEDS_PER_BLOCK,
) -> DataFrame:
    """Passages of test items in documents: doc_id, item_id, n_matched (tokens), first_word and
    end_word, the best overlap of each row of ``docs`` with each row of ``test``.

    An overlap is an aligned stretch in which at least four fifths of the tokens agree, with at
    least MIN_MATCHES equal ones (four fifths of the item, if that is less). The test items are
    sent to the documents in blocks of at most ``seeds_per_block`` seeds (one item more at most),
    so what is broadcast has a bound, and the documents are read once per block and never
    shuffled.

    NULL and empty texts, and items of fewer than MIN_TOKENS tokens, overlap with nothing.
    Repeated documents and repeated items give their rows each. NULL ids stay NULL. Long texts are
    read whole. Empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    items = _test_items(test, test_text)
    n_seeds = (items.agg(F.sum("n").alias("n")).first()["n"] or 0) * len(MASKS)
    blocks = max(1, -(-n_seeds // seeds_per_block))
    items = items.withColumn("block", F.pmod(F.xxhash64("tokens"), F.lit(blocks)))
    rows = docs.select(F.col("doc_id").cast("long"), F.col(text).cast("binary").alias("text"))

    def against(block: int) -> DataFrame:
        chosen = items.where(F.col("block") == block).orderBy("item_id", "tokens").toArrow()
        pairs = zip(chosen["item_id"].to_pylist(), chosen["tokens"].to_pylist())
        index = SeedIndex.of([(i, np.frombuffer(t, "<u8")) for i, t in pairs])
        sent = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = _Tokens()
            for batch in batches:
                out: list[tuple] = []
                for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                    tokens, words = tokens_of(value.as_py() or b"", known)
                    for row, n, first, end in overlaps_of(tokens, sent.value):
                        item_id = sent.value.item_ids[row]
                        out.append((doc_id, item_id, n, int(words[first]), int(words[end - 1]) + 1))
                    if len(known) > CACHED_WORDS:
                        known.clear()
                columns = list(zip(*out)) or [()] * 5
                names = ["doc_id", "item_id", "n_matched", "first_word", "end_word"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        return rows.mapInArrow(search, OVERLAPS)

    found = against(0)
    for block in range(1, blocks):
        found = found.unionAll(against(block))
    return found


def clean_documents(docs: DataFrame, test: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose doc_id has no overlap with a test item. Rows that share a doc_id
    go or stay together; rows without a doc_id go if any of them overlaps."""
    bad = free_name(docs, "bad")
    found = overlaps(docs, test, text).select(F.col("doc_id").alias(bad)).distinct()
    return docs.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col(bad)), "left_anti")
