"""Removal of repeated passages by sorted windows, grouped by minimizers.

The windows of ``min_words`` words of all texts (suffixes, cut there) are split into groups, and
each group is sorted; equal neighbours are the repeats. Deeper nodes of a suffix tree are not built:
a longer repeat is the union of its windows. Three things keep the groups small, though nothing
splits one by its size:

- A window's group is its 6 words of smallest hash, wherever they lie in it. Neighbouring windows
  mostly have theirs at the same place and travel as one piece of text.
- Windows whose 6 words occur once in all texts have no repeat and are dropped before any text is
  sent.
- Where those 6 words are very frequent, the group is the whole window, and a task sends one for
  all equal ones it has.

Exact copies of a text are told by a digest of the text and are not sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfgap.llm.common import text_bytes

MIN_WORDS = 20
GRAM = 6
ANCHORS_PER_BUCKET = 400_000
TEXT_PER_PARTITION = 12 << 20
WORDS_AT_ONCE = 300_000
SUFFIXES_AT_ONCE = 150_000
CACHED_WORDS = 400_000
HOT_SAMPLE, HOT_COUNT, MOST_HOT = 32, 24, 100_000  # about 1 in 32 documents; bound of the list
_NO_ID = -(1 << 63)
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
     0xFF51AFD7ED558CCD, 0x94D049BB133111EB],
    np.uint64,
)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def anchors_of(words: list[bytes], min_words: int, known: _WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all 6-word grams, and for every suffix of at least ``min_words`` words the place
    of the smallest gram (the first of equal ones) in its first ``min_words``."""
    n = len(words)
    if n < min_words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    grams = np.zeros(n - GRAM + 1, np.uint64)
    for k in range(GRAM):
        grams += hashes[k : k + len(grams)] * _FACTORS[k]
    grams = (grams ^ grams >> np.uint64(32)) * _FACTORS[0]
    grams ^= grams >> np.uint64(29)
    within = np.lib.stride_tricks.sliding_window_view(grams, min_words - GRAM + 1)
    return grams, within.argmin(1) + np.arange(len(within))


def _is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def subtree(suffixes: np.ndarray, ties: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes (rows of word numbers, cut at equal length) and the number of leading
    words that each shares with the one before; equal ones are ordered by ``ties``."""
    n, depth = suffixes.shape
    wide = suffixes.astype(np.uint64)
    bits = max(1, int(suffixes.max(initial=0)).bit_length())
    at_once = 64 // bits  # words in one sort key
    keys = []
    for lo in range(0, depth, at_once):
        key = np.zeros(n, np.uint64)
        for k in range(lo, min(lo + at_once, depth)):
            key = key << np.uint64(bits) | wide[:, k]
        keys.append(key)
    order = np.lexsort([*ties[::-1], *keys[::-1]])
    ranked = suffixes[order]
    shared = np.zeros(n, np.int64)
    if n:
        shared[1:] = np.cumprod(ranked[1:] == ranked[:-1], axis=1).sum(1)
    return order, shared


def _runs(doc: np.ndarray, key: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Neighbouring starts of one document as (doc, key, first start, number of starts)."""
    order = np.lexsort([start, key, doc])
    doc, key, start = doc[order], key[order], start[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(fresh)
    n = np.diff(np.append(first, len(doc)))
    return doc[first], key[first], start[first], n


def later_suffixes(
    bodies: list[bytes], doc: np.ndarray, key: np.ndarray, start: np.ndarray, min_words: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, key and start of every suffix of the pieces of text that is not the earliest leaf
    of its node of depth ``min_words``."""
    numbers: dict[bytes, int] = {}
    ids, offsets, lengths = [], [], []
    for body in bodies:
        words = body.split(b" ")
        offsets.append(len(ids))
        lengths.append(len(words) - min_words + 1)
        ids += [numbers.setdefault(w, len(numbers)) for w in words]
    flat = np.array(ids, np.int64)
    n = np.array(lengths)
    piece = np.repeat(np.arange(len(bodies)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = np.array(offsets)[piece] + inner
    suffixes = flat[at[:, None] + np.arange(min_words)]
    doc, key, start = doc[piece], key[piece], start[piece] + inner
    order, shared = subtree(suffixes, [doc, key, start])
    doc, key, start = doc[order], key[order], start[order]
    deep = shared >= min_words
    # The first leaf of each node; a leaf of no such node is its own first.
    first = np.maximum.accumulate(np.where(deep, 0, np.arange(len(order))))
    later = deep & ((doc != doc[first]) | (key != key[first]) | (start != start[first]))
    return doc[later], key[later], start[later]


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [t.as_py() or b"" for t in batch.column(column)]


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """doc (doc_id, NULL as the least), key (a hash of both), has_id and text of every row."""
    doc_id, value = F.col("doc_id").cast("long"), F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(doc_id, F.lit(_NO_ID)).alias("doc"),
        F.xxhash64(doc_id, value).alias("key"),
        doc_id.isNotNull().alias("has_id"),
        value.cast("binary").alias("text"),
    )


def _frequent_grams(rows: DataFrame, min_words: int) -> np.ndarray:
    """Anchors that are frequent in a sample of the documents, at most MOST_HOT. Which they are
    decides how suffixes are dealt, not what is found."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            for text in _texts(batch, "text"):
                found, at = anchors_of(text.split(), min_words, known)
                used = found[np.unique(at)].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(used)], ["gram"])
                if len(known) > CACHED_WORDS:
                    known.clear()

    sample = rows.where(F.pmod("key", F.lit(HOT_SAMPLE)) == 0).select("text")
    counts = sample.mapInArrow(grams, "gram long").groupBy("gram").count()
    hot = counts.where(F.col("count") >= HOT_COUNT).orderBy(F.desc("count"), "gram").limit(MOST_HOT)
    return np.sort(hot.select("gram").toArrow()["gram"].to_numpy().astype(np.int64).view(np.uint64))


def _repeated_anchors(rows: DataFrame, hot: np.ndarray, buckets: int, min_words: int) -> DataFrame:
    """key and place of every anchor whose gram occurs more than once in all texts; frequent ones
    are left out, as they are known."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        parts: list[tuple[np.ndarray, ...]] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            gram, key, place = (np.concatenate(x) for x in zip(*parts))
            bucket = ((gram >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            picks = [p for p in np.split(order, cuts) if len(p)]
            columns = [
                pa.array([bucket[p[0]] for p in picks], pa.int32()),
                *[pa.array([x[p].tobytes() for p in picks], pa.binary()) for x in (gram, key, place)],
            ]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "grams", "keys", "places"])

        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), _texts(batch, "text")):
                grams, at = anchors_of(text.split(), min_words, known)
                place = np.unique(at)
                place = place[~_is_in(grams[place], hot)]
                parts.append((grams[place], np.full(len(place), key, np.int64), place.astype(np.uint32)))
                n += len(at)
                if n >= WORDS_AT_ONCE:
                    yield from flush()
                    parts, n = [], 0
                if len(known) > CACHED_WORDS:
                    known.clear()
        if parts:
            yield from flush()

    def meet(table: pa.Table) -> pa.Table:
        gram, key, place = (
            np.concatenate([np.frombuffer(x.as_py(), kind) for x in table[name]])
            for name, kind in (("grams", np.uint64), ("keys", np.int64), ("places", np.uint32))
        )
        order = np.argsort(gram, kind="stable")
        same = gram[order][1:] == gram[order][:-1]
        again = order[np.append(same, False) | np.insert(same, 0, False)]
        return pa.table({"key": pa.array(key[again]), "place": pa.array(place[again].astype(np.int32))})

    sent = rows.select("key", "text").mapInArrow(
        send, "bucket int, grams binary, keys binary, places binary"
    )
    return sent.groupBy("bucket").applyInArrow(meet, "key long, place int")


def _later_copies(rows: DataFrame) -> DataFrame:
    """key and doc of the rows whose whole text an earlier row has."""
    texts = rows.select("doc", "key", F.md5("text").alias("digest"))
    firsts = texts.groupBy("digest").agg(
        F.min(F.struct("doc", "key")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    firsts = firsts.where(F.col("n") > 1).select("digest", "first")
    copies = texts.join(firsts, "digest").where(F.struct("doc", "key") != F.col("first"))
    return copies.select("key").distinct()


RUNS = "doc long, key long, start int, n int"


def _later_runs(dealt: DataFrame, marks: DataFrame, hot: np.ndarray, parts: int, min_words: int) -> DataFrame:
    """doc, key, start and n: runs of n suffixes, each of which starts earlier somewhere too."""
    columns = ["part", "doc", "key", "start", "n", "body"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        values = list(zip(*found)) or [()] * len(columns)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], columns)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of text whose suffixes may be repeated, with the group that they go to; runs
        that are known already have no text."""
        known = _WordHashes()
        out: list[tuple] = []
        first: dict[bytes, tuple] = {}
        later: list[tuple] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for body, (doc, key, start) in first.items():
                out.append((_body_hash(body), doc, key, start, 1, body))
            if later:
                doc, key, start = (np.array(x, np.int64) for x in zip(*later))
                for run in zip(*(x.tolist() for x in _runs(doc, key, start))):
                    out.append((run[1], *run, None))
            if out:
                yield batch_of(out)

        for batch in batches:
            rows = zip(
                batch.column("doc").to_pylist(),
                batch.column("key").to_pylist(),
                batch.column("copy").to_pylist(),
                batch.column("places"),
                _texts(batch, "text"),
            )
            for doc, key, copy, places, text in rows:
                words = text.split()
                n += len(words)
                if copy and len(words) >= min_words:
                    out.append((key, doc, key, 0, len(words) - min_words + 1, None))
                elif not copy:
                    grams, at = anchors_of(words, min_words, known)
                    used = np.unique(at)
                    frequent = used[_is_in(grams[used], hot)]
                    marked = np.zeros(len(grams), np.int8)
                    if places.is_valid:
                        chosen = places.values.to_numpy()
                        marked[chosen[chosen < len(grams)]] = 1
                    marked[frequent] = 2
                    kind = marked[at]
                    for s in np.flatnonzero(kind == 2).tolist():
                        body, here = b" ".join(words[s : s + min_words]), (doc, key, s)
                        seen = first.setdefault(body, here)
                        if seen > here:
                            first[body] = here
                            later.append(seen)
                        elif seen < here:
                            later.append(here)
                    cuts = np.flatnonzero(np.diff(at, prepend=-1)).tolist()
                    for lo, hi in zip(cuts, [*cuts[1:], len(at)]):
                        if kind[lo] == 1:
                            body = b" ".join(words[lo : hi - 1 + min_words])
                            out.append((int(grams[at[lo]].view(np.int64)), doc, key, lo, hi - lo, body))
                if n >= WORDS_AT_ONCE:
                    yield from flush()
                    out, first, later, n = [], {}, [], 0
                if len(known) > CACHED_WORDS:
                    known.clear()
        yield from flush()

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come ordered by group; whole groups are taken until there are enough suffixes."""
        waiting: list[pa.RecordBatch] = []
        n = 0

        def grow(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            bare = rows.filter(rows["body"].is_null())
            done = [bare[c].to_numpy().astype(np.int64) for c in ("doc", "key", "start", "n")]
            full = rows.filter(rows["body"].is_valid())
            if full.num_rows:
                place = [full[c].to_numpy().astype(np.int64) for c in ("doc", "key", "start")]
                found = _runs(*later_suffixes(full["body"].to_pylist(), *place, min_words))
                done = [np.concatenate(x) for x in zip(done, found)]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            arrays = [pa.array(x, pa.int64()).cast(t) for x, t in zip(done, kinds)]
            if len(done[0]):
                yield pa.RecordBatch.from_arrays(arrays, ["doc", "key", "start", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            n += int(np.sum(batch.column("n").to_numpy()))
            if n >= SUFFIXES_AT_ONCE:
                rows = pa.Table.from_batches(waiting)
                part = rows["part"].to_numpy()
                whole = int(np.searchsorted(part, part[-1]))
                yield from grow(rows.slice(0, whole))
                rest = rows.slice(whole).combine_chunks()
                waiting = rest.to_batches()
                n = int(np.sum(rest["n"].to_numpy()))
        if waiting:
            yield from grow(pa.Table.from_batches(waiting))

    # All columns are read, as the other join does, so that Spark finds the same shuffle in both.
    rows = dealt.join(marks, "key", "left").select("doc", "key", "has_id", "copy", "places", "text")
    sent = rows.mapInArrow(pieces, "part long, doc long, key long, start int, n int, body binary")
    return sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(trees, RUNS)


def _body_hash(body: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(body) - (1 << 63)


def drop_repeats(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (bytes, words joined by one space) and removed (spans
    of words, first and end) of every row of ``docs``.

    A window is ``min_words`` consecutive words. Each word goes that a window covers whose words
    also start earlier: in a document of smaller doc_id, NULL being smallest, or before in the same
    one. Windows are judged on the input. Rows that share a doc_id but not the text are ordered by
    a hash of the text; rows equal in both keep the same words. A NULL text has no words, and texts
    of fewer than ``min_words`` words stay as they are. Long texts are read whole. An empty table
    gives an empty result; other columns are ignored.
    """
    rows = _keyed(docs, text)
    size = text_bytes(docs, text)
    parts = max(1, -(-size // TEXT_PER_PARTITION))
    hot = _frequent_grams(rows, min_words)
    buckets = max(1, -(-size // (40 * ANCHORS_PER_BUCKET)))  # an anchor takes some 40 bytes of text
    places = _repeated_anchors(rows, hot, buckets, min_words)
    marks = places.select("key", "place", F.lit(False).alias("copy")).unionAll(
        _later_copies(rows).select("key", F.lit(None).cast("int"), F.lit(True))
    )
    marks = marks.groupBy("key").agg(F.collect_list("place").alias("places"), F.max("copy").alias("copy"))
    # Both joins are by key alone, so that they read this one shuffle of the texts; a key is a
    # hash, and the runs say which document they are of.
    dealt = rows.repartition(parts, "key")
    runs = _later_runs(dealt, marks, hot, 2 * parts, min_words)
    runs = runs.groupBy("key").agg(F.collect_list(F.struct("doc", "start", "n")).alias("runs"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("first", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            out: list[tuple] = []
            rows = zip(
                batch.column("doc").to_pylist(),
                batch.column("has_id").to_pylist(),
                batch.column("runs").to_pylist(),
                _texts(batch, "text"),
            )
            for doc, has_id, runs, text in rows:
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int64)
                runs = [run for run in runs or [] if run["doc"] == doc]
                for run in runs:
                    gone[run["start"]] += 1
                    gone[run["start"] + run["n"] + min_words - 1] -= 1
                covered = np.cumsum(gone)[:-1] > 0
                edges = np.flatnonzero(np.diff(covered, prepend=False, append=False)).reshape(-1, 2)
                kept = [words[k] for k in np.flatnonzero(~covered)] if runs else words
                spans = [{"first": a, "end": b} for a, b in edges.tolist()]
                out.append((doc if has_id else None, len(words), int(covered.sum()), b" ".join(kept), spans))
            values = list(zip(*out)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(span)]
            names = ["doc_id", "n_words", "n_removed", "kept_text", "removed"]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)

    kept = dealt.join(runs, "key", "left").select("doc", "key", "has_id", "runs", "text")
    return kept.mapInArrow(
        keep,
        "doc_id long, n_words long, n_removed long, kept_text binary, "
        "removed array<struct<first: int, end: int>>",
    )
