"""Spelling variants of words by a dictionary of pairs of trie nodes.

The words are the leaves of a trie; their reversals are those of another. Nodes are numbered, so a
prefix is one integer and a suffix is one. A word gives, for each of its places, the pair of the
prefix before and the suffix after it: once with the character at the place skipped, once with
nothing skipped, as if a character were inserted there. Two words differ

- by one replaced character if they share a pair with the same place skipped in both;
- by one inserted or deleted character if a pair that skips a place of one is a pair that skips
  nothing in the other.

A pair names the text around one place, so at most one word skips nothing there and at most as
many words skip it as there are characters: groups stay small whatever the data. A character that
may be any of a run of equal ones counts at the last of them, so neighbours are found once.

A trie is numbered from its words in order, a range of words at a time. A prefix that reaches
beyond its range is a prefix of the first word of the next range, so its number comes from the
first words alone; all others are counted within their range. Prefixes that one word alone has
cannot meet another word and get no number.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfgap.llm.common import staged

WORDS_AT_ONCE = 1 << 20  # different words that a counting task holds
WORDS_PER_RANGE = 1 << 17
INSERTED, SKIPPED, SKIPPED_LAST = 0, 1, 2  # kinds of pairs; LAST: the last of a run of equal characters

_LETTERS = bytes(c if 97 <= c <= 122 or c == 0xC3 or 0x80 <= c <= 0xBF else 32 for c in range(256))
_OTHERS = re.compile(rb"[\xc2\xc4-\xf4][\x80-\xbf]+")


def runs(text: bytes) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF in the UTF-8 text, with A-Z in lower case.

    U+00C0 to U+00FF are the code points whose first byte is C3, so all others are blanked first.
    """
    text = text.lower()
    if not text.isascii():
        text = _OTHERS.sub(b" ", text)
    return text.translate(_LETTERS).split()


def without(run: bytes, at: int) -> bytes:
    """The run without its code point ``at`` modulo their number."""
    points = run.decode()
    at %= len(points)
    return (points[:at] + points[at + 1 :]).encode()


def word_counts(
    docs: DataFrame, least_points: int = 5, least_count: int = 3, damaged: int = 97, text: str = "text"
) -> DataFrame:
    """``word`` and ``n``: how often each word of ``least_points`` code points or more occurs in all
    texts, if it does ``least_count`` times.

    Of each run in a document for which the crc32 of ``<doc_id>:<run>`` is divisible by ``damaged``,
    one code point is missing, which puts known variants into the table. A NULL doc_id counts as an
    empty one, a NULL text as empty.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = zlib.crc32(f"{doc_id}:".encode())
                for run, n in Counter(runs(value.as_py() or b"")).items():
                    if len(run) < least_points:
                        continue  # no more code points than bytes
                    h = zlib.crc32(run, start)
                    if not h % damaged:
                        run = without(run, h)
                    total[run] = total.get(run, 0) + n
                if len(total) > WORDS_AT_ONCE:
                    yield _counted(total, least_points)
                    total = {}
        yield _counted(total, least_points)

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.col(text).cast("binary").alias("text"),
    )
    found = rows.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _counted(total: dict[bytes, int], least_points: int) -> pa.RecordBatch:
    long = {w: n for w, n in total.items() if len(w) >= least_points}
    words = [w.decode() for w in long]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), pa.array(list(long.values()), pa.int64())], ["word", "n"]
    )
    return batch.filter(pa.array([len(w) >= least_points for w in words], pa.bool_()))


def common_prefix(a: str, b: str) -> int:
    """How many first characters both have in common."""
    end = min(len(a), len(b))
    if a[:end] == b[:end]:
        return end
    at = 0
    while end - at > 16:
        middle = (at + end) // 2
        if a[at:middle] == b[at:middle]:
            at = middle
        else:
            end = middle
    while a[at] == b[at]:
        at += 1
    return at


def _first_owners(firsts: list[str]) -> list[list[int]]:
    """For each range and depth the first range whose first word has the same prefix."""
    owners: list[list[int]] = []
    for k, word in enumerate(firsts):
        same = common_prefix(firsts[k - 1], word) if k else -1
        owners.append((owners[-1][: same + 1] if k else []) + [k] * (len(word) - same))
    return owners


def _shared(owners: list[int]) -> list[int]:
    """Numbers of the nodes on the path to a first word; below zero, so that no range has them."""
    return [-((owner << 32) + depth) - 1 for depth, owner in enumerate(owners)]


def paths_in_range(
    words: list[str], k: int, mine: list[int], following: str | None, theirs: list[int]
) -> list[list[int]]:
    """For each word of a sorted range the numbers of its nodes from the root down, as far as another
    word shares them.

    ``mine`` are the numbers on the path to the first word, ``following`` is the first word of the
    next range and ``theirs`` the numbers on its path.
    """
    out, path, count = [], list(mine), k << 32
    with_next = [common_prefix(a, b) for a, b in zip(words, words[1:])]
    with_next.append(0 if following is None else common_prefix(words[-1], following))
    for at, word in enumerate(words):
        before = with_next[at - 1] if at else len(word)
        depth = max(before, with_next[at])
        del path[before + 1 :]
        if depth > before:
            ahead = 0 if following is None else common_prefix(word, following)
            for d in range(before + 1, depth + 1):
                if d <= ahead:
                    path.append(theirs[d])
                else:
                    path.append(count)
                    count += 1
        out.append(path[: depth + 1])
    return out


def _in_order(words: DataFrame, ranges: int, name: str) -> DataFrame:
    """The rows dealt by ranges of ``word``, with ``place``: their order over all ranges, of which the
    bits from 33 on number the range."""
    ranged = words.repartitionByRange(ranges, "word").sortWithinPartitions("word")
    return staged(ranged.withColumn("place", F.monotonically_increasing_id()), name)


def trie_paths(words: DataFrame) -> DataFrame:
    """``id`` and ``path`` of every row of ``words`` (id, word, place), whose words differ and of which
    ``place`` is that of ``_in_order``.

    The first word of each range is fetched, one word per ``WORDS_PER_RANGE``; a range is numbered by
    one task.
    """
    ranged = words.withColumn("range", F.shiftright("place", 33))
    rows = ranged.groupBy("range").agg(F.min("word").alias("word")).orderBy("range").collect()
    firsts = [r["word"] for r in rows]
    owners = _first_owners(firsts)
    number = {r["range"]: k for k, r in enumerate(rows)}
    ends = {
        at: (k, _shared(owners[k]), *((firsts[k + 1], _shared(owners[k + 1])) if k + 1 < len(rows) else (None, [])))
        for at, k in number.items()
    }

    def walk(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        paths = paths_in_range(table["word"].to_pylist(), *ends[key[0].as_py()])
        return pa.table({"id": table["id"], "path": pa.array(paths, pa.list_(pa.int64()))})

    return ranged.groupBy("range").applyInArrow(walk, "id long, path array<long>")


def _pairs(words: DataFrame) -> DataFrame:
    """``p``, ``s``, ``id``, ``n`` and ``kind`` of the pairs of the rows (id, n, word, forward, backward)
    that another word may have."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1 << 14):
                batch = whole.slice(lo, 1 << 14)
                p, s, of, kind = [], [], [], []
                columns = [batch.column(c).to_pylist() for c in ("word", "forward", "backward")]
                for k, (word, forward, backward) in enumerate(zip(*columns)):
                    size = len(word)
                    for i in range(max(0, size - len(backward)), min(size, len(forward))):
                        last = i + 1 == size or word[i] != word[i + 1]
                        p.append(forward[i])
                        s.append(backward[size - 1 - i])
                        of.append(k)
                        kind.append(SKIPPED_LAST if last else SKIPPED)
                    for i in range(max(0, size + 1 - len(backward)), min(size + 1, len(forward))):
                        p.append(forward[i])
                        s.append(backward[size - i])
                        of.append(k)
                        kind.append(INSERTED)
                at = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(p, pa.int64()),
                        pa.array(s, pa.int64()),
                        batch.column("id").take(at),
                        batch.column("n").take(at),
                        pa.array(np.array(kind, np.int8)),
                    ],
                    ["p", "s", "id", "n", "kind"],
                )

    return words.mapInArrow(emit, "p long, s long, id long, n long, kind byte")


def _neighbours(pairs: DataFrame) -> DataFrame:
    """``id``, ``n_near`` and ``best``: number of near words, and the most frequent of them as a struct
    of its count below zero and its id."""
    member = F.struct((-F.col("n")).alias("m"), "id", "kind")
    groups = pairs.groupBy("p", "s").agg(F.sort_array(F.collect_list(member)).alias("g"))
    groups = groups.where(F.size("g") > 1).select(
        "g",
        F.filter("g", lambda x: x["kind"] != INSERTED).alias("skipped"),
        F.filter("g", lambda x: x["kind"] == SKIPPED_LAST).alias("last"),
        F.filter("g", lambda x: x["kind"] == INSERTED).alias("inserted"),
    )

    def found(x: Column) -> Column:
        is_inserted, is_last = x["kind"] == INSERTED, x["kind"] == SKIPPED_LAST
        first, second = F.get("skipped", F.lit(0)), F.get("skipped", F.lit(1))
        other = F.when(first["id"] == x["id"], second).otherwise(first)
        shorter = F.when(is_last, F.get("inserted", F.lit(0)))
        n = F.when(is_inserted, F.size("last")).otherwise(
            F.size("skipped") - 1 + F.when(is_last, F.size("inserted")).otherwise(0)
        )
        best = F.when(is_inserted, F.get("last", F.lit(0))).otherwise(F.array_min(F.array(other, shorter)))
        return F.struct(x["id"].alias("id"), n.alias("n"), best["m"].alias("m"), best["id"].alias("near"))

    each = groups.select(F.explode(F.transform("g", found)).alias("x")).where("x.n > 0")
    return each.groupBy("x.id").agg(
        F.sum("x.n").cast("long").alias("n_near"), F.min(F.struct("x.m", "x.near")).alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``id`` and ``root`` at the end of the chain that starts with ``id`` and leads by ``forms`` (id,
    root); chains do not close. Each round doubles how far a row looks ahead."""
    now = staged(forms, "forms")
    while True:
        above = now.select(F.col("id").alias("root"), F.col("root").alias("above"))
        now = staged(
            now.select("id", "root")
            .join(above, "root", "left")
            .select("id", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")),
            "roots",
        )
        if not now.where("moved").limit(1).count():
            return now.select("id", "root")


def variants(counts: DataFrame, factor: int = 2) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of ``counts`` (word, n), whose words differ.

    Near words differ by exactly one inserted, deleted or replaced code point; n_near is their number.
    The form is the near word of largest n, of these the smallest, if its n is ``factor`` times that of
    the word or more, and form_n its n; else both are NULL. The root is the last word that forms lead
    to, or the word itself. A factor above 1 keeps chains from closing. NULL words are left out. Words
    of any length are taken whole; an empty table gives an empty result.
    """
    known = staged(counts.where(F.col("word").isNotNull()).select("word", "n"), "words")
    ranges = max(1, -(-known.count() // WORDS_PER_RANGE))
    words = _in_order(known, ranges, "forward").withColumn("id", F.col("place"))
    backward = _in_order(words.select("id", F.reverse("word").alias("word")), ranges, "backward")
    joined = (
        words.select("id", "n", "word")
        .join(trie_paths(words).withColumnRenamed("path", "forward"), "id")
        .join(trie_paths(backward).withColumnRenamed("path", "backward"), "id")
    )
    near = words.join(_neighbours(_pairs(joined)), "id", "left")
    has_form = -F.col("best.m") >= factor * F.col("n")
    near = staged(
        near.select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("best.near")).alias("form_id"),
            F.when(has_form, -F.col("best.m")).alias("form_n"),
        ),
        "near",
    )
    roots = _roots(near.where("form_id is not null").select("id", F.col("form_id").alias("root")))
    named = roots.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
    formed = near.where("form_id is not null").select("id", F.col("form_id").alias("of"))
    formed = formed.join(words.select(F.col("id").alias("of"), F.col("word").alias("form")), "of")
    ends = formed.select("id", "form").join(named.select("id", "root_word"), "id")
    return near.join(ends, "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    docs: DataFrame,
    least_points: int = 5,
    least_count: int = 3,
    damaged: int = 97,
    factor: int = 2,
    text: str = "text",
) -> DataFrame:
    """``variants`` of the words of all texts (``word_counts``). Empty and NULL texts add no words,
    repeated rows count each time, long texts are read whole, other columns are ignored."""
    return variants(word_counts(docs, least_points, least_count, damaged, text), factor)
