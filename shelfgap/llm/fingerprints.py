"""SimHash fingerprints of whole texts, and search within a Hamming radius by block tables.

DataFrame functions only. The hashes of a text's terms vote on 64 bits: a term counts as often as
it occurs, and a bit is 1 if more than half of the votes have it. Two of the 64 counters share one
long sum, so a document is 33 sums whatever its length.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfgap.llm.common import staged

BITS = 64
SHINGLE = 5
_SPACE = r"[\x20\x09-\x0D]+"
_TWO_LANES = (1 << 32) + 1  # the lowest bit of both halves of a long
ROWS_PER_BUCKET = 512
MOST_BUCKETS = 8192


def words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(bare != "", F.split(bare, _SPACE)).otherwise(F.array().cast("array<string>"))


def term_hashes(words: Column, shingle: int = SHINGLE) -> Column:
    """Hashes of the word shingles; fewer words have one, no words none. ``words`` has to be a
    column of the input: an expression would be run again for every shingle."""
    last = F.greatest(F.size(words) - shingle + 1, F.least(F.size(words), F.lit(1)))
    firsts = F.sequence(F.lit(1), last, F.lit(1))
    hashes = F.transform(firsts, lambda i: F.xxhash64(F.slice(words, i, shingle)))
    return F.when(F.size(words) > 0, hashes).otherwise(F.array().cast("array<bigint>"))


def _lanes(h: Column) -> list[Column]:
    return [
        F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_TWO_LANES))).alias(f"_lane{i}")
        for i in range(BITS // 2)
    ]


def _majority(votes: Column) -> Column:
    """The bits that more than half of the votes have; 0 without votes."""
    half = BITS // 2
    bits = []
    for i in range(BITS):
        lane = F.col(f"_lane{i % half}")
        ones = lane.bitwiseAND(F.lit((1 << 32) - 1)) if i < half else F.shiftrightunsigned(lane, half)
        bit = 1 << i if i < BITS - 1 else -(1 << i)
        bits.append(F.when(ones * 2 > votes, F.lit(bit).cast("long")).otherwise(F.lit(0).cast("long")))
    out = bits[0]
    for bit in bits[1:]:
        out = out.bitwiseOR(bit)
    return F.coalesce(out, F.lit(0).cast("long"))


def simhash(rows: DataFrame, key: list[str], hashes: str) -> DataFrame:
    """``key`` and ``fingerprint`` (a long) of every row; ``key`` tells rows apart and ``hashes``
    names a column of term hashes. A row without terms has fingerprint 0."""
    votes = rows.select(*key, F.explode_outer(hashes).alias("_h"))
    sums = votes.groupBy(*key).agg(F.count("_h").alias("_votes"), *_lanes(F.col("_h")))
    return sums.select(*key, _majority(F.col("_votes")).alias("fingerprint"))


def hex_digits(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), BITS // 4, "0")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / BITS


def _block_masks(radius: int, key_blocks: int) -> list[int]:
    """Masks of all choices of ``key_blocks`` among radius + key_blocks blocks of bits."""
    blocks = radius + key_blocks
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    block = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    return [sum(block[k] for k in chosen) for chosen in combinations(range(blocks), key_blocks)]


def within_radius(
    queries: DataFrame, fingerprints: DataFrame, radius: int, key_blocks: int = 3
) -> DataFrame:
    """All pairs (query, fingerprint) at most ``radius`` bits apart, once each; both tables have a
    column ``fingerprint`` of distinct longs.

    Two fingerprints that differ in at most ``radius`` of radius + key_blocks blocks agree in at
    least ``key_blocks`` of them. There is a table for each choice of that many blocks, whose key
    is the fingerprint with only those blocks left; equal keys meet and are compared in full.
    """
    masks = [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in _block_masks(radius, key_blocks)]
    tables = F.array(
        *[F.struct(F.lit(k).alias("t"), F.lit(m).cast("long").alias("m")) for k, m in enumerate(masks)]
    )

    def keyed(df: DataFrame, name: str) -> DataFrame:
        df = df.select(F.col("fingerprint").alias(name), F.explode(tables).alias("_t"))
        return df.select(name, F.col("_t.t").alias("t"), F.col(name).bitwiseAND(F.col("_t.m")).alias("k"))

    pairs = keyed(queries, "query").join(keyed(fingerprints, "fingerprint"), ["t", "k"])
    near = F.bit_count(F.col("query").bitwiseXOR(F.col("fingerprint"))) <= radius
    return pairs.where(near).select("query", "fingerprint").distinct()


def _bucketed(docs: DataFrame) -> DataFrame:
    """Adds ``bucket``, by ranges of doc_id about equally full; NULL is below all ids."""
    rows = docs.count()
    buckets = min(MOST_BUCKETS, max(1, rows // ROWS_PER_BUCKET))
    shares = [k / buckets for k in range(1, buckets)]
    bounds: list[int] = []
    if shares:
        found = docs.agg(F.percentile_approx("doc_id", shares, 10 * buckets).alias("b")).first()["b"]
        bounds = sorted(set(found or []))
    if not bounds:
        return docs.withColumn("bucket", F.lit(0))
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    edge = F.array(*[F.lit(b).cast("long") for b in bounds])
    place = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(bounds)) & (F.try_element_at(edge, at + step) <= F.col("doc_id")), at + step
        ).otherwise(at),
    )
    return docs.withColumn("bucket", place)


def _next_heads(heads: DataFrame) -> DataFrame:
    """``of`` and the other columns of the bucket that follows it; the highest follows the lowest.

    One row per bucket, of which there are a bounded number.
    """
    buckets = sorted((r["bucket"] for r in heads.select("bucket").collect()), reverse=True)
    pairs = list(zip(buckets, buckets[1:] + buckets[:1]))
    after = heads.sparkSession.createDataFrame(pairs, "of int, bucket int")
    return after.join(heads, "bucket").drop("bucket")


def edited_fingerprints(docs: DataFrame, radius: int = 3, every: int = 50, text: str = "text") -> DataFrame:
    """Per row of ``docs`` the fingerprints of its text and of its edited text, and their likeness.

    The edited text ends in the beginning of the next document by descending doc_id instead of its
    own last half; after the last comes the first. Columns: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, near_docs. The last one counts the
    other rows whose fingerprint is within ``radius``, for rows whose doc_id is divisible by
    ``every``, and is NULL for others.

    A NULL text counts as empty, and an empty text has fingerprint 0. Equal doc_ids are ordered by
    text, NULL doc_ids come last; repeated rows are neighbours and each has its row. A single
    document is its own next one; an empty table gives an empty result. Other columns are ignored.

    Documents are dealt by ranges of doc_id, so neighbours meet without a global order, and the
    text is shuffled once: terms are counted where the text lies.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    rows = _bucketed(docs)
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    rank = F.row_number().over(order)

    tops = rows.groupBy("bucket").agg(F.max("doc_id").alias("top"))
    tops = F.broadcast(tops.withColumnRenamed("bucket", "b"))  # one row per bucket
    at_top = (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("top"))
    heads = staged(rows.join(tops, at_top).groupBy("bucket").agg(F.max("text").alias("head")), "heads")

    rows = rows.withColumn("row", rank).withColumn("following", F.lead("text").over(order))
    after = _next_heads(heads)
    rows = rows.join(after, F.col("bucket") == F.col("of"), "left")
    following = F.coalesce("following", "head")
    n_chars = F.char_length("text")
    half = F.floor(n_chars / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n_chars - half), F.substring(following, F.lit(1), half)
    )
    rows = rows.select("bucket", "row", "doc_id", "text", edited.alias("edited"))
    both = F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("_text")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("_text")),
    )
    terms = rows.select("bucket", "row", "doc_id", F.explode(both).alias("v"))
    terms = terms.select("bucket", "row", "doc_id", "v.which", "v._text")
    keys = ["bucket", "row", "doc_id", "which", "n_chars", "sha"]
    terms = terms.select(
        "bucket",
        "row",
        "doc_id",
        "which",
        F.when(F.col("which") == 0, F.char_length("_text")).cast("long").alias("n_chars"),
        F.when(F.col("which") == 1, F.sha2("_text", 256)).alias("sha"),
        words(F.col("_text")).alias("words"),
    ).select(*keys, term_hashes(F.col("words")).alias("hashes"))
    found = simhash(terms, keys, "hashes")
    # Both of a document are in one task already, as they were dealt by bucket.
    of = lambda k, c: F.max(F.when(F.col("which") == k, F.col(c)))
    found = found.groupBy("bucket", "row", "doc_id").agg(
        of(0, "n_chars").alias("n_chars"),
        of(1, "sha").alias("edited_sha256"),
        of(0, "fingerprint").alias("fingerprint"),
        of(1, "fingerprint").alias("edited"),
    )
    found = staged(found, "fingerprints")

    heads = found.where(F.col("row") == 1).select("bucket", F.col("fingerprint").alias("head"))
    in_bucket = Window.partitionBy("bucket").orderBy("row")
    found = found.withColumn("following", F.lead("fingerprint").over(in_bucket))
    found = found.join(F.broadcast(_next_heads(heads)), F.col("bucket") == F.col("of"), "left")
    found = found.withColumn("following", F.coalesce("following", "head"))

    counts = found.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("copies"))
    asked = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    queries = found.where(asked).select("fingerprint").distinct()
    pairs = within_radius(queries, counts.select("fingerprint"), radius)
    near = pairs.join(counts, "fingerprint").groupBy(F.col("query").alias("q"))
    near = near.agg((F.sum("copies") - 1).alias("others"))
    found = found.join(near, F.col("fingerprint") == F.col("q"), "left")
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex_digits(F.col("fingerprint")).alias("fingerprint"),
        hex_digits(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("following")).alias("near_next"),
        F.when(asked, F.col("others")).alias("near_docs"),
    )
