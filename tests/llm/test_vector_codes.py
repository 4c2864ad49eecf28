import hashlib
import math

import numpy as np
import pytest

from shelfgap.llm import vector_codes as vc
from shelfgap.llm.oracles import ORACLES
from shelfgap.llm.queries import QUERIES
from tests.compare import open_tables, spark_rows, sql_rows

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """Plain integers, entry by entry."""
    kept = []
    for i, v, label in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(4096 * float(np.float32(x))) for x in v], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == width]
    each = width // parts
    cut = [[r[1][p * each : (p + 1) * each] for p in range(parts)] for r in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            found = {}
            for c in cut:
                found.setdefault(nearest(p, c[p])[1], []).append(c[p])
            for k, members in found.items():
                books[p][k] = [sum(x) // len(members) for x in zip(*members)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], {}
    for (i, _, label), c in zip(kept, cut):
        found = [nearest(p, c[p]) for p in range(parts)]
        out.append([i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label, digest])
        by_label[label] = by_label.get(label, 0) + out[-1][2]
    return sorted([(i, c, e, by_label[label], d) for i, c, e, label, d in out], key=str)


def got(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


def table(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in ("code", "error", "part", "n", "of", "position")])


def made(n, width, rng, copies=0):
    v = rng.normal(0, 0.2, (n, width)).astype(np.float32)
    v[: n // 3] = np.round(v[: n // 3] * 4) / 4  # shared prefixes and ties
    v[n - copies :] = v[0]
    return [(int(i), [float(x) for x in row], int(i) % 5 if i % 7 else None) for i, row in enumerate(v)]


@pytest.mark.parametrize("n, width, copies", [(300, 16, 100), (9, 8, 0), (60, 64, 5)])
def test_equals_brute_force(spark, monkeypatch, n, width, copies):
    monkeypatch.setattr(vc, "LEAVES_AT_ONCE", 13)
    monkeypatch.setattr(vc, "VECTORS_AT_ONCE", 40)
    monkeypatch.setattr(vc, "PARTS_PER_RANGE", 50)
    rows = made(n, width, np.random.default_rng(n), copies)
    assert got(vc.vector_codes(table(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = made(40, 16, np.random.default_rng(1))
    v = rows[0][1]
    rows += [
        (-3, None, 1),
        (-2, [], 1),
        (-1, [None] + v[1:], 1),
        (50, [float("nan")] + v[1:], 1),
        (51, [float("-inf")] + v[1:], 1),
        (52, v[:8], 1),
        (None, v, None),
        (None, v, 3),
        rows[3],
        rows[3],
        (53, [-0.0, 1.0, -1.0, -1e-9, 1e-9, 0.5, -0.5, 2.0] * 2, 2),
    ]
    assert got(vc.vector_codes(table(spark, rows))) == brute(rows)
    wide = vc.vector_codes(table(spark, [*rows, (99, [1e6] + v[1:], 1)]))
    assert got(wide) == brute(rows)  # a squared distance that no long holds


def test_empty_table(spark):
    assert got(vc.vector_codes(table(spark, []))) == []
    assert got(vc.vector_codes(table(spark, [(1, None, 2)]))) == []
    with pytest.raises(ValueError, match="equal parts"):
        vc.vector_codes(table(spark, [(1, [0.5] * 9, 2)]))


def test_one_pass_of_a_trie_takes_the_lower_of_equal_entries():
    rng = np.random.default_rng(0)
    leaves, number = vc.distinct_parts(rng.integers(-3, 3, (500, 4)))
    assert (np.unique(leaves, axis=0) == leaves).all() and number.max() == len(leaves) - 1
    book = rng.integers(-3, 3, (16, 4))
    book[7] = book[2]
    d = ((leaves[:, None] - book[None]) ** 2).sum(2)
    entry, distance = vc.nearest_entries(leaves, book)
    assert (entry == d.argmin(1)).all() and (distance == d.min(1)).all()


def test_sums_beyond_a_long():
    leaves = np.array([[1 << 26, -(1 << 26)]])
    counts, sums = vc.entry_sums(leaves, np.array([1 << 40]), np.array([1]), 3)
    assert counts.tolist() == [0, 1 << 40, 0] and sums[1].tolist() == [1 << 66, -(1 << 66)]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    types, rows = spark_rows(QUERIES["op12_vector_codes"](spark, sf_dir))
    want_types, want = sql_rows(open_tables(sf_dir), ORACLES["op12_vector_codes"])
    assert types == want_types and rows == want and len(rows) == 500
