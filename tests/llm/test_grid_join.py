import math

import numpy as np
import pytest

from shelfgap.llm import grid_join as gj
from shelfgap.llm.oracles import ORACLES
from shelfgap.llm.queries import QUERIES
from tests.compare import open_tables, spark_rows, sql_rows

SCHEMA = "vec_id long, embedding array<double>"


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, least=0.95):
    width = max((len(v) for _, v in rows if usable(v)), default=0)
    unit = []
    for _, v in rows:
        if usable(v):
            x = np.array([*v, *[0.0] * (width - len(v))])
            x = x / np.abs(x).max()
            unit.append(x / np.sqrt((x * x).sum()))
        else:
            unit.append(np.zeros(width))
    cosine = np.array(unit) @ np.array(unit).T if width else np.zeros((len(rows), len(rows)))
    linked = cosine >= least
    np.fill_diagonal(linked, False)
    label = np.arange(len(rows))
    for a, b in zip(*np.nonzero(linked)):
        label[label == max(label[a], label[b])] = min(label[a], label[b])
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in np.flatnonzero(label == label[k]) if rows[j][0] is not None]
        first = min(ids, default=None)
        out.append((i, int(linked[k].sum()), first, i == first))
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, df.collect()), key=str)


def table(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in ("v", "key", "block", "n", "to", "label", "first")])


def clustered(rng, n, width, spread):
    centres = rng.normal(size=(max(1, n // 12), width))
    v = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, width)) * spread
    return [(int(i), [float(x) for x in row]) for i, row in enumerate(v * rng.uniform(0.1, 9, (n, 1)))]


@pytest.mark.parametrize(
    "width, spread, block, run, fan_out",
    [(3, 0.1, 16, 4, 2), (8, 0.25, 40, 8, 3), (24, 0.22, 64, 16, 8), (64, 0.05, 1000, 64, 8), (40, 0.3, 30, 7, 2)],
)
def test_equals_brute_force(spark, monkeypatch, width, spread, block, run, fan_out):
    monkeypatch.setattr(gj, "BLOCK_BYTES", block * 8 * width)
    monkeypatch.setattr(gj, "RUN_ROWS", run)
    monkeypatch.setattr(gj, "FAN_OUT", fan_out)
    monkeypatch.setattr(gj, "BLOCKS_PER_RANGE", 2)
    monkeypatch.setattr(gj, "PARTNERS", 3)
    rows = clustered(np.random.default_rng(width), 300, width, spread)
    want = brute(rows)
    assert got(gj.near_duplicate_vectors(table(spark, rows))) == want
    assert any(r[1] for r in want)


def test_odd_rows(spark):
    rows = clustered(np.random.default_rng(2), 60, 6, 0.1)
    v = rows[5][1]
    rows += [
        (-1, None),
        (-2, []),
        (-3, [0.0] * 6),
        (-4, [None, *v[1:]]),
        (-5, [float("nan"), *v[1:]]),
        (-6, [float("inf"), *v[1:]]),
        (None, v),
        (None, [-x for x in v]),
        (None, None),
        (100, v),
        (100, v),
        (101, [x * 1e300 for x in v]),
        (102, [x * 1e-300 for x in v]),
        (103, v[:3]),
        (104, [0.0, -0.0, 1.0]),
        (105, [-0.0, 0.0, 1.0, 0.0, 0.0, -0.0]),
    ]
    assert got(gj.near_duplicate_vectors(table(spark, rows))) == brute(rows)


def test_copies_and_a_tight_group(spark, monkeypatch):
    monkeypatch.setattr(gj, "RUN_ROWS", 16)
    rng = np.random.default_rng(4)
    rows = clustered(rng, 200, 16, 0.2)
    centre = rng.normal(size=16)
    rows += [(1000 + k, [float(x) for x in centre]) for k in range(150)]
    rows += [(2000 + k, [float(x) for x in centre + rng.normal(size=16) * 0.01]) for k in range(200)]
    assert got(gj.near_duplicate_vectors(table(spark, rows))) == brute(rows)


def test_pairs_of_blocks_skip_what_is_far(spark):
    boxes = [(k, [float(k), 0.0], [k + 0.5, 0.1]) for k in range(100)]
    df = spark.createDataFrame(boxes, "block long, lo array<double>, hi array<double>")
    found = {(r.a, r.b) for r in gj.block_pairs(df, 2, 0.6).collect()}
    assert found == {(a, b) for a in range(100) for b in (a, a + 1) if b < 100}


def test_the_edge_of_the_threshold(spark):
    c = 0.95
    rows = [(1, [1.0, 0.0]), (2, [c, math.sqrt(1 - c * c) + 1e-7]), (3, [c, -math.sqrt(1 - c * c) + 1e-7])]
    assert [r[1] for r in got(gj.near_duplicate_vectors(table(spark, rows)))] == [1, 0, 1]


def test_empty_table(spark):
    assert got(gj.near_duplicate_vectors(table(spark, []))) == []
    assert got(gj.near_duplicate_vectors(table(spark, [(4, None)]))) == [(4, 0, 4, True)]


@pytest.mark.parametrize("sf, n", [("0.01", 500), ("0.1", 2000)])
def test_query_equals_sql(spark, sf, n):
    sf_dir = f"/root/testdata/sf{sf}"
    types, rows = spark_rows(QUERIES["op13_embedding_near_dedup"](spark, sf_dir))
    want_types, want = sql_rows(open_tables(sf_dir), ORACLES["op13_embedding_near_dedup"])
    assert types == want_types and rows == want and len(rows) == n
