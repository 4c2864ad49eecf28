import zlib

import numpy as np
import pytest

from shelfgap.llm import quality
from shelfgap.llm.queries import QUERIES
from tests.llm.cases import documents, no_documents

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = {r.doc_id: r for r in QUERIES["op4_quality"](spark, SF_DIR).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert len(found) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(found[i].score, y) for i, y in labels.items() if found[i].held_out]
    good, bad = ([s for s, y in held if y == k] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.98
    assert np.mean([(s >= 0.3) == (y == 1) for s, y in held]) > 0.95


def test_dual_coordinate_descent_finds_the_optimum():
    # Two features and the constant, against a fine search of the primal problem.
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (40, 2))
    labels = (x[:, 0] + 0.3 * rng.normal(0, 1, 40) > 0).astype(int)
    rows = [np.array([0, 1])] * 40
    costs = np.full(40, 0.5)
    w = quality.dual_coordinate_descent(rows, list(x), labels, costs, epochs=2000, tolerance=1e-6)[:2]
    sign = 2 * labels - 1

    def primal(w):
        return w @ w / 2 + 0.5 * np.maximum(0, 1 - sign * (x @ w)).sum()

    around = [primal(w + d) for d in rng.normal(0, 0.05, (2000, 2))]
    assert primal(w) <= min(around) + 1e-6


def test_labels_are_not_leaked_and_bounded(spark):
    labels = spark.createDataFrame(
        [(k, k % 2, 0) for k in range(2000)] + [(5, 0, 0), (6, None, 0), (7, 9, 0), (None, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.training_labels(labels, 200).collect()
    ids = {r.doc_id for r in rows}
    assert all(zlib.crc32(str(i).encode()) % 5 for i in ids) and 5 not in ids and None not in ids
    assert 300 < len(rows) < 500
    assert sum(r["count"] for r in rows) == pytest.approx(1600, rel=0.3)


def test_odd_rows(spark):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(12)], "doc_id long, quality int, toxic int")
    model = quality.fit(documents(spark), labels)
    found = quality.score_documents(documents(spark), model).collect()
    assert len(found) == 16 and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (2, 3, 4)}) == 1
    assert quality.score_documents(no_documents(spark), model).count() == 0
    one_class = quality.fit(documents(spark), labels.where("quality = 1"))
    assert all(r.score > 0.5 for r in quality.score_documents(documents(spark), one_class).collect())
    nothing = quality.fit(no_documents(spark), labels.limit(0))
    assert quality.score_documents(documents(spark), nothing).first().score == 0.5
