import hashlib
import random

import pytest

from shelfgap.llm import fingerprints
from shelfgap.llm.queries import QUERIES
from tests.llm.cases import TEXTS, documents, no_documents


def check(texts, found, every):
    """Everything that does not depend on the hash itself."""
    order = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, (x[1] or "").encode()), reverse=True)
    text = [t or "" for _, t in order]
    assert len(found) == len(order)
    rows = {}
    prints = {}
    for r in found:
        rows.setdefault((r.doc_id, r.edited_sha256), []).append(r)
    values = [int(r.fingerprint, 16) for r in found]
    for k, (i, _) in enumerate(order):
        following = text[(k + 1) % len(text)]
        half = len(text[k]) // 2
        edited = text[k][: len(text[k]) - half] + following[:half]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        row = next(r for r in rows[i, sha] if r.n_chars == len(text[k]))
        value, other = int(row.fingerprint, 16), int(row.edited_fingerprint, 16)
        assert prints.setdefault(text[k], value) == value
        assert prints.setdefault(edited, other) == other
        assert row.near_edited == 1 - bin(value ^ other).count("1") / 64
        prints[k] = value, row
        asked = i is not None and i % every == 0
        near = sum(bin(value ^ v).count("1") <= 3 for v in values) - 1
        assert row.near_docs == (near if asked else None)
    for k in range(len(order)):
        value, row = prints[k]
        assert row.near_next == 1 - bin(value ^ prints[(k + 1) % len(order)][0]).count("1") / 64


@pytest.mark.parametrize("per_bucket", [1, 3, 512])
def test_edited_texts_and_likeness(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(fingerprints, "ROWS_PER_BUCKET", per_bucket)
    # Repeated ids with other texts and repeated rows are ordered by text.
    found = fingerprints.edited_fingerprints(documents(spark), 3, 5).collect()
    check([(i, t) for i, t, _, _ in TEXTS], found, 5)


def test_few_rows(spark):
    assert fingerprints.edited_fingerprints(no_documents(spark)).count() == 0
    row = fingerprints.edited_fingerprints(documents(spark, [(50, "a b c d", None, None)])).first()
    assert row.near_next == 1.0 and row.near_docs == 0


def test_bits_are_the_majority_of_the_terms(spark):
    text = " ".join(f"t{k % 7}x{k % 11}" for k in range(300))
    words = text.split()
    rows = spark.createDataFrame([(" ".join(words[k : k + 5]),) for k in range(296)], "t string")
    hashes = [r[0] % (1 << 64) for r in rows.selectExpr("xxhash64(split(t, ' '))").collect()]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    row = fingerprints.edited_fingerprints(documents(spark, [(1, text, None, None)])).first()
    assert int(row.fingerprint, 16) == want


@pytest.mark.parametrize("radius", [0, 2, 3, 5])
def test_block_tables_find_all_within_the_radius(spark, radius):
    rnd = random.Random(radius)
    points = {rnd.getrandbits(64) for _ in range(60)}
    for p in list(points):
        for _ in range(6):
            for bit in rnd.sample(range(64), rnd.randrange(radius + 2)):
                p ^= 1 << bit
            points.add(p)
    points = [p - (1 << 64) if p >> 63 else p for p in points]
    queries = points[::3]
    bits = lambda a, b: bin((a ^ b) % (1 << 64)).count("1")
    want = {(q, p) for q in queries for p in points if bits(q, p) <= radius}
    df = lambda v: spark.createDataFrame([(x,) for x in v], "fingerprint long")
    found = fingerprints.within_radius(df(queries), df(points), radius).collect()
    assert len(found) == len(want) and {tuple(r) for r in found} == want


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(texts, QUERIES["op9_simhash"](spark, sf_dir).collect(), 50)


def test_main_path_is_native(spark):
    df = QUERIES["op9_simhash"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
