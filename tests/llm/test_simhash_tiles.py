import random
import tracemalloc

import numpy as np
import pytest
import xxhash

from shelfgap.llm import simhash_tiles
from shelfgap.llm.components import connected_components
from shelfgap.llm.queries import QUERIES
from tests.llm.cases import PASSAGE, TEXTS, documents, no_documents, rows


def classes(n, links):
    label = list(range(n))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(k) for k in range(n)]


def fingerprint(text):
    lower = (text or "").encode().lower()
    words = lower.split()
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(texts, radius=4):
    prints = [fingerprint(t) for _, t in texts]
    n = len(texts)
    links = [(a, b) for a in range(n) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= radius]
    label = classes(n, links)
    least = {}
    for k, (i, _) in enumerate(texts):
        if i is not None:
            least[label[k]] = min(least.get(label[k], i), i)
    return sorted(((i, f"{prints[k]:016x}", least.get(label[k])) for k, (i, _) in enumerate(texts)), key=str)


def test_equals_brute_force(spark):
    texts = [(i, t) for i, t, _, _ in TEXTS]
    assert rows(simhash_tiles.near_duplicates(documents(spark))) == brute(texts)
    assert simhash_tiles.near_duplicates(no_documents(spark)).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op7_near_duplicates"](spark, sf_dir)) == brute(texts)


@pytest.mark.parametrize("radius, words, first", [(3, 1, None), (40, 4, 16)])
def test_links_connect_what_is_near(spark, monkeypatch, radius, words, first):
    monkeypatch.setattr(simhash_tiles, "TILE_ROWS", 60)
    monkeypatch.setattr(simhash_tiles, "CELLS_AT_ONCE", 200)  # tiles are cut again
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, (40, words), dtype=np.uint64)
    points = {c.tobytes() for c in centres}
    for _ in range(400):
        p = centres[rng.integers(0, 40)].copy()
        for bit in rng.integers(0, 64 * words, rng.integers(0, radius + 2)):
            p[bit // 64] ^= np.uint64(1 << int(bit % 64))
        points.add(p.tobytes())
    points = sorted(points)
    m = simhash_tiles._matrix(points, words)
    d = np.bitwise_count(m[:, None] ^ m[None]).astype(int)
    near = (d.sum(2) <= radius) & (d[:, :, 0] <= (radius if first is None else first))
    want = classes(len(points), [(a, b) for a, b in zip(*np.nonzero(near)) if a > b])
    df = spark.createDataFrame([(bytearray(p),) for p in points], "fingerprint binary")
    found = simhash_tiles.links(df, radius, words, first).collect()
    place = {p: k for k, p in enumerate(points)}
    got = classes(len(points), [(place[bytes(r.a)], place[bytes(r.b)]) for r in found])
    assert got == want


@pytest.mark.parametrize("copies", [False, True])
def test_comparison_of_tiles_holds_little(copies):
    n, words, radius, first = 8192, 8, 115, 22
    rng = np.random.default_rng(4)
    a, b = (rng.integers(0, 1 << 63, (n, words), dtype=np.uint64) for _ in range(2))
    if copies:  # all cells are hits
        a[:1500], b[:1500] = a[0], a[0]
        a, b = a[:1500], b[:1500]
    else:
        b[::100] = a[::100]
    tracemalloc.start()
    found = sum(len(i) for i, _ in simhash_tiles.near_pairs(a, b, radius, first))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == (1500 * 1500 if copies else len(range(0, n, 100)))
    assert peak < 48 << 20


def test_links_over_groups_of_few_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash_tiles, "TILE_ROWS", 20)
    monkeypatch.setattr(simhash_tiles, "GROUP_BYTES", 2 * 20 * 64)  # two tiles
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, (12, 8), dtype=np.uint64)
    points = np.repeat(centres, 25, 0)
    points[:, 7] ^= rng.integers(0, 1 << 12, len(points), dtype=np.uint64)
    points = sorted({p.tobytes() for p in points})
    df = spark.createDataFrame([(bytearray(p),) for p in points], "fingerprint binary")
    links = simhash_tiles.links(df, 115, 8, 22)
    place = {p: k for k, p in enumerate(points)}
    got = classes(len(points), [(place[bytes(r.a)], place[bytes(r.b)]) for r in links.collect()])
    m = simhash_tiles._matrix(points, 8)
    near = np.bitwise_count(m[:, None] ^ m[None]).sum(2, dtype=int) <= 115
    assert got == classes(len(points), [(a, b) for a, b in zip(*np.nonzero(near)) if a > b])


def test_one_document_of_each_group_stays(spark):
    rnd = random.Random(0)
    vocabulary = [f"v{k}" for k in range(400)]
    base = [" ".join(rnd.choice(vocabulary) for _ in range(300)) for _ in range(30)]
    near = [t.replace(t.split()[150], "changed") for t in base[:10]]
    half = [" ".join(t.split()[:150] + [rnd.choice(vocabulary) for _ in range(150)]) for t in base[10:20]]
    texts = [(k, t, "en", "a") for k, t in enumerate([*base, *near, *half])] + [(3, base[3], "en", "a")]
    kept = [r.doc_id for r in simhash_tiles.drop_near_duplicates(documents(spark, texts)).collect()]
    assert sorted(kept) == [*range(30), *range(40, 50)]


def test_stage_on_odd_rows(spark):
    df = documents(spark)
    kept = simhash_tiles.drop_near_duplicates(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    # The texts without words are one group, 0, 1 and 11 are alike, so are 6 and one of 7; both rows of
    # 8 are one.
    assert sorted(ids, key=str) == sorted([0, 2, 5, 6, 7, 8, 9, 10, None, -5], key=str)
    assert simhash_tiles.drop_near_duplicates(no_documents(spark)).count() == 0
    assert PASSAGE in kept.where("doc_id = 0").first().text


def test_components_of_chains_stars_and_loops(spark):
    rnd = random.Random(5)
    edges = [(k, k + 1) for k in range(200)] + [(500, k) for k in range(501, 900)] + [(7, 7), (None, 3)]
    edges += [(1000 + rnd.randrange(60), 1000 + rnd.randrange(60)) for _ in range(40)]
    rnd.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    label = classes(1100, [e for e in edges if None not in e])
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {k: label[k] for k in range(1100) if label[k] != k}
    assert connected_components(df.limit(0)).count() == 0
