import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shelfgap.llm import substring
from tests.llm.cases import TEXTS, documents, no_documents


def brute(texts, n):
    """(words, kept) of each (doc_id, text), rows in order of id."""
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in texts]
    place = lambda i: -(1 << 63) if i is None else i
    for i, words in split:
        for s in range(len(words) - n + 1):
            key = tuple(words[s : s + n])
            first[key] = min(first.get(key, (place(i), s)), (place(i), s))
    out = []
    for i, words in split:
        gone = set()
        for s in range(len(words) - n + 1):
            if first[tuple(words[s : s + n])] < (place(i), s):
                gone.update(range(s, s + n))
        out.append((i, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=str)


def got(df):
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, bytes(r.kept_text)) for r in df.collect()), key=str
    )


@pytest.mark.parametrize("n", [20, 24])
def test_equals_brute_force(spark, n):
    texts = [(i, t) for i, t, _, _ in TEXTS]
    assert got(substring.drop_repeats(documents(spark), n)) == brute(texts, n)


def test_random_texts_with_frequent_passages(spark, monkeypatch):
    # Every anchor of the sample counts as frequent in one run, and none in the other.
    rnd = random.Random(1)
    passages = [[f"p{k}w{j}" for j in range(rnd.randrange(18, 50))] for k in range(6)]
    texts = []
    for i in range(300):
        words = []
        for _ in range(rnd.randrange(1, 6)):
            words += rnd.choice(passages) if rnd.random() < 0.6 else [f"u{rnd.randrange(40)}" for _ in range(15)]
        texts.append((i, " ".join(words)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    want = brute(texts, 20)
    for least in (1, 10**9):
        monkeypatch.setattr(substring, "HOT_COUNT", least)
        monkeypatch.setattr(substring, "HOT_SAMPLE", 2)
        monkeypatch.setattr(substring, "SUFFIXES_AT_ONCE", 50)
        assert got(substring.drop_repeats(df)) == want


def test_subtree_is_the_sorted_order_with_shared_prefixes():
    import numpy as np

    rng = np.random.default_rng(0)
    suffixes = rng.integers(0, 3, (200, 6))
    order, shared = substring.subtree(suffixes, [np.arange(200)])
    ranked = [tuple(suffixes[k]) for k in order]
    assert ranked == sorted(map(tuple, suffixes))
    for a, b, n in zip(ranked, ranked[1:], shared[1:]):
        assert a[:n] == b[:n] and (n == 6 or a[n] != b[n])


def test_spans_and_empty_table(spark):
    assert substring.drop_repeats(no_documents(spark)).count() == 0
    found = {r.doc_id: r for r in substring.drop_repeats(documents(spark)).where("doc_id in (0, 1)").collect()}
    assert found[0].removed == [] and [tuple(s) for s in found[1].removed] == [(1, 50)]


def test_query_on_a_given_table(spark):
    from shelfgap.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = [(i, n, k, hashlib.sha256(t).hexdigest()) for i, n, k, t in brute(map(tuple, docs), 20)]
    result = QUERIES["op2_substring_dedup"](spark, sf_dir)
    result = result.select("doc_id", "n_words", "n_removed", F.col("kept_sha256"))
    assert sorted(map(tuple, result.collect()), key=str) == want
