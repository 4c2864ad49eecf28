import random
from itertools import combinations

import numpy as np
import pytest

from shelfgap.llm import decontaminate
from shelfgap.llm.queries import QUERIES
from tests.llm.cases import PASSAGE, documents, no_documents, rows

ITEM = [f"q{k}" for k in range(30)]


def item_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string, n_matched string")


def test_substituted_passages_are_found(spark):
    rnd = random.Random(2)
    docs, want = [], set()
    for k in range(60):
        words = list(ITEM)
        n = k % 9
        for at in rnd.sample(range(30), n):
            words[at] = f"other{k}"
        text = [f"x{j}" for j in range(k)] + words + ["y"] * 5
        docs.append((k, " ".join(text).replace("q1 ", "Q1, "), "en", "a"))
        if n <= 6:
            want.add(k)
    docs += [(100 + k, " ".join(rnd.sample(ITEM, 30)), "en", "a") for k in range(20)]
    docs += [(200, " ".join(ITEM[:11]), "en", "a"), (201, " ".join(ITEM[4:16]), "en", "a")]
    items = item_table(spark, [(1, " ".join(ITEM), "x"), (2, "short one", "x"), (3, None, "x"), (4, "", "x")])
    found = {r.doc_id for r in decontaminate.overlaps(documents(spark, docs), items).collect()}
    # With 7 or 8 of 30 substituted, a stretch of 12 may still agree well enough.
    assert want | {201} <= found and not found & {*range(100, 120), 200}


@pytest.mark.parametrize("per_block", [10, 10**6])
def test_spans_blocks_and_odd_rows(spark, per_block):
    items = item_table(spark, [(1, PASSAGE, "x"), (1, PASSAGE, "x"), (None, PASSAGE.upper(), "x"), (2, "a b c d e f g h", "x"), (3, "negative id endoftext", "x")])
    got = rows(decontaminate.overlaps(documents(spark), items, seeds_per_block=per_block))
    want = [(i, j, 48, first, first + 48) for i, first in ((0, 1), (1, 2), (11, 1)) for j in (1, 1, None)]
    assert got == sorted(want, key=str)
    kept = decontaminate.clean_documents(documents(spark), items)
    assert kept.columns == documents(spark).columns
    assert len(kept.collect()) == 13
    assert decontaminate.overlaps(no_documents(spark), items).count() == 0
    assert decontaminate.overlaps(documents(spark), items.limit(0)).count() == 0


@pytest.mark.parametrize("n", range(decontaminate.MIN_TOKENS, 21))
def test_every_accepted_pattern_has_a_hit(monkeypatch, n):
    monkeypatch.setattr(decontaminate.SeedIndex, "NEAR_BITS", 12)
    item = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    index = decontaminate.SeedIndex.of([(1, item)])
    for k in range(n // 5 + 1):
        for places in combinations(range(n), k):
            text = item.copy()
            text[list(places)] = np.arange(k, dtype=np.uint64) + np.uint64(7)
            assert decontaminate.overlaps_of(text, index), places


def test_query_equals_brute_force(spark):
    """Every item at every place of every document, without seeds."""
    import numpy as np

    sf_dir = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    known = decontaminate._Tokens()
    items = [(i, decontaminate.tokens_of((t or "").encode(), known)[0]) for i, t in items]
    want = set()
    for doc_id, text in docs:
        tokens = decontaminate.tokens_of((text or "").encode(), known)[0]
        for item_id, item in items:
            if len(np.intersect1d(tokens, item)) < 8:
                continue
            for shift in range(-len(item) + 1, len(tokens)):
                n, *_ = decontaminate.best_stretch(item, tokens, shift)
                if len(item) >= 8 and n >= min(12, -(-4 * len(item) // 5)):
                    want.add((doc_id, item_id))
    got = {(r.doc_id, r.item_id) for r in QUERIES["op1_decontamination"](spark, sf_dir).collect()}
    assert got == want and got
