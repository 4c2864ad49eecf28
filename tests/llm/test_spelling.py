import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfgap.llm import spelling
from shelfgap.llm.oracles import ORACLES
from shelfgap.llm.queries import QUERIES
from tests.compare import open_tables, spark_rows, sql_rows
from tests.llm.cases import LONG, TEXTS, documents, no_documents, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(texts, least_points=5, least_count=3):
    total = Counter()
    for i, text in texts:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least_points and n >= least_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(n, factor=2, pairs=None):
    words = sorted(n)
    if pairs is None:
        pairs = [(a, b) for a in words for b in words if near(a, b)]
    around = {w: [] for w in words}
    for a, b in pairs:
        around[a].append(b)
    form = {}
    for w in words:
        best = min(around[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(around[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def by_deletion(words):
    """Near pairs by the texts that remain when a character is left out."""
    at = {}
    for w in words:
        for k in range(len(w)):
            at.setdefault((k, w[:k] + w[k + 1 :]), set()).add(w)
    pairs = {(a, b) for g in at.values() for a in g for b in g if a != b}
    for (_, rest), g in at.items():
        if rest in words:
            pairs |= {(a, rest) for a in g} | {(rest, a) for a in g}
    return pairs


def table(spark, n):
    return spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)


def test_equals_brute_force_on_odd_rows(spark):
    texts = [(i, t) for i, t, _, _ in TEXTS]
    extra = [(k, "colour colour colour colour COLOUR color color favourite favorite cafés cafès café's éclair éclairs", "en", "a") for k in range(20, 40)]
    docs = documents(spark, TEXTS + extra)
    want = brute(counts(texts + [(i, t) for i, t, _, _ in extra]))
    assert rows(spelling.spelling_variants(docs)) == want
    assert any(r[1] for r in want)
    assert spelling.spelling_variants(no_documents(spark)).count() == 0


@pytest.mark.parametrize("per_range, alphabet", [(7, "ab"), (50, "abc"), (1 << 17, "abcdé")])
def test_variants_of_made_words(spark, monkeypatch, per_range, alphabet):
    monkeypatch.setattr(spelling, "WORDS_PER_RANGE", per_range)
    rnd = random.Random(per_range)
    words = {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 7))) for _ in range(400)}
    n = {w: rnd.choice([1, 2, 3, 5, 8, 20, 60, 200]) for w in words}
    assert rows(spelling.variants(table(spark, n))) == brute(n)


def test_long_words(spark):
    long = LONG.replace(" ", "")[:100_000]
    n = {long: 5, long + "x": 1, "y" + long: 2, long[:50_000] + long[50_001:]: 1, "a" * 3000: 9, "a" * 2999: 4, "a" * 2998: 1}
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.variants(table(spark, n)).collect()}
    assert got[long] == (None, long, 3)
    assert all(got[w][:2] == (long, long) for w in n if len(w) > 90_000 and w != long)
    assert got["a" * 2998] == ("a" * 2999, "a" * 3000, 1)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aBZé×÷Àÿœ日 \t-'.0ßĀ́") | st.characters(exclude_categories=["Cs"])))
def test_runs(text):
    want = [r.translate(LOWER) for r in re.findall(r"[A-Za-zÀ-ÿ]+", text)]
    assert [r.decode() for r in spelling.runs(text.encode())] == want


@settings(max_examples=300, deadline=None)
@given(st.text("ab", max_size=80), st.text("ab", max_size=80), st.text("ab", max_size=40))
def test_common_prefix(head, a, b):
    a, b = head + a, head + b
    k = spelling.common_prefix(a, b)
    assert a[:k] == b[:k] and (k == min(len(a), len(b)) or a[k] != b[k])


def test_a_word_that_is_most_of_the_text(spark):
    texts = [(k, "common " * 500 + ("comman " if k % 10 == 0 else ""), "en", "a") for k in range(60)]
    got = rows(spelling.spelling_variants(documents(spark, texts)))
    assert got == brute(counts([(i, t) for i, t, _, _ in texts]))


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    n = counts(texts)
    assert rows(QUERIES["op11_spelling_variants"](spark, sf_dir)) == brute(n, pairs=by_deletion(n))


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    types, found = spark_rows(QUERIES["op11_spelling_variants"](spark, sf_dir))
    want_types, want = sql_rows(open_tables(sf_dir), ORACLES["op11_spelling_variants"])
    assert types == want_types and found == want
