import itertools
import zlib

import numpy as np
import pytest

from shelfgap.llm import language
from shelfgap.llm.queries import QUERIES
from tests.llm.cases import documents, no_documents

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


@pytest.mark.parametrize("seed", range(20))
def test_viterbi_and_shortcut_equal_all_paths(seed):
    rng = np.random.default_rng(seed)
    scores = rng.normal(0, 3, (6, 3))
    penalty = float(rng.uniform(0, 6))

    def value(path):
        return sum(scores[t, s] for t, s in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))

    best = max(map(value, itertools.product(range(3), repeat=6)))
    texts = [scores[:2], scores, scores[:0], scores[:4]]
    paths = language.viterbi(texts, penalty)
    assert [len(p) for p in paths] == [2, 6, 0, 4]
    assert value(paths[1]) == pytest.approx(best)
    whole = int(scores.sum(0).argmax())
    if language.one_language_is_best(scores, whole, penalty):
        assert value([whole] * 6) == pytest.approx(best)


def test_held_out_accuracy_and_independence(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {r.doc_id: r for r in QUERIES["op6_language"](spark, SF_DIR).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert set(found) == set(truth)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in found.items() if r.held_out} == set(held)
    assert np.mean([found[i].lang_pred == truth[i] for i in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in found.values())


def test_spans_of_mixed_text(spark, model):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    part = {
        r.lang: " ".join(r.text.split()[:60])
        for r in docs.where("n_chars > 1500 and n_chars < 3000 and lang in ('de', 'fr', 'en')").orderBy("doc_id").collect()
    }
    text = " ".join([part["de"], part["fr"], part["en"]])
    row = language.identify(documents(spark, [(1, text, None, None)]), model, with_spans=True).first()
    assert [s.lang for s in row.lang_spans] == ["de", "fr", "en"]
    assert abs(row.lang_spans[1].first - 60) <= 3 and abs(row.lang_spans[2].first - 120) <= 3
    assert row.lang_spans[0].first == 0 and row.lang_spans[2].end == 180


def test_scripts_narrow_the_languages(spark):
    rows = [(k, t, lang, "s") for k, (t, lang) in enumerate([("русский текст здесь", "ru"), ("plain english text", "en"), ("ελληνικά κείμενα", "el")] * 30)]
    learned = language.fit(documents(spark, rows))
    df = documents(spark, [(1, "совсем иные буквы", None, None), (2, "zzz", None, None), (3, "ωωω 123", None, None)])
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(df, learned).collect()}
    assert {k: v[0] for k, v in found.items()} == {1: "ru", 2: "en", 3: "el"}


def test_odd_rows(spark, model):
    df = documents(spark)
    found = language.identify(df, model).collect()
    assert len(found) == 16
    for r in found:
        if r.doc_id in (2, 3, 4):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in model.languages
    assert language.identify(no_documents(spark), model).count() == 0


def test_stage_keeps_all_but_text_without_language(spark):
    df = documents(spark)
    kept = language.keep_known(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert not {2, 3, 4} & set(ids) and {0, 1, 6, 7, 8, 9, 11} <= set(ids)
    unlabelled = documents(spark, [(1, "text", None, None), (2, "12 !", None, None)])
    assert [r.doc_id for r in language.keep_known(unlabelled).collect()] == [1]
    assert language.keep_known(no_documents(spark)).count() == 0


def test_nothing_learned_is_unknown(spark):
    empty = language.fit(no_documents(spark))
    row = language.identify(documents(spark, [(1, "some text", None, None)]), empty).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)
