import glob
import os
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfgap.llm import records
from shelfgap.llm.queries import QUERIES, tokenizer_path
from tests.llm.cases import TEXTS, documents, no_documents


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def want(texts, tokenizer):
    out, start = [], 0
    order = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode()))
    for i, text in order:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_digests_equal_the_tokenizer(spark, tmp_path, tokenizer):
    index = records.write_records(documents(spark), str(tmp_path), tokenizer_path(), file_text_bytes=50_000)
    got = sorted(map(tuple, records.record_digests(index, str(tmp_path)).collect()), key=str)
    assert got == want([(i, t) for i, t, _, _ in TEXTS], tokenizer)
    assert len(glob.glob(f"{tmp_path}/data/*.rec")) > 1


def test_shuffled_read_by_the_index(spark, tmp_path, tokenizer):
    index = records.write_records(documents(spark), str(tmp_path), tokenizer_path())
    shuffled = records.read_records(index.orderBy("n_bytes"), str(tmp_path))
    got = {(r.doc_id, tuple(r.token_ids)) for r in shuffled.collect()}
    assert got == {
        (i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for i, t, _, _ in TEXTS
    }


def test_files_of_lost_tasks_are_not_read(spark, tmp_path):
    index = records.write_records(documents(spark), str(tmp_path), tokenizer_path())
    (tmp_path / "data" / "left-behind.rec").write_bytes(b"half a record")
    assert records.record_digests(index, str(tmp_path)).count() == len(TEXTS)


def test_damage_is_found(spark, tmp_path):
    index = records.write_records(documents(spark), str(tmp_path), tokenizer_path())
    path = glob.glob(f"{tmp_path}/data/*.rec")[0]
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 1
    os.remove(path)
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        records.record_digests(index, str(tmp_path)).collect()


def test_empty_table(spark, tmp_path):
    assert records.tokenized_digests(spark, no_documents(spark), str(tmp_path), tokenizer_path()).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.none() | st.integers(-(1 << 63), (1 << 63) - 1), st.lists(st.integers(0, 65535)), st.booleans())
def test_frames(doc_id, ids, wide):
    record = records.frame(doc_id, np.array(ids, "<u4" if wide else "<u2").tobytes(), wide)
    got, back = records.unframe(record)
    assert got == doc_id and back.tolist() == ids


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aBcé Σİ.,'s\n\t ́<|endoftext|>12#") | st.characters(exclude_categories=["Cs"])))
def test_words_in_turn_are_the_text(text):
    words = records._word_ids(tokenizer_path(), "<u2")
    got = b"".join(words[w] for w in text.encode().split())
    assert got == words.ids(text)


def test_every_letter_in_every_place(tokenizer):
    words = records._word_ids(tokenizer_path(), "<u2")
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha()]
    # Of letters without case that no normalization changes, one in 64 from 0x3400 on.
    letters = [
        c
        for c in letters
        if ord(c) < 0x3400 or c.lower() != c or unicodedata.normalize("NFC", c) != c or not ord(c) % 64
    ]
    letters += ["\u0301", "\u093c", "\u200d"]
    for place in ("{}", "{}ab", "ab{}", "Ab{}.", "{}.,!", "\u0130\u0928{},"):
        texts = [place.format(c) for c in letters]
        found = tokenizer.encode_batch(texts, add_special_tokens=False)
        wrong = [t for t, e in zip(texts, found) if words.__missing__(t.encode()) != np.array(e.ids, "<u2").tobytes()]
        assert not wrong


def test_letters_that_change_when_normalized(spark, tmp_path, tokenizer):
    texts = [
        (1, "see \U0001d5d5\U0001d5fc\U0001d5f9\U0001d5f1 text", "en", "a"),
        (2, "\u0130, \u0915\u093c. \u0958,", "en", "a"),
        (3, "\u03a3 \u039f\u0394\u039f\u03a3 \u039f\u0394\u039f\u03a3. UPPER Upper. mIxEd,", "en", "a"),
    ]
    got = records.tokenized_digests(spark, documents(spark, texts), str(tmp_path), tokenizer_path())
    assert sorted(map(tuple, got.collect()), key=str) == want([(i, t) for i, t, _, _ in texts], tokenizer)


def test_query(spark, tokenizer):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    result = QUERIES["op3_token_records"](spark, sf_dir)
    assert sorted(map(tuple, result.collect()), key=str) == want(list(map(tuple, docs)), tokenizer)


def test_new_words_are_encoded_together(tokenizer):
    """As the tokenizer encodes the texts, with fewer calls than words."""
    texts = [f"{a}{b}ly {a.upper()}{b}, it's {b}é{a}. 12 日{a} ﬁ{b}" for a in ("foo", "bar", "què") for b in ("ba", "zu", "ing")]
    words = records._WordIds(tokenizer_path(), "<u2")
    calls = []
    encode = words.encode
    words.encode = lambda *a, **k: calls.append(a) or encode(*a, **k)
    got = list(words.of_texts([t.encode() for t in texts]))
    want_ids = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert got == want_ids
    assert not any(records._PLAIN(a[0]) for a in calls)


def test_ids_stay_with_their_documents_over_many_portions(spark, tmp_path, tokenizer, monkeypatch):
    texts = [(k, f"w{k} s{k}. " * 60_000) for k in range(6)] + [(40, None), (41, ""), (42, "end")]
    rows = pa.RecordBatch.from_pydict({"t": [None if t is None else t.encode() for _, t in texts]})
    with monkeypatch.context() as m:
        m.setattr(records, "LEARN_BYTES", 1)
        portions = list(records._portions(rows.column(0)))
    assert sum(len(t or "") for _, t in texts) > 2 * records.LEARN_BYTES
    assert [x for p in portions for x in p] == [(t or "").encode() for _, t in texts] and len(portions) == 7
    docs = spark.createDataFrame([(i, t) for i, t in texts], "doc_id long, text string").coalesce(1)
    index = records.write_records(docs, str(tmp_path), tokenizer_path())
    got = sorted(map(tuple, records.record_digests(index, str(tmp_path)).collect()), key=str)
    assert got == want(texts, tokenizer)
