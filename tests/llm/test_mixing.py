import glob
import hashlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from shelfgap.llm import mixing
from shelfgap.llm.oracles import ORACLES
from shelfgap.llm.queries import QUERIES
from tests.compare import open_tables, spark_rows, sql_rows
from tests.llm.cases import TEXTS, documents, no_documents


def want_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """The shares, dealt again and again until no source is above its bound."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    free, total = set(names), share * sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in names if s not in free)
        level = rest / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > most * sizes[s]}
        if not above:
            return {s: level * weight[s] if s in free else most * sizes[s] for s in names}
        free -= above


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_targets_and_taken_words(spark, block):
    found = mixing.taken_words(documents(spark), block_words=block)
    n = [len((t or "").encode().split()) for _, t, _, _ in TEXTS]
    sizes, source = Counter(), {}
    for k, (i, _, _, s) in zip(n, TEXTS):
        sizes[s] += k
    got = found.collect()
    assert sorted((r.doc_id, r["size"]) for r in got if r.doc_id is not None) == sorted(
        (i, k) for k, (i, _, _, _) in zip(n, TEXTS) if i is not None
    )
    targets = want_targets(sizes)
    by_size = {sizes[s]: s for s in sizes}
    taken = defaultdict(int)
    for r in got:
        source = by_size[r.source_size]
        assert r.target == pytest.approx(targets[source])
        assert 0 <= r.taken <= 2 * r["size"] and (r.first_slot is None) == (r.n_pieces == 0) == (r.taken == 0)
        taken[source] += r.taken
    for s in sizes:
        # Whole blocks, but for the last one of a source that is taken twice; a few from the target.
        assert taken[s] % block == 0 or taken[s] == 2 * sizes[s]
        assert abs(taken[s] - targets[s]) < 4 * block
    assert sorted(map(str, got)) == sorted(map(str, mixing.taken_words(documents(spark), block_words=block).collect()))


def want_mix(rows, block, golden=mixing.GOLDEN):
    """(doc_id, size) -> words and first slot, by walking through the slots one by one."""
    sizes = Counter()
    for _, n, s in rows:
        sizes[s] += n
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = {s: int(t + 1e-9) for s, t in want_targets(sizes).items()}
    total, ends, sofar = sum(wanted.values()), [], 0
    for s in names:
        sofar += wanted[s]
        ends.append((int(sofar / total * 2**31), s))
    words = {
        s: [i for _, i, n in sorted((hashlib.md5(str(i).encode()).hexdigest(), i, n) for i, n, of in rows if of == s) for _ in range(n)]
        for s in names
    }
    out, met = Counter(), {}
    step, at = int(golden * 2**31) | 1, Counter()
    for slot in range(-(-total // block)):
        s = next(s for end, s in ends if slot * step % 2**31 < end)
        for i in (words[s] * 2)[at[s] * block : (at[s] + 1) * block]:
            out[i] += 1
            met.setdefault(i, slot)
        at[s] += 1
    return {i: (out[i], met.get(i)) for i, _, _ in rows}


@pytest.mark.parametrize("golden", [mixing.GOLDEN, 0.25, 0.0])
def test_words_and_slots_by_walking_through_the_schedule(spark, golden):
    rows = [(k, k * 7 % 40, ("a", "b", None)[k % 7 % 3]) for k in range(200)]
    df = spark.createDataFrame([(i, "w " * n, s) for i, n, s in rows], "doc_id long, text string, source string")
    got = mixing.taken_words(df.repartition(5), block_words=16, golden=golden).collect()
    assert {r.doc_id: (r.taken, r.first_slot) for r in got} == want_mix(rows, 16, golden)


def test_the_points_decide(spark):
    df = documents(spark)
    assert sorted(map(str, mixing.taken_words(df, block_words=4).collect())) != sorted(
        map(str, mixing.taken_words(df, block_words=4, golden=0.0).collect())
    )


def test_runs_of_slots_are_near_the_weights(spark):
    sources = spark.createDataFrame([("a", 40_000.0), ("b", 10_000.0), (None, 30_500.0), ("z", 0.0)], "source string, target double")
    assert mixing.n_slots(sources, 10) == 8050
    slots = sorted(mixing.schedule(sources, 8050).collect(), key=lambda r: r.slot)
    assert [r.slot for r in slots] == list(range(8050))
    blocks = defaultdict(list)
    for r in slots:
        blocks[r.source].append(r.block)
    for s, want in {"a": 4000, "b": 1000, None: 3050}.items():
        assert blocks[s] == list(range(len(blocks[s]))) and abs(len(blocks[s]) - want) <= 3
    for lo in range(0, 8000, 500):
        part = Counter(r.source for r in slots if lo <= r.slot < lo + 500)
        assert abs(part["a"] - 500 * 4000 / 8050) < 8 and abs(part["b"] - 500 * 1000 / 8050) < 8


def test_mix_is_written_in_slot_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "PART_WORDS", 1000)
    rows = [(k, k * 7 % 40 + 1, ("a", "b", None)[k % 7 % 3]) for k in range(200)]
    df = spark.createDataFrame([(i, "w " * n, s) for i, n, s in rows], "doc_id long, text string, source string")
    mixing.mixed_documents(df, block_words=16).write.parquet(f"{tmp_path}/mix")
    files = sorted(glob.glob(f"{tmp_path}/mix/*.parquet"))
    found = [i for f in files for i in pq.read_table(f)["doc_id"].to_pylist()]
    first = [i for k, i in enumerate(found) if i not in found[:k]]
    slot = {i: s for i, (_, s) in want_mix(rows, 16).items()}
    assert len(files) > 1 and [slot[i] for i in first] == sorted(slot[i] for i in first)


def test_null_ids_empty_sources_and_long_texts(spark):
    rows = [(None, "a b c", None), (None, "d e", None), (1, "w " * 300_000, "x"), (2, "", "y"), (2, None, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {(r.doc_id, r["size"]): r for r in mixing.taken_words(df).collect()}
    assert got[None, 3].taken <= 6 and got[2, 0].taken == 0 and got[2, 0].target == 0
    assert abs(got[1, 300_000].taken - got[1, 300_000].target) <= 4 * mixing.BLOCK_WORDS
    assert {r.doc_id for r in mixing.mixed_documents(df).collect()} <= {None, 1}


def test_documents_as_often_as_taken(spark):
    df = documents(spark)
    mixed = mixing.mixed_documents(df, block_words=16)
    assert mixed.columns == df.columns
    taken = {(r.doc_id, r["size"]): r for r in mixing.taken_words(df, block_words=16).collect()}
    times = Counter((r.doc_id, len((r.text or "").encode().split())) for r in mixed.collect())
    for (i, n), r in taken.items():
        if i != 8 and n:
            assert times[i, n] == int(r.taken / n + 0.5)
    assert times[8, 24] <= 4 and times[2, 0] == 0
    for empty in (mixing.mixed_documents, mixing.taken_words):
        assert empty(no_documents(spark)).count() == 0
    assert mixing.taken_words(documents(spark, [(1, None, None, None)])).first().taken == 0


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = spark_rows(QUERIES["op8_source_mix"](spark, sf_dir))
    assert got == sql_rows(open_tables(sf_dir), ORACLES["op8_source_mix"])
