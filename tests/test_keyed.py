import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from shelfgap.functions.widening import promoted
from shelfgap.operators.keyed import latest_per_key, merge_latest
from shelfgap.operators.ranking import top_n_per_group
from shelfgap.sources import tables
from shelfgap.sources.tables import _options, read_table, upsert_table, write_table
from shelfgap.specs import COMPETITOR_SALES

SCHEMA = "seller_id string, item_id string, sale_date int, units int"
KEY = ["seller_id", "item_id"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def random_rows(seed, n, keys=5):
    rnd = random.Random(seed)
    pick = lambda values: rnd.choice(values)
    return [
        (f"s{rnd.randrange(keys)}", f"i{rnd.randrange(keys)}", pick([None, 1, 2, 3]), pick([1, 2]))
        for _ in range(n)
    ]


def brute_latest(data):
    best = {}
    low = (-1, -1)
    for row in data:
        rank = tuple(-1 if v is None else v for v in row[2:])
        if rank > best.get(row[:2], (low, None))[0]:
            best[row[:2]] = (rank, row)
    return sorted((r for _, r in best.values()), key=str)


def test_latest_per_key(spark):
    for seed in range(3):
        data = random_rows(seed, 80)
        for nearly_unique in (False, True):
            got = latest_per_key(table(spark, data), KEY, "sale_date", nearly_unique)
            assert rows(got) == brute_latest(data)


def test_a_condition_goes_before_the_version(spark):
    data = [("s", "a", 9, 1), ("s", "a", 2, 2), ("s", "a", 1, 2), ("s", "b", 3, 1), ("s", "c", 1, None)]
    want = [("s", "a", 2, 2), ("s", "b", 3, 1), ("s", "c", 1, None)]
    for nearly_unique in (False, True):
        got = latest_per_key(table(spark, data), KEY, "sale_date", nearly_unique, F.col("units") == 2)
        assert rows(got) == want


def test_null_keys_are_one_group(spark):
    data = [(None, "i1", 1, 1), (None, "i1", 2, 1), (None, "i1", None, 9)]
    assert rows(latest_per_key(table(spark, data), KEY, "sale_date")) == [(None, "i1", 2, 1)]


def test_key_only_table(spark):
    df = table(spark, [("s", "i", 1, 1)] * 2).select(*KEY)
    assert rows(latest_per_key(df, KEY, "item_id")) == [("s", "i")]


def test_hot_key(spark):
    data = [("hot", "i", n, n) for n in range(3000)] + [("s", "i", 1, 1)]
    got = rows(latest_per_key(table(spark, data).repartition(8), KEY, "sale_date"))
    assert got == [("hot", "i", 2999, 2999), ("s", "i", 1, 1)]


def test_merge_is_idempotent_and_order_free(spark):
    old = latest_per_key(table(spark, random_rows(1, 60)), KEY, "sale_date")
    new = table(spark, random_rows(2, 60))
    merged = merge_latest(old, new, KEY, "sale_date")
    want = rows(merged)
    assert rows(merge_latest(new, old, KEY, "sale_date")) == want
    assert rows(merge_latest(merged, new, KEY, "sale_date")) == want


def test_merge_with_new_and_missing_columns(spark):
    old = table(spark, [("s", "a", 1, 1), ("s", "b", 5, 1)])
    new = table(spark, [("s", "a", 2, 3), ("s", "c", 1, 1)]).drop("units").withColumn(
        "note", F.lit("n")
    )
    want = [("s", "a", 2, None, "n"), ("s", "b", 5, 1, None), ("s", "c", 1, None, "n")]
    assert rows(merge_latest(old, new, KEY, "sale_date", evolve=True)) == want


@pytest.mark.parametrize("n", [1, 5, 500])
def test_upsert_gives_the_same_whatever_the_size(spark, tmp_path, n):
    """One row per key of both, also if the existing rows repeat keys."""
    old, new = random_rows(3, 400, 40), random_rows(4, n, 40)
    path = str(tmp_path / "table")
    table(spark, old).write.parquet(path)  # a plain folder
    upsert_table(table(spark, new), path, COMPETITOR_SALES)
    assert rows(read_table(spark, path)) == brute_latest(old + new)
    upsert_table(table(spark, old), path, COMPETITOR_SALES)
    assert rows(read_table(spark, path)) == brute_latest(old + new)


def test_upsert_with_new_columns(spark, tmp_path):
    path = str(tmp_path / "table")
    old = [(f"s{k}", "i", 1, k) for k in range(50)]
    write_table(table(spark, old), path, COMPETITOR_SALES)
    new = table(spark, [("s7", "i", 2, 0), ("new", "i", 1, 0)]).drop("units").withColumn("note", F.lit("n"))
    upsert_table(new, path, COMPETITOR_SALES, evolve=True)
    want = [(*r, None) for r in old if r[0] != "s7"] + [("s7", "i", 2, None, "n"), ("new", "i", 1, None, "n")]
    assert rows(read_table(spark, path)) == sorted(want, key=str)


def files_of(path, copy):
    found = glob.glob(f"{path}/copy-{copy}/*/part-*.parquet")
    return {f: os.path.getmtime(f) for f in found}


def test_untouched_buckets_stay(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(table(spark, random_rows(1, 400, 40)), path, COMPETITOR_SALES, buckets=16)
    for k in range(3):
        upsert_table(table(spark, [("s1", "i1", 90 + k, k)]), path, COMPETITOR_SALES)
    before = files_of(path, 1), files_of(path, 0)
    upsert_table(table(spark, [("s1", "i1", 99, 99)]), path, COMPETITOR_SALES)
    after = files_of(path, 1), files_of(path, 0)
    assert before[1] == after[1]
    assert len(before[0]) == len(after[0]) == 16
    assert sum(after[0].get(f) == t for f, t in before[0].items()) == 15
    assert ("s1", "i1", 99, 99) in rows(read_table(spark, path))


def test_many_deliveries(spark, tmp_path):
    """Both copies take every delivery, whatever buckets it falls into."""
    path = str(tmp_path / "table")
    every = random_rows(1, 100, 30)
    write_table(table(spark, every), path, COMPETITOR_SALES, buckets=7)
    for k in range(5):
        new = random_rows(10 + k, 4, 30)
        every += new
        upsert_table(table(spark, new), path, COMPETITOR_SALES)
        assert rows(read_table(spark, path)) == brute_latest(every)
    upsert_table(table(spark, []), path, COMPETITOR_SALES)
    assert rows(read_table(spark, path)) == brute_latest(every)
    write_table(table(spark, every[:9]), path, COMPETITOR_SALES, buckets=3)
    upsert_table(table(spark, every[9:20]), path, COMPETITOR_SALES)
    upsert_table(table(spark, every[20:30]), path, COMPETITOR_SALES)
    assert rows(read_table(spark, path)) == brute_latest(every[:30])


def test_a_narrower_key_finds_its_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    columns = ["{} seller_id", "{} item_id", "int(1) units", "{} sale_date"]
    old = spark.range(200).selectExpr(*[c.format("id") for c in columns])
    write_table(old, path, COMPETITOR_SALES, buckets=16)
    for k in (3, 5, 199):  # whole rewrite, then single buckets
        new = spark.range(k, k + 1).selectExpr(*[c.format("int(id)").replace("int(1)", "int(2)") for c in columns])
        upsert_table(new, path, COMPETITOR_SALES)
    got = read_table(spark, path)
    assert got.dtypes == old.dtypes and got.count() == 200
    assert sorted(r.seller_id for r in got.where("units = 2").collect()) == [3, 5, 199]


def test_a_wider_key_is_taken_with_evolve(spark, tmp_path):
    path = str(tmp_path / "table")
    narrow = ["int(id) seller_id", "string(id) item_id", "float(id) units", "int(id) sale_date"]
    write_table(spark.range(50).selectExpr(*narrow), path, COMPETITOR_SALES, buckets=8)
    wide = spark.range(40, 60).selectExpr("id seller_id", "string(id) item_id", "id + 0.5d units", "int(100) sale_date")
    with pytest.raises(ValueError, match="does not fit"):
        upsert_table(wide, path, COMPETITOR_SALES)
    for _ in range(3):
        upsert_table(wide, path, COMPETITOR_SALES, evolve=True)
        got = read_table(spark, path)
        assert dict(got.dtypes)["seller_id"] == "bigint" and dict(got.dtypes)["units"] == "double"
        assert got.count() == 60 and got.where("units = seller_id + 0.5").count() == 20
    with pytest.raises(ValueError, match="does not fit"):
        upsert_table(wide.withColumn("sale_date", F.lit("x")), path, COMPETITOR_SALES, evolve=True)
    with pytest.raises(ValueError, match="columns differ"):
        upsert_table(wide.drop("units"), path, COMPETITOR_SALES)


def test_full_buckets_are_cut_anew(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    old, new = random_rows(1, 300, 200), random_rows(2, 20, 200)
    write_table(table(spark, old), path, COMPETITOR_SALES)
    assert len(files_of(path, 1)) == 1
    monkeypatch.setattr(tables, "BUCKET_BYTES", 1 << 10)
    for k in range(3):
        upsert_table(table(spark, new[k::3]), path, COMPETITOR_SALES)
    assert len(files_of(path, 0)) == len(files_of(path, 1)) > 2
    assert rows(read_table(spark, path)) == brute_latest(old + new)


def test_an_open_reader_survives_a_write(spark, tmp_path):
    path = str(tmp_path / "table")
    old, new = random_rows(3, 100), random_rows(4, 50)
    write_table(table(spark, old), path, COMPETITOR_SALES, buckets=4)
    opened = read_table(spark, path)
    upsert_table(table(spark, new), path, COMPETITOR_SALES)
    assert rows(opened) == brute_latest(old)
    opened = read_table(spark, path)
    upsert_table(table(spark, old), path, COMPETITOR_SALES)
    assert rows(opened) == brute_latest(old + new)
    opened = read_table(spark, path)
    write_table(table(spark, new), path, COMPETITOR_SALES)
    assert rows(opened) == brute_latest(old + new)


@pytest.mark.parametrize("write", [write_table, lambda *a: upsert_table(*a)])
def test_a_write_that_fails_leaves_the_former_rows(spark, tmp_path, write):
    path = str(tmp_path / "table")
    old = random_rows(1, 100)
    write_table(table(spark, old), path, COMPETITOR_SALES)
    units = F.when(F.col("units") == 2, F.raise_error(F.lit("broken off")).cast("int")).otherwise(F.col("units"))
    broken = table(spark, random_rows(2, 200)).withColumn("units", units)
    with pytest.raises(Exception, match="broken off"):
        write(broken, path, COMPETITOR_SALES)
    assert rows(read_table(spark, path)) == brute_latest(old)
    upsert_table(table(spark, old), path, COMPETITOR_SALES)
    assert rows(read_table(spark, path)) == brute_latest(old)


def test_rows_of_a_write_that_was_not_pointed_to_do_not_come_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    old = random_rows(1, 60)
    write_table(table(spark, old), path, COMPETITOR_SALES, buckets=16)
    upsert_table(table(spark, old[:5]), path, COMPETITOR_SALES)
    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        m.setattr(tables, "_point_to", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        upsert_table(table(spark, [(f"ghost{k}", "i", 1, 1) for k in range(40)]), path, COMPETITOR_SALES)
    assert rows(read_table(spark, path)) == brute_latest(old)
    new = random_rows(5, 3)
    upsert_table(table(spark, new), path, COMPETITOR_SALES)
    assert rows(read_table(spark, path)) == brute_latest(old + new)
    upsert_table(table(spark, old), path, COMPETITOR_SALES)
    assert rows(read_table(spark, path)) == brute_latest(old + new)


def test_two_writers_are_told(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(table(spark, random_rows(1, 10)), path, COMPETITOR_SALES)
    with pytest.raises(RuntimeError, match="two writers"):
        tables._point_to(spark, path, tables._current(spark, path))


@pytest.mark.parametrize(
    "a, b, common",
    [
        ("int", "bigint", "bigint"),
        ("smallint", "float", "float"),
        ("int", "float", "double"),
        ("float", "double", "double"),
        ("bigint", "double", None),
        ("bigint", "decimal(22,2)", "decimal(22,2)"),
        ("bigint", "decimal(20,2)", "decimal(22,2)"),
        ("bigint", "decimal(38,30)", None),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("void", "date", "date"),
        ("date", "timestamp", None),
        ("string", "int", None),
        ("array<int>", "array<int>", "array<int>"),
    ],
)
def test_promotion(spark, a, b, common):
    def of(name):
        return spark.createDataFrame([], f"x {name}").schema[0].dataType

    for x, y in ((a, b), (b, a)):
        got = promoted(of(x), of(y))
        assert (got and got.simpleString()) == common


def test_top_n_ties_and_nulls(spark):
    data = [("g", f"i{n}", 5, n) for n in (3, 1, 2)] + [(None, "x", None, 1), (None, "y", 1, 1)]
    got = top_n_per_group(
        table(spark, data), ["seller_id"], [F.desc_nulls_last("sale_date"), F.asc("item_id")], 2
    )
    assert rows(got.select("seller_id", "item_id", "rank")) == sorted(
        [("g", "i1", 1), ("g", "i2", 2), (None, "y", 1), (None, "x", 2)], key=str
    )


def test_key_settings_of_the_table_format():
    assert _options(COMPETITOR_SALES, "parquet") == {}
    settings = _options(COMPETITOR_SALES, "hudi")
    assert settings["hoodie.datasource.write.recordkey.field"] == "seller_id,item_id"
    assert settings["hoodie.datasource.write.precombine.field"] == "sale_date"


def tasks_of(path, copy):
    return [os.path.basename(f).split("-")[1] for f in files_of(path, copy)]


def test_a_task_writes_one_bucket(spark, tmp_path):
    path = str(tmp_path / "table")
    old = random_rows(1, 400, 40)
    write_table(table(spark, old), path, COMPETITOR_SALES, buckets=16)
    assert len(set(tasks_of(path, 1))) == len(tasks_of(path, 1)) == 16
    upsert_table(table(spark, old[:1]), path, COMPETITOR_SALES)
    before = files_of(path, 1)
    new = random_rows(2, 12, 40)
    upsert_table(table(spark, new), path, COMPETITOR_SALES)
    written = [f for f, t in files_of(path, 1).items() if before.get(f) != t]
    assert 1 < len(written) == len({os.path.basename(f).split("-")[1] for f in written}) < 16
    assert rows(read_table(spark, path)) == brute_latest(old + new)


@pytest.mark.parametrize("first", [40, 0])
def test_buckets_follow_the_bytes_of_a_delivery_too(spark, tmp_path, monkeypatch, first):
    path = str(tmp_path / "table")
    every = spark.range(4000).selectExpr("string(id) seller_id", "'i' item_id", "1 sale_date", "int(id) units")
    every.write.parquet(f"{tmp_path}/every")
    every = spark.read.parquet(f"{tmp_path}/every")
    write_table(every.where(f"units < {first}"), path, COMPETITOR_SALES, buckets=1)
    monkeypatch.setattr(tables, "BUCKET_BYTES", 4 << 10)
    upsert_table(every, path, COMPETITOR_SALES)
    assert len(files_of(path, 0)) > 4
    assert read_table(spark, path).exceptAll(every).count() == 0 and read_table(spark, path).count() == 4000
