"""Work that grows with the load and not with what was loaded before."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallylake.operators import keyed_table, profile, reload, seen_keys
from tallylake.plans import history, marts
from tallylake.schema import BUSINESS_KEY
from tallylake.sources import storage

from samples import MOVEMENT, movements

ITEM = "id int, region string, at int, name string"


def items(spark, rows):
    return spark.createDataFrame(rows, ITEM)


def files_of(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("part-*.parquet")}


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, "n", 1, f"item {i}") for i in range(400)] + [(None, None, 1, "no key")]
    keyed_table.create(items(spark, rows), path, ["id", "region"], ["at"], buckets=32)
    before = files_of(path)
    batch = [(3, "n", 2, "newer"), (3, "n", 1, "of the batch, but older"), (5, "n", 0, "stale"),
             (7, "n", 1, "same version"), (900, "n", 1, "new"), (None, None, 2, "still no key")]
    touched = keyed_table.merge(spark, path, items(spark, batch))
    after = files_of(path)
    assert 1 <= len(touched) <= 5
    for name, time in before.items():
        bucket = int(name.split(f"{keyed_table.BUCKET}=")[1].split("/")[0])
        assert (after.get(name) == time) == (bucket not in touched)
    got = {(r.id, r.region): (r.at, r.name) for r in keyed_table.read(spark, path).collect()}
    want = {(i, "n"): (1, f"item {i}") for i in range(400)}
    want |= {(3, "n"): (2, "newer"), (7, "n"): (1, "same version"), (900, "n"): (1, "new"), (None, None): (2, "still no key")}
    assert got == want
    again = keyed_table.merge(spark, path, items(spark, batch))
    assert again == touched
    assert {(r.id, r.region): (r.at, r.name) for r in keyed_table.read(spark, path).collect()} == want
    assert keyed_table.merge(spark, path, items(spark, [])) == []


def test_merges_equal_one_upsert(spark, tmp_path):
    rng = random.Random(2)
    loads = [
        [(rng.choice((None, *range(30))), rng.choice((None, "a", "")), rng.choice((None, 1, 2, 3)), f"{k}-{i}") for i in range(60)]
        for k in range(3)
    ]
    path = str(tmp_path / "t")
    key, version = ["id", "region"], ["at"]
    keyed_table.create(items(spark, loads[0]), path, key, version, buckets=4)
    want = reload.latest_per_key(items(spark, loads[0]), key, version)
    for load in loads[1:]:
        keyed_table.merge(spark, path, items(spark, load))
        want = reload.upsert(want, items(spark, load), key, version)
    assert sorted(map(str, keyed_table.read(spark, path).collect())) == sorted(map(str, want.collect()))


def test_merge_reads_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed_table.create(items(spark, [(i, "n", 1, "x") for i in range(50)]), path, ["id"], ["at"], 8)
    meta = keyed_table._meta(spark, path)
    held = keyed_table._stored(spark, path, meta).where(F.col(keyed_table.BUCKET).isin([2, 5]))
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and keyed_table.BUCKET in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(FileExistsError):
        storage.write_once(spark, "{}", f"{path}/_buckets.json")


def test_bitmap_loses_no_key(spark, monkeypatch):
    monkeypatch.setattr(seen_keys, "SLOTS", 2)
    df = spark.range(5000).selectExpr("id as a", "if(id % 7 = 0, null, cast(id as string)) as b")
    wanted = df.where("a % 50 = 0")
    bits = seen_keys.bitmap(wanted, ["a", "b"])
    found = {r.a for r in seen_keys.maybe_in(df, bits, ["a", "b"]).collect()}
    assert bits.count() <= 2
    assert found >= {i for i in range(0, 5000, 50)} and len(found) < 300


def test_loads_equal_one_load(spark, tmp_path):
    rng = random.Random(4)

    def some(first):
        return [
            (first + i, rng.choice((None, "1.00", "2.00")), rng.choice((None, "", "a")), rng.choice((None, "2024-01-01")), rng.choice((None, 1, 2, 3)))
            for i in range(40)
        ]

    loads = [some(0), some(100), [], some(200)]
    index, target = str(tmp_path / "index"), str(tmp_path / "rows")
    for number, load in enumerate(loads):
        seen_keys.load(movements(spark, load), f"l{number}", index, target, BUSINESS_KEY, buckets=4)
    first = files_of(f"{target}/carga=l0")
    seen_keys.load(movements(spark, loads[3]), "l3", index, target, BUSINESS_KEY, buckets=4)
    assert files_of(f"{target}/carga=l0") == first
    want = reload.first_per_key(movements(spark, sum(loads, [])), BUSINESS_KEY)
    got = seen_keys.read(spark, target).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_report_of_loads_reads_the_states_only(spark, tmp_path):
    rng = random.Random(6)
    rows = [
        (i, rng.choice((None, "-1.00", "0.00", "5.00")), rng.choice((None, "a")), "2024-01-01", rng.choice((None, 1, 2)))
        for i in range(90)
    ]
    path, raw = str(tmp_path / "states"), str(tmp_path / "raw")
    for number in range(3):
        movements(spark, rows[number::3]).write.parquet(f"{raw}/{number}")
        load = spark.read.parquet(f"{raw}/{number}")
        history.record_load(load, f"l{number}", path, BUSINESS_KEY)
    storage.remove(spark, f"{raw}/0")
    storage.remove(spark, f"{raw}/1")  # only the last load is still there
    history.record_load(spark.read.parquet(f"{raw}/2"), "l2", path, BUSINESS_KEY)
    columns = [f.name for f in spark.createDataFrame([], MOVEMENT).schema]
    merged = history.profile_of_loads(spark, path, columns, BUSINESS_KEY)
    whole = profile.measure(movements(spark, rows), BUSINESS_KEY)
    assert merged.counts.first() == whole.counts.first()
    assert merged.document() == whole.document()


@pytest.mark.parametrize("kind", ["int", "bigint", "string"])
def test_distinct_values(spark, kind):
    values = [None, None, 0, -1, -32768, -32769, 1, 32768, 32769, 2**31 - 1, 5, 5]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").select(F.col("v").cast(kind))
    assert marts.distinct_values(df.repartition(3), "v").first().n == 10
    assert marts.distinct_values(df.where("v = 5"), "v").first().n == 1
    assert marts.distinct_values(df.limit(0), "v").first().n == 0
