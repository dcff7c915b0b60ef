from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shown import plan_text
from tidemark.operators.load import key_bounds, staged_keys, within
from tidemark.plans import tables
from tidemark.plans.state import StateLog
from tidemark.plans.sync import sync_table
from tidemark.plans.tables import BUCKET, WINDOW
from tidemark.sources import files
from tidemark.spec import SourceSpec, SyncSpec

SPEC = SyncSpec(SourceSpec("a", "db"), "published_source", "t", index_column="id", primary_key="id", buckets=8)
APPENDED = SyncSpec(SPEC.source, SPEC.source_table, "log", index_column="id", append_only=True)
MOVED = SyncSpec(SPEC.source, "moved_source", "m", index_column="id", primary_key="k", buckets=8)


def source(spark, ids):
    spark.createDataFrame([(i, f"v{i}") for i in ids], "id bigint, v string").createOrReplaceTempView("published_source")


def moved(spark, rows):
    spark.createDataFrame(rows, "id bigint, k bigint, v string").createOrReplaceTempView("moved_source")


def values(store, spec=SPEC):
    return sorted(r.id for r in store.read(spec.target).collect())


def urls(store, spec=SPEC):
    return {r["url"] for r in store.manifest(spec.target).collect()}


def partitions(spark, store, spec=SPEC):
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {store.name(spec.target)}").collect()}


def test_new_keys_leave_all_files_as_they_are(spark, store):
    source(spark, range(1000))
    sync_table(spark, SPEC, store)
    first = urls(store)
    assert partitions(spark, store) == {f"{BUCKET}={i}" for i in range(8)}
    source(spark, range(1100))
    result = sync_table(spark, SPEC, store)
    assert (result.rows_inserted, result.rows_deleted) == (100, 0)
    assert first < urls(store) and values(store) == list(range(1100))
    assert store.manifest(SPEC.target).agg({"row_count": "sum"}).first()[0] == 1100


def test_only_partitions_that_lose_a_row_are_overwritten(spark, store):
    moved(spark, [(1, k, "a") for k in range(1000)])
    sync_table(spark, MOVED, store)
    first = urls(store, MOVED)
    moved(spark, [(2, 5, "b"), (2, 2000, "b")])
    result = sync_table(spark, MOVED, store)
    assert (result.rows_inserted, result.rows_deleted) == (2, 1)
    gone = first - urls(store, MOVED)
    assert len({u.split(f"{BUCKET}=")[1].split("/")[0] for u in gone}) == 1
    got = {r.k: r.v for r in store.read(MOVED.target).collect()}
    assert len(got) == 1001 and got[5] == got[2000] == "b" and got[6] == "a"


def test_reads_by_key_prune_partitions(spark, store):
    source(spark, range(1000))
    sync_table(spark, SPEC, store)
    some = spark.createDataFrame([(17,), (5000,)], "id bigint")
    found = store.of_keys(SPEC.target, some)
    plan = plan_text(found)
    assert f"PartitionFilters: [{BUCKET}" in plan and " IN (" in plan.split("PartitionFilters: ")[1].split("\n")[0]
    assert [tuple(r) for r in found.collect()] == [(17, "v17")]


def test_a_load_reads_only_the_partitions_of_its_keys(spark, store, monkeypatch):
    moved(spark, [(1, k, "a") for k in range(1000)])
    sync_table(spark, MOVED, store)
    seen = []
    matching = tables.load.matching
    monkeypatch.setattr(tables.load, "matching", lambda rows, *a, **b: seen.append(plan_text(rows)) or matching(rows, *a, **b))
    moved(spark, [(2, 5, "b")])
    sync_table(spark, MOVED, store)
    assert seen and f"({BUCKET}#" in seen[0].split("PartitionFilters: ")[1].split("\n")[0]
    assert "ReadSchema: struct<k:bigint>" in seen[0]


def test_large_batches_are_joined_by_a_shuffle(spark, store, monkeypatch):
    monkeypatch.setattr(tables, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved(spark, [(1, k % 50, "a") for k in range(200)])
        sync_table(spark, MOVED, store)
        moved(spark, [(2, 7, "b")])
        result = sync_table(spark, MOVED, store)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (result.rows_inserted, result.rows_deleted) == (1, 4)
    assert store.read(MOVED.target).count() == 197


def test_compact(spark, store):
    for n in (50, 60, 70):
        source(spark, range(n))
        sync_table(spark, SPEC, store)
    before = len(urls(store))
    store.compact(SPEC.target)
    assert len(urls(store)) == len(partitions(spark, store)) < before and values(store) == list(range(70))


def test_a_scoped_refresh_overwrites_partitions_with_such_rows_and_drops_empty_ones(spark, store):
    source(spark, range(60))
    sync_table(spark, SPEC, store)
    first, base = urls(store), store.latest(SPEC.target)
    staged = spark.createDataFrame([(100, "new")], base.struct)
    assert store.replace_where(SPEC.target, store.new_run_id(SPEC.target), staged, F.expr("id = 55")) == 1
    assert len({u.split(f"{BUCKET}=")[1].split("/")[0] for u in first - urls(store)}) == 1
    assert values(store) == [i for i in range(60) if i != 55] + [100]
    bucket = store._whole(SPEC.target).where("id = 7").first()[BUCKET]
    whole = store._whole(SPEC.target).where(F.col(BUCKET) == bucket)
    ids = [r.id for r in whole.collect()]
    none = staged.limit(0)
    assert store.replace_where(SPEC.target, store.new_run_id(SPEC.target), none, F.col("id").isin(ids)) == len(ids)
    assert f"{BUCKET}={bucket}" not in partitions(spark, store)
    assert values(store) == sorted({*range(60), 100} - {55, *ids})


def test_a_scoped_refresh_of_a_target_without_a_key(spark, store):
    for n in (5, 9):
        source(spark, range(n))
        sync_table(spark, APPENDED, store)
    staged = spark.createDataFrame([(70, "x"), (71, "y")], store.latest(APPENDED.target).struct)
    lost = store.replace_where(APPENDED.target, store.new_run_id(APPENDED.target), staged, F.expr("id < 6"), "scope")
    assert lost == 6 and values(store, APPENDED) == [6, 7, 8, 70, 71]
    assert partitions(spark, store, APPENDED) == {f"{WINDOW}=4", f"{WINDOW}=scope"}


def test_partition_columns_are_not_in_the_table(spark, store):
    source(spark, range(3))
    sync_table(spark, SPEC, store)
    sync_table(spark, APPENDED, store)
    assert store.read(SPEC.target).columns == store.read(APPENDED.target).columns == ["id", "v"]


@pytest.mark.parametrize("spec", [SPEC, APPENDED, replace(SPEC, full_refresh=True, primary_key=None)])
def test_a_run_that_dies_before_its_index_value_is_logged_is_repeated(spark, store, monkeypatch, spec):
    source(spark, range(10))
    sync_table(spark, spec, store)

    def die(*args):
        raise RuntimeError("power cut")

    for last in (15, 20):
        source(spark, range(last))
        with monkeypatch.context() as m:
            m.setattr(StateLog, "add", die)
            with pytest.raises(RuntimeError):
                sync_table(spark, spec, store)
    source(spark, range(25))
    assert sync_table(spark, spec, store).new_index_value == "24"
    assert values(store, spec) == list(range(25))
    assert StateLog(store).rows().count() == 2


def test_a_first_run_that_dies_is_repeated(spark, store, monkeypatch):
    source(spark, range(10))
    for spec in (SPEC, APPENDED):
        with monkeypatch.context() as m:
            m.setattr(StateLog, "add", lambda *args: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                sync_table(spark, spec, store)
        sync_table(spark, spec, store)
        assert values(store, spec) == list(range(10))


def test_nothing_stays_beside_the_target(spark, store):
    source(spark, range(10))
    unsized = replace(SPEC, buckets=None)
    for spec in (SPEC, unsized, APPENDED):
        sync_table(spark, spec, store)
        assert files.names(spark, f"{store.root}/_stage/{spec.target}") == []
        assert not store.exists(f"{spec.target}__new")


def test_run_ids_grow_even_if_the_clock_does_not(spark, store):
    ids = []
    for n in (3, 6):
        source(spark, range(n))
        sync_table(spark, SPEC, store, now=datetime(2024, 1, 9 - n))
        ids.append(store.latest(SPEC.target).run_id)
    assert ids == sorted(ids) and ids[0] != ids[1]
    assert StateLog(store).bounds(SPEC.state_key, SPEC.target, 1) == ("5", "2")


def test_the_number_of_buckets_follows_the_size_of_the_first_load(spark, store):
    small = tables.TargetStore(spark, store.root, bucket_bytes=2000)
    source(spark, range(3000))
    sync_table(spark, replace(SPEC, buckets=None), small)
    assert small.latest(SPEC.target).buckets > 3 and values(small) == list(range(3000))


def test_append_then_upsert_rewrites_into_buckets(spark, store):
    appended = replace(APPENDED, target_table="t")
    source(spark, range(5))
    sync_table(spark, appended, store)
    source(spark, range(8))
    sync_table(spark, SPEC, store)
    assert store.latest(SPEC.target).buckets == 8 and values(store) == list(range(8))
    source(spark, range(9))
    assert sync_table(spark, appended, store).rows_inserted == 1
    assert values(store) == list(range(9)) and all(p.startswith(BUCKET) for p in partitions(spark, store))


def test_key_range_reaches_the_scan(spark, store):
    rows = [(i, f"v{i:03d}", datetime(2024, 1, 1 + i % 9), b"x", i > 3) for i in range(100)]
    schema = "id bigint, v string, t timestamp_ntz, b binary, k boolean"
    spark.createDataFrame(rows, schema).write.parquet(f"{store.root}/rows")
    live = spark.read.parquet(f"{store.root}/rows")
    keys = live.where("id BETWEEN 40 AND 50")
    names = ["id", "v", "t", "b", "k"]
    found = within(live, key_bounds(keys, names).first(), names)
    plan = plan_text(found)
    assert "GreaterThanOrEqual(id,40), LessThanOrEqual(id,50), GreaterThanOrEqual(v,v040), LessThanOrEqual(v,v050)" in plan
    assert "GreaterThanOrEqual(t,2024-01-01T00:00)" in plan
    assert found.count() == 11


def test_null_and_duplicate_keys_in_a_published_upsert(spark, store):
    schema = "id bigint, k string, v string"
    spec = SyncSpec(SourceSpec("a", "db"), "nk", "nk", index_column="id", primary_key="k", buckets=4)
    spark.createDataFrame([(1, None, "a"), (1, "x", "b"), (1, "y", "c")], schema).createOrReplaceTempView("nk")
    sync_table(spark, spec, store)
    batch = [(2, None, "d"), (2, "x", "e"), (2, "x", "f")]
    spark.createDataFrame(batch, schema).createOrReplaceTempView("nk")
    result = sync_table(spark, spec, store)
    assert (result.rows_inserted, result.rows_deleted) == (3, 1)
    got = sorted((r.k or "", r.v) for r in store.read(spec.target).collect())
    assert got == [("", "a"), ("", "d"), ("x", "e"), ("x", "f"), ("y", "c")]


def test_staged_keys_are_complete_and_distinct(spark):
    frame = spark.createDataFrame([(1, 1), (1, 1), (None, 2), (2, None)], "a int, b int")
    assert [tuple(r) for r in staged_keys(frame, ["a", "b"]).collect()] == [(1, 1)]
