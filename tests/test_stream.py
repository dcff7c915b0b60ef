from __future__ import annotations

import json
import sqlite3

from dataclasses import replace

import pytest
from pyspark.sql import types as T

from tidemark.plans.state import StateLog, read_monitor
from tidemark.sources import files
from tidemark.sources.indexed import IndexedReader, indexed_stream
from tidemark.spec import SchemaMismatch, SourceSpec, SyncSpec
from tidemark.streaming import stream_sync
from tidemark.streaming.incremental import StreamSource, load_batch

SPEC = SyncSpec(SourceSpec("a", "db"), "arrivals", "arrivals", index_column="id", primary_key="id", buckets=2)
SCHEMA = "id bigint, v string"
SPARK_SCHEMA = T.StructType().add("id", "long").add("v", "string")


def rows(store):
    return sorted((r.id, r.v) for r in store.read(SPEC.target).collect())


def arrive(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_each_run_loads_what_is_new(spark, store):
    folder, checkpoint = f"{store.root}/in", f"{store.root}/checkpoint"
    arrive(spark, folder, [(1, "a"), (2, "é")])
    stream = StreamSource(folder, spark.read.parquet(folder).schema)
    stream_sync(spark, stream, SPEC, store, checkpoint)
    assert rows(store) == [(1, "a"), (2, "e")]
    arrive(spark, folder, [(2, "c"), (3, "d")])
    stream_sync(spark, stream, SPEC, store, checkpoint)
    assert rows(store) == [(1, "a"), (2, "c"), (3, "d")]
    run = store.latest(SPEC.target)
    stream_sync(spark, stream, SPEC, store, checkpoint)
    assert store.latest(SPEC.target) == run


def test_a_repeated_batch_is_loaded_once(spark, store):
    spec = replace(SPEC, append_only=True)
    batch = spark.createDataFrame([(1, "a")], SCHEMA)
    for number in (0, 0, 1, 1, 0):
        load_batch(spark, spec, store, batch, "s", number)
    assert rows(store) == [(1, "a"), (1, "a")]
    load_batch(spark, spec, store, batch, "another", 0)
    assert len(rows(store)) == 3


def test_a_key_is_needed(spark, store):
    with pytest.raises(SchemaMismatch):
        load_batch(spark, replace(SPEC, primary_key=()), store, spark.createDataFrame([(1, "a")], SCHEMA), "s", 0)


def test_a_path_without_files_is_an_error(spark, store):
    for source in (StreamSource(f"{store.root}/none", SPARK_SCHEMA), StreamSource(store.root, SPARK_SCHEMA, "no.parquet")):
        with pytest.raises(FileNotFoundError):
            stream_sync(spark, source, SPEC, store, f"{store.root}/checkpoint")


def test_a_table_may_be_a_file_or_a_folder(spark, store, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders.repartition(3).write.parquet(f"{store.root}/orders.parquet")
    spec = SyncSpec(SourceSpec("a", "db"), "o", "o", index_column="o_orderkey", primary_key="o_orderkey", buckets=2)
    for number, path in enumerate([f"{sf_dir}/orders.parquet", f"{store.root}/orders.parquet"]):
        own = replace(spec, target_table=f"o{number}")
        stream_sync(spark, StreamSource(path, orders.schema), own, store, f"{store.root}/checkpoint{number}")
        assert store.read(own.target).count() == orders.count()


def test_batches_leave_index_values_and_monitor_rows(spark, store):
    for number, ids in enumerate([(1, 2), (2, 5, 7)]):
        load_batch(spark, SPEC, store, spark.createDataFrame([(i, "v") for i in ids], SCHEMA), "s", number)
    log = StateLog(store).of(SPEC.state_key, SPEC.target).orderBy("created_ts").collect()
    assert [r.index_value for r in log] == ["2", "7"]
    assert sorted(r.row_count for r in read_monitor(store, "extract").collect()) == [2, 3]
    assert sorted((r.rows_inserted, r.rows_deleted) for r in read_monitor(store, "load").collect()) == [(2, 0), (3, 1)]


def test_a_stream_without_a_target_column_is_refused(spark, store):
    load_batch(spark, SPEC, store, spark.createDataFrame([(1, "a")], SCHEMA), "s", 0)
    with pytest.raises(SchemaMismatch, match="v"):
        load_batch(spark, SPEC, store, spark.createDataFrame([(2,)], "id bigint"), "s", 1)


INDEXED = "id long, v string"


def follow(spark, root, partitions=3):
    schema = spark.createDataFrame([], INDEXED).schema
    found = indexed_stream(spark, schema, "log", "id", "sqlite3", partitions, database=f"{root}/db")
    sink = found.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state")
    query = sink.trigger(availableNow=True).start()
    query.awaitTermination()
    loaded = spark.read.schema(schema).parquet(f"{root}/out") if files.holds(spark, f"{root}/out") else spark.createDataFrame([], schema)
    return sorted(map(tuple, loaded.collect()), key=str)


def test_a_stream_of_a_table_follows_its_index(spark, tmp_path):
    with sqlite3.connect(tmp_path / "db") as db:
        db.execute("CREATE TABLE log (id INTEGER, v TEXT)")
        assert follow(spark, tmp_path) == []
        db.executemany("INSERT INTO log VALUES (?, ?)", [(i, f"v{i}") for i in range(-5, 40)] + [(None, "never"), (7, "again")])
        db.commit()
        first = follow(spark, tmp_path)
        assert first == sorted([(i, f"v{i}") for i in range(-5, 40)] + [(7, "again")], key=str)
        assert follow(spark, tmp_path) == first
        # What lies below the newest value is not looked for again; what is above it is.
        db.executemany("INSERT INTO log VALUES (?, ?)", [(40, "x"), (41, None), (3, "late")])
        db.commit()
        assert follow(spark, tmp_path) == sorted([*first, (40, "x"), (41, None)], key=str)
    offsets = sorted(tmp_path.glob("state/offsets/[0-9]*"), key=lambda p: int(p.name))
    assert json.loads(offsets[-1].read_text().splitlines()[-1]) == {"index": "41"}


def test_a_stream_reads_the_windows_of_batch_runs(spark):
    schema = spark.createDataFrame([], INDEXED).schema
    reader = IndexedReader(schema, {"index": "id", "table": "t", "module": "sqlite3", "partitions": "4"})
    cut = reader.partitions({"index": "10"}, {"index": "50"})
    assert [(r.lower, r.upper) for r in cut] == [("10", "20"), ("20", "30"), ("30", "40"), ("40", "50")]
    assert reader.partitions({"index": "50"}, {"index": "50"}) == reader.partitions({"index": None}, {"index": None}) == []
    assert [(r.lower, r.upper) for r in reader.partitions({"index": "9"}, {"index": "10"})] == [("9", "10")]
    with pytest.raises(TypeError):
        IndexedReader(schema, {"index": "v"})


def test_a_stream_of_timestamps_cuts_its_window(spark):
    schema = spark.createDataFrame([], "t timestamp_ntz").schema
    reader = IndexedReader(schema, {"index": "t", "table": "t", "module": "sqlite3", "partitions": "2"})
    cut = reader.partitions({"index": "2024-01-01 00:00:00"}, {"index": "2024-01-03 00:00:00.5"})
    assert [(r.lower, r.upper) for r in cut] == [("2024-01-01 00:00:00", "2024-01-02 00:00:00.250000"), ("2024-01-02 00:00:00.250000", "2024-01-03 00:00:00.5")]
