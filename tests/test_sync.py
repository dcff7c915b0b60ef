from __future__ import annotations

from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans.state import StateLog, read_monitor
from tidemark.plans.sync import InvalidSpecs, plan_sync, results_frame, sync_all, sync_table
from tidemark.spec import SchemaMismatch, SourceSpec, SpecError, SyncSpec

T0 = datetime(2019, 1, 1)
T1, T2, T3 = (T0 + timedelta(seconds=s) for s in (5, 10, 15))
TMIN = datetime.min

PG = SourceSpec("pgtest", "test_db")
BASIC = SyncSpec(
    PG, "test_basic", "test_basic", "sync_test", index_column="updated_at", primary_key="pk", columns_to_drop=("drop1",),
    distribution_key="pk", sort_keys=("updated_at",), buckets=3,
)
SCHEMA = "pk int, updated_at timestamp_ntz, drop1 string, value1 int, enum_value string"
FIRST = [(1, T0, "value", 0, "a"), (2, T1, "value", 1, "b")]


def source(spark, rows, schema=SCHEMA, name="test_basic"):
    spark.createDataFrame(rows, schema).createOrReplaceTempView(name)


def target(store, spec=BASIC):
    return sorted(tuple(r) for r in store.read(spec.target).collect())


def logged(store, spec=BASIC):
    rows = StateLog(store).of(spec.state_key, spec.target).orderBy("created_ts").collect()
    assert {(r.datastore_name, r.database_name, r.table_name) for r in rows} <= {spec.state_key}
    return [r.index_value for r in rows]


def text(*stamps):
    return [s.strftime("%Y-%m-%d %H:%M:%S.%f") for s in stamps]


def test_incremental(spark, store):
    source(spark, FIRST)
    first = sync_table(spark, BASIC, store)
    assert (first.status, first.target_status, first.rows_inserted, first.rows_deleted) == ("loaded", "non-existent", 2, 0)
    assert target(store) == [(1, T0, 0, "a"), (2, T1, 1, "b")]

    source(spark, [FIRST[0], (2, T2, "value", 2, "b"), (3, T2, "drop", 3, "c")])
    second = sync_table(spark, BASIC, store)
    assert (second.old_index_value, second.new_index_value) == tuple(text(T1, T2))
    assert (second.rows_extracted, second.rows_inserted, second.rows_deleted) == (2, 2, 1)
    assert target(store) == [(1, T0, 0, "a"), (2, T2, 2, "b"), (3, T2, 3, "c")]
    assert logged(store) == text(T1, T2)


def test_forced_refresh_then_incremental(spark, store):
    source(spark, FIRST)
    sync_table(spark, BASIC, store)
    source(spark, [FIRST[1], (3, T2, "drop", 3, "c")])
    result = sync_table(spark, BASIC, store, full_refresh=True)
    assert (result.old_index_value, result.rows_deleted) == (None, 2)
    assert target(store) == [(2, T1, 1, "b"), (3, T2, 3, "c")]
    assert logged(store) == text(T1, T2)

    source(spark, [FIRST[0], (2, T3, "value", 2, "b"), (3, T2, "drop", 3, "c")])
    sync_table(spark, BASIC, store)
    assert target(store) == [(2, T3, 2, "b"), (3, T2, 3, "c")]
    assert logged(store) == text(T1, T2, T3)


def test_new_source_column_then_rebuild(spark, store):
    source(spark, FIRST)
    sync_table(spark, BASIC, store)
    wider = [(*r, "default") for r in FIRST] + [(3, T2, "drop", 3, "c", "other")]
    source(spark, wider, SCHEMA + ", new_value string")
    assert sync_table(spark, BASIC, store).target_status == "ok"
    assert target(store)[2] == (3, T2, 3, "c")
    result = sync_table(spark, BASIC, store, rebuild=True)
    assert (result.target_status, result.rows_deleted, result.rows_inserted) == ("rebuild", 0, 3)
    assert target(store) == [(1, T0, 0, "a", "default"), (2, T1, 1, "b", "default"), (3, T2, 3, "c", "other")]
    assert logged(store) == text(T1, T2, T2)


def test_extra_target_column_skips_the_table(spark, store):
    source(spark, FIRST)
    sync_table(spark, BASIC, store)
    source(spark, [(1, T0, "v", 0), (3, T2, "drop", 3)], "pk int, updated_at timestamp_ntz, drop1 string, value1 int")
    with pytest.raises(SchemaMismatch):
        sync_table(spark, BASIC, store)
    results = sync_all(spark, [BASIC], store)
    assert [(r.status, "enum_value" in r.error) for r in results] == [("skipped", True)]
    assert len(target(store)) == 2 and logged(store) == text(T1)


def test_case_is_kept(spark, store):
    source(spark, [(1, T0, "citext1"), (2, T1, "Citext2")], "pk int, updated_at timestamp_ntz, c string")
    spec = replace(BASIC, columns_to_drop=())
    sync_table(spark, spec, store)
    assert target(store) == [(1, T0, "citext1"), (2, T1, "Citext2")]


def test_zero_dates(spark, store):
    schema = "pk bigint, updated_at timestamp_ntz, default_dt string, null_dt string"
    source(spark, [(1, T0, str(T1), str(T1)), (2, T0, "0000-00-00 00:00:00", ""), (3, T1, None, None)], schema, "zero")
    spec = SyncSpec(
        PG, "zero", "zero", index_column="updated_at", primary_key="pk",
        not_null_date={"default_dt": "timestamp_ntz", "null_dt": "timestamp_ntz"},
    )
    sync_table(spark, spec, store)
    assert sorted(r[2:] for r in target(store, spec)[:2]) == [(TMIN, TMIN), (T1, T1)]
    assert target(store, spec)[2][2:] == (None, None)


def test_index_sql_append_only_loads_everything_again(spark, store):
    schema = "id bigint, created_at timestamp_ntz, deleted_at timestamp_ntz"
    spec = SyncSpec(
        PG, "appended", "appended", append_only=True,
        index_sql="SELECT CASE WHEN deleted_at IS NOT NULL THEN greatest(created_at, deleted_at) END AS index_value "
        "FROM appended ORDER BY id, created_at",
    )
    first = [(1, T0, None), (2, T0, None)]
    source(spark, first, schema, "appended")
    assert sync_table(spark, spec, store).new_index_value is None
    source(spark, [first[0], (2, T0, T1), (3, T1, None)], schema, "appended")
    sync_table(spark, spec, store)
    got = Counter(tuple(r) for r in store.read(spec.target).collect())
    assert got == Counter(first) + Counter([(1, T0, None), (2, T0, T1), (3, T1, None)])
    assert logged(store, spec) == []


def test_append_by_index_column(spark, store):
    spec = SyncSpec(PG, "log", "log", index_column="id", append_only=True)
    source(spark, [(1, "a"), (2, "b"), (None, "never")], "id bigint, v string", "log")
    sync_table(spark, spec, store)
    source(spark, [(1, "a"), (2, "b"), (2, "late"), (3, "c")], "id bigint, v string", "log")
    result = sync_table(spark, spec, store)
    assert (result.rows_inserted, result.rows_deleted) == (1, 0)
    assert target(store, spec) == [(1, "a"), (2, "b"), (3, "c")]
    windows = spark.sql(f"SHOW PARTITIONS {store.name(spec.target)}").collect()
    assert sorted(r[0] for r in windows) == ["_window=2", "_window=first"]


def test_lookback_picks_up_late_rows(spark, store):
    spec = SyncSpec(PG, "late", "late", index_column="id", primary_key="k", lookback=1)
    seen = []
    for upto in (10, 20, 30):
        seen.append(upto)
        source(spark, [(i, f"v{i}") for i in seen], "id bigint, k string", "late")
        sync_table(spark, spec, store)
    source(spark, [(i, f"v{i}") for i in (10, 20, 25, 30, 40)], "id bigint, k string", "late")
    sync_table(spark, spec, store)
    assert [r[0] for r in target(store, spec)] == [10, 20, 25, 30, 40]
    plain = replace(spec, lookback=0)
    source(spark, [(i, f"v{i}") for i in (10, 20, 25, 30, 35, 40)], "id bigint, k string", "late")
    assert sync_table(spark, plain, store).status == "empty"


def test_empty_extract_publishes_nothing(spark, store):
    source(spark, FIRST)
    sync_table(spark, BASIC, store)
    before = store.latest(BASIC.target)
    source(spark, [])
    for forced in ({}, {"full_refresh": True}, {"rebuild": True}):
        assert sync_table(spark, BASIC, store, **forced).status == "empty"
    assert store.latest(BASIC.target) == before and len(target(store)) == 2 and len(logged(store)) == 1
    emptied = replace(BASIC, allow_empty_refresh=True)
    assert sync_table(spark, emptied, store, full_refresh=True).status == "loaded"
    assert target(store) == []


def test_empty_first_load_creates_the_table(spark, store):
    source(spark, [])
    result = sync_table(spark, BASIC, store)
    assert (result.status, result.target_status) == ("empty", "non-existent")
    assert store.read(BASIC.target).columns == ["pk", "updated_at", "value1", "enum_value"]
    assert logged(store) == []
    source(spark, FIRST)
    assert sync_table(spark, BASIC, store).rows_inserted == 2


def test_upsert_without_a_key_is_refused(spark, store):
    source(spark, FIRST)
    with pytest.raises(SchemaMismatch):
        sync_table(spark, replace(BASIC, primary_key=()), store)


def test_index_of_another_type_is_refused_before_the_load(spark, store):
    source(spark, FIRST)
    with pytest.raises(TypeError):
        sync_table(spark, replace(BASIC, index_column="enum_value"), store)
    assert not store.exists(BASIC.target)


def test_query_file_with_its_own_window(spark, store, tmp_path):
    text_file = tmp_path / "q.sql"
    text_file.write_text(
        "SELECT id, upper(v) AS v, :table_tag AS tag FROM queried\n"
        "WHERE id > coalesce(CAST(:run_old_index_value AS BIGINT), -1) AND id <= CAST(:run_new_index_value AS BIGINT);\n"
    )
    spec = SyncSpec(
        PG, "queried", "queried", query_file=str(text_file), index_sql="SELECT max(id) AS index_value FROM queried",
        primary_key="id", data={"tag": "t"},
    )
    source(spark, [(1, "a"), (2, "b")], "id bigint, v string", "queried")
    sync_table(spark, spec, store)
    source(spark, [(1, "changed"), (2, "b"), (3, "c")], "id bigint, v string", "queried")
    result = sync_table(spark, spec, store)
    assert (result.old_index_value, result.new_index_value, result.rows_extracted) == ("2", "3", 1)
    assert target(store, spec) == [(1, "A", "t"), (2, "B", "t"), (3, "C", "t")]


def test_query_file_without_a_new_value_reads_zero(spark, store, tmp_path):
    text_file = tmp_path / "q.sql"
    text_file.write_text("SELECT id, CAST(:run_new_index_value AS BIGINT) AS seen FROM queried0")
    spec = SyncSpec(
        PG, "queried0", "queried0", query_file=str(text_file), primary_key="id",
        index_sql="SELECT max(id) AS index_value FROM queried0 WHERE id > 100",
    )
    source(spark, [(1,)], "id bigint", "queried0")
    sync_table(spark, spec, store)
    assert target(store, spec) == [(1, 0)] and logged(store, spec) == ["0"]


def test_scoped_refresh_of_a_shared_target(spark, store, tmp_path):
    """Two sources feed one table; each refreshes its own rows only."""
    truncate, query = tmp_path / "t.sql", tmp_path / "q.sql"
    truncate.write_text("DELETE FROM shared WHERE site = :db_site;")
    query.write_text("SELECT id, :db_site AS site FROM shared_source")
    specs = [
        SyncSpec(
            SourceSpec(site, "db", data={"site": site}), "shared_source", "shared", full_refresh=True,
            query_file=str(query), truncate_file=str(truncate),
        )
        for site in ("north", "south")
    ]
    source(spark, [(1,), (2,)], "id bigint", "shared_source")
    assert [r.status for r in sync_all(spark, specs, store)] == ["loaded", "loaded"]
    source(spark, [(9,)], "id bigint", "shared_source")
    result = sync_table(spark, specs[0], store)
    assert (result.rows_deleted, result.rows_inserted) == (2, 1)
    assert target(store, specs[0]) == [(1, "south"), (2, "south"), (9, "north")]


def test_schema_file(spark, store, tmp_path):
    ddl = tmp_path / "s.sql"
    ddl.write_text("CREATE TABLE sync_test.typed (\n id BIGINT NOT NULL COMMENT 'the key',\n price DECIMAL(9,2),\n note STRING\n);\n")
    spec = SyncSpec(PG, "typed", "typed", index_column="id", primary_key="id", schema_file=str(ddl))
    source(spark, [(1, 1.239, "é"), (2, None, None)], "id bigint, price double, note string", "typed")
    sync_table(spark, spec, store)
    schema = store.read(spec.target).schema
    assert schema["price"].dataType.simpleString() == "decimal(9,2)"
    assert store.latest(spec.target).struct["id"].metadata == {"comment": "the key"}
    assert [str(r.price) for r in store.read(spec.target).orderBy("id").collect()] == ["1.24", "None"]


def test_not_null_is_enforced(spark, store, tmp_path):
    ddl = tmp_path / "s.sql"
    ddl.write_text("id BIGINT, v STRING NOT NULL")
    spec = SyncSpec(PG, "strict", "strict", index_column="id", primary_key="id", schema_file=str(ddl))
    source(spark, [(1, "a"), (2, None)], "id bigint, v string", "strict")
    results = sync_all(spark, [spec], store)
    assert results[0].status == "failed" and "NULL in v" in results[0].error
    assert not store.exists(spec.target)


def test_comments_and_overrides(spark, store):
    comment = "it's quoted"
    frame = spark.createDataFrame([(1, "long text", 1.5)], "pk int, v string, d double")
    frame.withMetadata("v", {"comment": comment}).createOrReplaceTempView("commented")
    spec = SyncSpec(
        PG, "commented", "commented", index_column="pk", primary_key="pk",
        type_map={"columns": {"v": "varchar(4)"}, "double": "decimal(5,1)"},
    )
    sync_table(spark, spec, store)
    schema = store.latest(spec.target).struct
    assert schema["v"].metadata == {"comment": comment, "width": 4}
    assert tuple(store.read(spec.target).first())[1] == "long"
    plain = replace(spec, target_table="plain", include_comments=False)
    sync_table(spark, plain, store)
    assert "comment" not in store.latest(plain.target).struct["v"].metadata


def test_many_tables(spark, store):
    source(spark, FIRST)
    source(spark, [(1, "a")], "id bigint, v string", "other")
    specs = [
        BASIC,
        SyncSpec(PG, "other", "other", full_refresh=True),
        SyncSpec(PG, "no_such_table", "x", full_refresh=True),
        SyncSpec(PG, "other", "off", full_refresh=True, enabled=False),
        SyncSpec(PG, "other", "bad"),
    ]
    with pytest.raises(InvalidSpecs) as e:
        sync_all(spark, specs, store)
    assert [r.status for r in e.value.results] == ["loaded", "loaded", "failed", "invalid"]
    frame = results_frame(spark, e.value.results)
    assert frame.where("status = 'loaded'").agg(F.sum("rows_inserted")).first()[0] == 3
    named = sync_all(spark, specs[:4], store, only=["other"])
    assert [r.target for r in named] == ["public.other", "public.off"]


def test_unknown_trouble_stops_the_source_only(spark, store, monkeypatch):
    import tidemark.plans.sync as module

    def broken(*args, **kwargs):
        raise RuntimeError("disk")

    source(spark, FIRST)
    other = replace(BASIC, source=SourceSpec("second", "db"), target_table="second")
    real = module.sync_table
    monkeypatch.setattr(module, "sync_table", lambda s, spec, *a: broken() if spec is BASIC else real(s, spec, *a))
    results = module.sync_all(spark, [BASIC, replace(BASIC, target_table="more"), other], store)
    assert [r.status for r in results] == ["aborted", "aborted", "loaded"]


def test_rebuild_rules_hold_at_run_time(spark, store):
    source(spark, FIRST)
    with pytest.raises(SpecError):
        sync_table(spark, replace(BASIC, truncate_file="x"), store, rebuild=True)


def test_monitors(spark, store):
    source(spark, FIRST)
    sync_table(spark, BASIC, store)
    sync_table(spark, BASIC, store)
    extracts = read_monitor(store, "extract").orderBy("created_at").collect()
    loads = read_monitor(store, "load").collect()
    assert [(r.row_count, r.output_exists) for r in extracts] == [(2, True), (0, False)]
    assert [(r.rows_inserted, r.rows_deleted, r.target_table) for r in loads] == [(2, 0, "sync_test.test_basic")]
    assert loads[0].task_id == "SyncTable(alias=pgtest, database=test_db, table=test_basic)"
    assert loads[0].load_size == extracts[0].upload_size > 0
    sync_table(spark, BASIC, store, full_refresh=True, monitor=False)
    assert read_monitor(store, "load").count() == 1


def test_plan(spark, store):
    source(spark, FIRST)
    specs = [BASIC, replace(BASIC, index_column=None)]
    before = plan_sync(spark, specs, store).collect()
    assert (before[0].status, before[0].new_index_value, before[0].old_index_value) == ("non-existent", *text(T1), None)
    assert "value1 INT" in before[0].create_columns and before[0].layout == "distkey(pk)\nsortkey(updated_at)"
    assert before[1].conflict == "incremental without index"
    sync_table(spark, BASIC, store)
    after = plan_sync(spark, [BASIC], store).first()
    assert (after.status, after.old_index_value, after.create_columns) == ("ok", *text(T1), None)


def test_state_keys_with_odd_names(spark, store):
    source(spark, FIRST)
    spec = replace(BASIC, source=SourceSpec("a/b=c", "d b%"), target_table="odd")
    sync_table(spark, spec, store)
    assert logged(store, spec) == text(T1)
    rows = StateLog(store).rows().collect()
    assert [(r.datastore_name, r.database_name) for r in rows] == [("a/b=c", "d b%")]


def test_index_that_went_back_is_reported_and_read(spark, store, caplog):
    source(spark, [(1, T3, "v", 0, "a")])
    sync_table(spark, BASIC, store)
    source(spark, [(1, T1, "v", 5, "a")])
    result = sync_table(spark, BASIC, store)
    assert (result.status, result.new_index_value) == ("empty", text(T1)[0])
    assert "does not follow" in caplog.text


def test_straight_loads_leave_no_staging(spark, store):
    from tidemark.sources import files

    source(spark, FIRST)
    for spec in (BASIC, replace(BASIC, target_table="whole", primary_key=(), index_column=None, full_refresh=True)):
        sync_table(spark, spec, store)
        sync_table(spark, replace(spec, append_only=False), store, full_refresh=True)
    assert files.names(spark, f"{store.root}/_stage/{BASIC.target}") == []


def test_failed_not_null_leaves_the_old_version(spark, store, tmp_path):
    ddl = tmp_path / "s.sql"
    ddl.write_text("id BIGINT, v STRING NOT NULL")
    spec = SyncSpec(PG, "strict2", "strict2", index_column="id", append_only=True, schema_file=str(ddl))
    source(spark, [(1, "a")], "id bigint, v string", "strict2")
    sync_table(spark, spec, store)
    source(spark, [(1, "a"), (2, None)], "id bigint, v string", "strict2")
    assert [r.status for r in sync_all(spark, [spec], store)] == ["failed"]
    assert target(store, spec) == [(1, "a")] and logged(store, spec) == ["1"]


def test_dropped_index_column(spark, store):
    source(spark, FIRST)
    spec = replace(BASIC, columns_to_drop=("drop1", "updated_at"), sort_keys=(), target_table="no_index")
    sync_table(spark, spec, store)
    source(spark, [*FIRST, (3, T2, "x", 3, "c")])
    assert sync_table(spark, spec, store).rows_inserted == 1
    assert target(store, spec) == [(1, 0, "a"), (2, 1, "b"), (3, 3, "c")]


def test_table_comment(spark, store):
    spark.sql("CREATE TABLE noted (id BIGINT COMMENT 'c1') USING parquet COMMENT 'about notes'")
    try:
        spark.sql("INSERT INTO noted VALUES (1)")
        spec = SyncSpec(PG, "noted", "noted", index_column="id", primary_key="id")
        sync_table(spark, spec, store)
        version = store.latest(spec.target)
        assert version.comment == "about notes" and version.struct["id"].metadata["comment"] == "c1"
        store.create_view(spec.target, "noted_view")
        assert spark.sql("SELECT count(*) FROM noted_view").first()[0] == 1
    finally:
        spark.sql("DROP TABLE noted")


def test_query_file_with_an_index_column(spark, store, tmp_path):
    text_file = tmp_path / "q.sql"
    text_file.write_text("SELECT id FROM qi WHERE id <= CAST(:run_new_index_value AS BIGINT)")
    spec = SyncSpec(PG, "qi", "qi", query_file=str(text_file), index_column="id", primary_key="id")
    source(spark, [(1,), (4,)], "id bigint", "qi")
    assert sync_table(spark, spec, store).new_index_value == "4"
    assert target(store, spec) == [(1,), (4,)]


def test_text_is_cut_where_the_spec_says_and_counted(spark, store):
    rows = [(1, "abcdef", "x"), (2, "abc", None), (3, "äbcdefg", "yyyy"), (4, None, "yyy")]
    spark.createDataFrame(rows, "id bigint, v string, w string").createOrReplaceTempView("cut_source")
    spec = SyncSpec(SourceSpec("a", "db"), "cut_source", "cut", index_column="id", primary_key="id", max_text=3)
    sync_table(spark, spec, store)
    got = sorted(tuple(r) for r in store.read(spec.target).collect())
    assert got == [(1, "abc", "x"), (2, "abc", None), (3, "abc", "yyy"), (4, None, "yyy")]
    assert [r.task_other_params for r in read_monitor(store, "extract").collect()] == ['{"cut_values": 3}']
    whole = replace(spec, target_table="whole", max_text=None)
    sync_table(spark, whole, store)
    assert {r.v for r in store.read(whole.target).collect()} == {"abcdef", "abc", "abcdefg", None}


def test_sources_of_one_target_do_not_meet(spark, store):
    def run(alias, ids, **asked):
        spark.createDataFrame([(i, f"{alias}{i}") for i in ids], "id bigint, v string").createOrReplaceTempView(f"merge_{alias}")
        source = SourceSpec(alias, "db")
        spec = SyncSpec(source, f"merge_{alias}", "merged", index_column="id", primary_key="id", alias_column="who", buckets=2)
        return sync_table(spark, spec, store, **asked), spec

    run("a", [1, 2])
    run("b", [2, 3])
    result, spec = run("a", [2, 9], full_refresh=True)
    assert (result.rows_deleted, result.rows_inserted) == (2, 2)
    got = sorted((r.who, r.id, r.v) for r in store.read(spec.target).collect())
    assert got == [("a", 2, "a2"), ("a", 9, "a9"), ("b", 2, "b2"), ("b", 3, "b3")]
    assert run("b", [2, 3, 4])[0].rows_inserted == 1
