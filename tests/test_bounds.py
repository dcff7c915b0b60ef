from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shown import plan_text
from tidemark.operators import bounds as b


def ids(df):
    return sorted(r[0] for r in df.collect())


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame([(i,) for i in [None, *range(1, 51)]], "id bigint")


def lit(v):
    return b.index_literal(v, T.LongType())


def test_no_new_value_means_no_filter(numbers):
    assert b.extract_window(numbers, "id", None, lit(13)).count() == 51


def test_windows(numbers):
    assert ids(b.extract_window(numbers, "id", lit(42))) == list(range(1, 43))
    assert ids(b.extract_window(numbers, "id", lit(42), lit(13))) == list(range(14, 43))
    assert ids(b.extract_window(numbers, "id", lit("42"), lit("13"), lit("10"))) == list(range(11, 43))


def test_windows_in_a_row_cover_everything_once(numbers):
    edges = [None, 7, 7, 20, 33, 50]
    seen = [i for lo, hi in zip(edges, edges[1:]) for i in ids(b.extract_window(numbers, "id", lit(hi), lit(lo) if lo else None))]
    assert sorted(seen) == list(range(1, 51))


def log(spark, rows):
    return spark.createDataFrame(
        [("d", "b", t, v, datetime(2024, 1, day)) for t, v, day in rows],
        "datastore_name string, database_name string, table_name string, index_value string, created_ts timestamp_ntz",
    )


def test_latest_is_by_time_not_by_value(spark):
    rows = log(spark, [("t", "9", 1), ("t", "5", 3), ("t", "7", 2), ("u", "1", 1)])
    assert {(r.table_name, r.index_value) for r in b.latest_index(rows).collect()} == {("t", "5"), ("u", "1")}


def test_lookback(spark):
    rows = log(spark, [("t", "1", 1), ("t", "2", 2), ("t", "3", 3), ("u", "8", 1)])
    assert [(r.table_name, r.index_value) for r in b.lookback_index(rows, 1).collect()] == [("t", "2")]
    assert [(r.table_name, r.index_value) for r in b.lookback_index(rows, 2).collect()] == [("t", "1")]
    assert b.lookback_index(rows, 3).count() == 0


# Pairs of a logged and a new index value, and whether the one may follow the other.
PAIRS = [
    (None, "", "int", True),
    ("123", None, "int", False),
    ("123", "126", "int", True),
    ("123", "123", "int", True),
    ("123", "121", "int", False),
    ("2018-10-28 11:06:33.980", "2018-10-28 11:06:34.000000", "timestamp", True),
    ("2018-10-28 11:06:34.632", "2018-10-28 11:06:34.000000", "timestamp", False),
    ("2018-10-28 11:06:34.418", "2018-10-28 11:06:34.543217", "timestamp", True),
    ("2018-10-28 11:06:34.632", "2018-10-28 11:06:34.543217", "timestamp", False),
    ("2018-10-28 11:06:33.980293", "2018-10-28 11:06:34.000000", "timestamp", True),
    ("2018-10-28 11:06:34.632398", "2018-10-28 11:06:34.000000", "timestamp", False),
    ("2018-10-28 11:06:34.418490", "2018-10-28 11:06:34.543217", "timestamp", True),
    ("2018-10-28 11:06:34.632398", "2018-10-28 11:06:34.543217", "timestamp", False),
    ("abcd", "123", "int", False),
    ("abcd", "abcd", "text", False),
    ("12:23:291 32/13/19", "2018-10-28 11:06:34.000000", "timestamp", False),
]


def test_index_check(spark):
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(PAIRS)], "i int, o string, n string, k string, want boolean")
    got = frame.select("i", "want", b.index_check(F.col("o"), F.col("n"), F.col("k")).alias("got")).collect()
    assert [(r.i, r.got) for r in got] == [(r.i, r.want) for r in got]


def test_window_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = plan_text(
        b.extract_window(
            events, "ts", b.index_literal("2024-01-02 00:00:00.000000", T.TimestampNTZType()),
            b.index_literal("2024-01-01 12:00:00.000000", T.TimestampNTZType()),
        ).select("event_id")
    )
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-01T12:00), LessThanOrEqual(ts,2024-01-02T00:00)]" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_subquery_bound_reaches_the_scan(spark, sf_dir):
    import __spark_entry__ as entry

    plan = plan_text(entry.queries()["incremental_window"](spark, sf_dir))
    assert "GreaterThan(ts,ScalarSubquery" in plan and "LessThanOrEqual(ts,ScalarSubquery" in plan


def test_windows_of_many_tables(spark):
    rows = spark.createDataFrame([(t, i) for t in "abc" for i in range(10)] + [("a", None), ("d", 1)], "t string, i bigint")
    limits = spark.createDataFrame([("a", "3", "5"), ("b", None, "2"), ("c", "8", "8")], "table_name string, lower_value string, index_value string")
    got = sorted((r.t, r.i) for r in b.extract_windows(rows, "t", "i", limits).collect())
    assert got == [("a", 4), ("a", 5), ("b", 0), ("b", 1), ("b", 2)]


def test_high_water_mark_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "id bigint")
    assert b.high_water_mark(empty, "id").first()[0] is None


def test_state_key_override(spark):
    rows = log(spark, [("t", "1", 1)])
    overrides = spark.createDataFrame([("b", "common"), ("x", None)], "database_name string, override_database string")
    assert b.override_state_key(rows, overrides).first().database_name == "common"


def test_instants_keep_their_order_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = spark.sql("SELECT explode(array(timestamp'2024-11-03 05:30:00Z', timestamp'2024-11-03 06:30:00Z')) AS i")
        texts = [r[0] for r in rows.select(b.index_text(F.col("i"), T.TimestampType()).alias("t")).orderBy("t").collect()]
        assert texts == ["2024-11-03 05:30:00.000000", "2024-11-03 06:30:00.000000"]
        bound = b.index_literal(texts[0], T.TimestampType())
        assert rows.where(F.col("i") > bound).count() == 1
        assert b.high_water_mark(rows, "i").first()[0] == texts[1]
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert rows.where(F.col("i") > b.index_literal(texts[0], T.TimestampType())).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_window_plan_without_history_is_a_first_load(spark):
    rows = log(spark, [("t", "1", 1), ("t", "5", 2)])
    marks = spark.createDataFrame([("t", "9"), ("u", "3")], "table_name string, index_value string")
    got = {r.table_name: tuple(r)[1:] for r in b.window_plan(rows, marks, 1).collect()}
    assert got == {"t": ("incremental", "5", "1", "1", "9"), "u": ("first_load", None, None, None, "3")}


def test_least_values_keep_the_first_row(spark):
    rows = spark.createDataFrame([("a", -(2**63)), ("a", 5)], "t string, i bigint")
    limits = spark.createDataFrame([("a", None, "9")], "table_name string, lower_value string, index_value string")
    assert b.extract_windows(rows, "t", "i", limits).count() == 2


def test_common_bounds_of_many_tables_reach_the_scan(spark, sf_dir):
    import __spark_entry__ as entry

    plan = plan_text(entry.queries()["lookback_window"](spark, sf_dir))
    assert "LessThanOrEqual(ts,ScalarSubquery" in plan and "GreaterThanOrEqual(ts,ScalarSubquery" in plan
