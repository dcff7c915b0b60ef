from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shown import plan_text
from tidemark.operators import layout, load

KEYED = "k int, j int, v string"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def brute_upsert(target, staged, width):
    keys = {r[:width] for r in staged if None not in r[:width]}
    return Counter([r for r in target if r[:width] not in keys] + staged)


rows = st.lists(
    st.tuples(st.sampled_from([None, 1, 2, 3, 4]), st.sampled_from([None, 1, 2]), st.sampled_from("abc")), max_size=25
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows, rows, st.sampled_from([1, 2]), st.sampled_from([1, 3]))
def test_upsert_against_brute_force(spark, target, staged, width, salt):
    t, s = spark.createDataFrame(target, KEYED), spark.createDataFrame(staged, KEYED)
    keys = ["k", "j"][:width]
    want = brute_upsert(target, staged, width)
    assert bag(load.upsert(t, s, keys, salt=salt)) == want
    counts = load.load_counts(t, s, keys, salt).first()
    assert sum(want.values()) == len(target) - counts.rows_deleted + counts.rows_inserted


def test_duplicates_and_null_keys_survive(spark):
    target = spark.createDataFrame([(1, 1, "old"), (None, 1, "n"), (2, 1, "keep")], KEYED)
    staged = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (None, 1, "m")], KEYED)
    got = bag(load.upsert(target, staged, ["k"]))
    assert got == Counter([(1, 1, "a"), (1, 1, "b"), (None, 1, "n"), (None, 1, "m"), (2, 1, "keep")])


def test_upsert_again_changes_nothing(spark):
    target = spark.createDataFrame([(i, 0, "t") for i in range(20)], KEYED)
    staged = spark.createDataFrame([(i, 0, "s") for i in range(10, 30)], KEYED)
    once = load.upsert(target, staged, ["k"])
    assert bag(load.upsert(once, staged, ["k"])) == bag(once)


def test_a_key_is_needed(spark):
    frame = spark.createDataFrame([(1, 1, "a")], KEYED)
    with pytest.raises(ValueError):
        load.delete_matching(frame, frame, [])


def test_empty_refresh(spark):
    target = spark.createDataFrame([(1, 1, "a")], KEYED)
    nothing = target.where("false")
    assert load.full_refresh(target, nothing, True).count() == 1
    assert load.full_refresh(target, nothing, True, allow_empty=True).count() == 0


def test_scoped_refresh_keeps_unknown(spark):
    target = spark.createDataFrame([(1, 1, "a"), (None, 1, "b"), (9, 1, "c")], KEYED)
    staged = spark.createDataFrame([(7, 7, "s")], KEYED)
    got = bag(load.scoped_refresh(target, staged, F.col("k") > 5))
    assert got == Counter([(1, 1, "a"), (None, 1, "b"), (7, 7, "s")])


def test_insert_is_by_name(spark):
    target = spark.createDataFrame([(1, 1, "a")], KEYED)
    staged = spark.createDataFrame([("x", 5, 6, "extra")], "v string, j int, k int, more string")
    assert bag(load.insert_all(target, staged)) == Counter([(1, 1, "a"), (6, 5, "x")])


def test_sources_do_not_meet(spark):
    schema = "k int, v string, src string"
    target = spark.createDataFrame([(1, "x", "a"), (1, "y", "b"), (2, "z", "b")], schema)
    batch = spark.createDataFrame([(1, "new")], "k int, v string")
    got = bag(load.merge_sources(target, {"a": batch, "b": batch.where("false")}, ["k"], "src"))
    assert got == Counter([(1, "new", "a"), (1, "y", "b"), (2, "z", "b")])


def test_orphans(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (2, 1, "b")], KEYED)
    assert [r.k for r in load.orphan_keys(target, target.where("k = 2"), ["k"]).collect()] == [1]


def test_small_batches_are_broadcast_on_their_size(spark, sf_dir):
    import __spark_entry__ as entry

    plan = plan_text(entry.queries()["upsert_composite_dupes"](spark, sf_dir))
    assert "BroadcastHashJoin LeftAnti BuildRight" in plan and "SortMergeJoin" not in plan


@pytest.fixture
def shuffled(spark):
    """Joins are shuffled, and a partition is skewed from a few kilobytes on."""
    given = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for name, value in given.items():
        spark.conf.set(name, value)
    yield
    for name in given:
        spark.conf.unset(name)


def hot_target(spark):
    """A third of the rows share a key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    return spark.range(0, 120000, numPartitions=8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))


@pytest.mark.parametrize("hot_key_is_staged", [True, False])
def test_hot_key_is_split_by_aqe(spark, shuffled, hot_key_is_staged):
    target = hot_target(spark)
    batch = spark.range(0, 40000, numPartitions=8).select(F.when(F.col("id") % 2 == 0, 11).otherwise(F.col("id")).alias("k"))
    staged = batch if hot_key_is_staged else batch.where("k <> 7")
    kept = load.delete_matching(target, staged, ["k"])
    staged_ids = {11, *range(1, 40000, 2)} - (set() if hot_key_is_staged else {7})
    wanted = sum((7 if i % 3 == 0 else i) not in staged_ids for i in range(120000))
    kept.collect()
    assert len(kept.collect()) == wanted
    final = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in final


def test_hot_key_is_split_by_salt(spark, shuffled):
    target = hot_target(spark)
    staged = spark.range(1, 40000, 2).select(F.col("id").alias("k"))
    salted = load.delete_matching(target, staged, ["k"], salt=8)
    assert salted.count() == load.delete_matching(target, staged, ["k"]).count()
    plan = plan_text(salted)
    assert "SortMergeJoin" in plan and "_salt" in plan


def test_keys_of_both_sides_are_distinct_before_a_shuffle_join(spark, shuffled):
    plan = plan_text(load.orphan_keys(hot_target(spark), hot_target(spark).where("k > 10"), ["k"]))
    joined = plan[plan.index("SortMergeJoin") :]
    assert joined.count("HashAggregate") >= 4


def exchanges(plan: str) -> list[str]:
    """The part of a formatted plan's tree in which exchanges stand."""
    tree = plan.split("\n(1)")[0]
    return [line for line in tree.splitlines() if "Exchange" in line]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_meet_without_a_shuffle(spark, sf_dir, no_broadcast):
    found = entry.queries()["upsert_bucketed"](spark, sf_dir)
    plan = plan_text(found)
    assert "SortMergeJoin" in plan and exchanges(plan) == [] and "Bucketed: true" in plan
    assert found.count() == entry.queries()["upsert_orders"](spark, sf_dir).count()


def test_bucketed_upsert_of_duplicates_and_nulls(spark):
    name = f"bucketed_{id(spark)}"
    target = spark.createDataFrame([(None, "a"), (1, "b"), (1, "c"), (2, "d")], "k long, v string")
    staged = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (3, "n")], "k long, v string")
    try:
        sides = [layout.write_bucketed(df, f"{name}_{i}", ["k"], 4) for i, df in enumerate((target, staged))]
        got = sorted((tuple(r) for r in load.upsert_bucketed(*sides, ["k"]).collect()), key=str)
    finally:
        for i in (0, 1):
            spark.sql(f"DROP TABLE IF EXISTS {name}_{i}")
    assert got == sorted([(None, "a"), (None, "z"), (1, "x"), (1, "y"), (2, "d"), (3, "n")], key=str)


def test_a_bitmap_keeps_survivors_out_of_the_shuffle(spark, sf_dir, no_broadcast):
    plan = plan_text(entry.queries()["delete_using_bitmap"](spark, sf_dir))
    first, second = plan.split("\n(1)")[0].split("+- SortMergeJoin LeftAnti")
    survivors = first.split("+- BroadcastExchange")[0]
    # Above the target's scan there is no exchange where rows survive; the bitmap's own rows are the only ones in the other.
    assert "Union" in survivors and "Scan parquet" in survivors and "Exchange" not in survivors
    assert first.count("- Exchange") == 1
    assert "BroadcastHashJoin LeftOuter" in second.split("+- Exchange")[1]


@pytest.mark.parametrize("bitmaps", [1, 64])
def test_a_crowded_bitmap_loses_nothing(spark, bitmaps):
    """Far more keys than bits: most rows are doubtful, and the same ones stay."""
    rows = [(i, f"k{i % 7}") for i in range(60_000)] + [(None, "x"), (5, None)]
    target = spark.createDataFrame(rows, "a long, b string")
    staged = target.where("a % 3 = 0").select("a", "b").unionAll(spark.createDataFrame([(None, "x")], "a long, b string"))
    got = load.delete_matching_bitmap(target, staged, ["a", "b"], bitmaps)
    wanted = load.delete_matching(target, staged, ["a", "b"])
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()
    bitmap = load.key_bitmap(staged, ["a", "b"], bitmaps)
    assert bitmap.count() <= bitmaps and bitmap.selectExpr("max(octet_length(_bits))").first()[0] == 4096


def test_a_bitmap_of_no_keys_deletes_nothing(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b")], "a long, b string")
    assert load.delete_matching_bitmap(target, target.limit(0), ["a"]).count() == 2


def test_net_changes_count_equal_rows(spark):
    schema = "day int, v string, w string"
    old = spark.createDataFrame([(1, "a", None)] * 3 + [(1, None, "a")] + [(2, "b", "b")] * 2 + [(None, "n", None)], schema)
    new = spark.createDataFrame([(1, "a", None)] * 5 + [(2, "b", "b")] + [(3, "c", "c")] + [(None, "n", None)], schema)
    got = {r["day"]: (r["deleted"], r["inserted"], r["unchanged"]) for r in load.net_changes(old, new, ["day"]).collect()}
    assert got == {1: (1, 2, 3), 2: (1, 0, 1), 3: (0, 1, 0), None: (0, 0, 1)}


def test_net_changes_move_hashes_only(spark, sf_dir, no_broadcast):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = plan_text(load.net_changes(lines, lines.where("l_quantity > 3"), ["l_shipdate"]))
    assert "partial_sum" in plan
    inputs = [part for part in plan.split("\n\n") if "Exchange\nInput" in part]
    assert inputs and all("l_comment" not in x and "l_extendedprice" not in x for x in inputs)
