from __future__ import annotations

from pyspark.sql import functions as F

from shown import plan_text
from tidemark.operators import layout, reconcile


def test_layout_clause():
    assert layout.layout_clause(None) == ""
    assert layout.layout_clause("a") == "distkey(a)"
    assert layout.layout_clause("a", ["b"]) == "distkey(a)\nsortkey(b)"
    assert layout.layout_clause(None, ["b", "c"]) == "compound sortkey(b,c)"


def test_clustered_rows_are_together_and_sorted(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    placed = layout.clustered(lineitem, ["l_returnflag"], ["l_shipdate"]).withColumn("p", F.spark_partition_id())
    assert placed.groupBy("l_returnflag").agg(F.countDistinct("p").alias("n")).where("n > 1").count() == 0
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_text(placed)


def test_every_row_has_a_bucket(spark):
    rows = spark.createDataFrame([(None, "a"), (1, None), (2, "b")], "k int, j string")
    found = [r[0] for r in rows.select(layout.bucket_of(["k", "j"], 5)).collect()]
    assert len(found) == 3 and all(0 <= b < 5 for b in found)


def test_conform_cuts_and_reorders(spark):
    rows = spark.createDataFrame([("5", "long text", 1)], "n string, v string, extra int")
    target = spark.createDataFrame([], "v string, n bigint").schema
    target["v"].metadata["width"] = 4
    assert tuple(reconcile.conform_to_target(rows, target).first()) == ("long", 5)


def test_schema_diff_and_status_of_many_tables(spark):
    source = spark.createDataFrame([("t", "a"), ("t", "b"), ("u", "a"), ("v", "a"), ("w", "a")], "table_name string, column_name string")
    target = spark.createDataFrame([("t", "a"), ("u", "z"), ("v", "q"), ("gone", "a")], "table_name string, column_name string")
    rebuilt = spark.createDataFrame([("v",)], "table_name string")
    diff = {tuple(r) for r in reconcile.schema_diff(source, target).collect()}
    assert {("t", "b", "source"), ("u", "z", "target"), ("gone", "a", "target")} <= diff and ("t", "a", "source") not in diff
    status = {r.table_name: r.status for r in reconcile.target_statuses(source, target, rebuilt).collect()}
    assert status == {"t": "ok", "u": "incorrect", "v": "rebuild", "w": "non-existent"}
