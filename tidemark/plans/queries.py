"""The query catalogue: every operator over the whole of the given tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import (
    ascii_fold,
    binary_text,
    decimal_text,
    fit_to_width,
    index_text,
    interval_time_of_day,
    iso_date,
    iso_time,
    iso_timestamp,
    json_text,
    normalize_row,
    truncate_text,
    uuid_text,
    zero_date_default,
)
from tidemark.functions import shape
from tidemark.functions.types import mysql_type_column, override_types, postgres_type_column, staging_schema
from tidemark.operators import acl, bounds, drift, extract, layout, load, metrics, profile, reconcile, rules
from tidemark.plans import derived as d
from tidemark.plans.tables import Target, TargetStore
from tidemark.plans.state import StateLog, append_state, read_monitor, state_rows
from tidemark.plans.sync import land, plan_sync, results_frame, sync_all, sync_table
from tidemark.session import scratch_dir, written
from tidemark.sources import sqltext
from tidemark.sources.indexed import indexed_stream
from tidemark.spec import SourceSpec, SyncSpec
from tidemark.streaming import stream_sync
from tidemark.streaming.incremental import StreamSource
from tidemark.streaming.once import append_once

Query = Callable[[SparkSession, str], DataFrame]

CATALOGUE: dict[str, Query] = {}


def query(f: Query) -> Query:
    CATALOGUE[f.__name__] = f
    return f


def query_named(name: str) -> Callable[[Query], Query]:
    """Register under a name that is also an imported function's."""

    def register(f: Query) -> Query:
        CATALOGUE[name] = f
        return f

    return register


# Index windows


@query
def high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    return bounds.high_water_marks(
        {
            "orders": (d.table(spark, sf, "orders"), "o_orderdate"),
            "orders_by_key": (d.table(spark, sf, "orders"), "o_orderkey"),
            "events": (d.table(spark, sf, "events"), "ts"),
            "lineitem": (d.table(spark, sf, "lineitem"), "l_shipdate"),
        }
    )


@query
def latest_index(spark: SparkSession, sf: str) -> DataFrame:
    return bounds.latest_index(d.idx_log(spark, sf))


@query
def lookback_index(spark: SparkSession, sf: str) -> DataFrame:
    return bounds.lookback_index(d.idx_log(spark, sf), 3)


@query
def incremental_window(spark: SparkSession, sf: str) -> DataFrame:
    """The last three runs' rows. The bounds are subqueries whose values reach the scan."""
    events = d.table(spark, sf, "events")
    ts_type = events.schema["ts"].dataType
    log = d.run_log(spark, sf)
    old = bounds.index_scalar(bounds.lookback_index(log, 3), ts_type)
    new = bounds.index_scalar(bounds.latest_index(log), ts_type)
    return bounds.extract_window(events, "ts", new, old)


@query
def incremental_window_int(spark: SparkSession, sf: str) -> DataFrame:
    """Orders above the middle of the keys that line items refer to.

    Bounds of two tables are two subqueries. Those of one table would be merged into a struct, whose fields do not push
    down.
    """
    orders = d.table(spark, sf, "orders")
    key_type = orders.schema["o_orderkey"].dataType
    middle = d.table(spark, sf, "lineitem").agg(
        F.expr("(min(l_orderkey) + max(l_orderkey)) DIV 2").alias("index_value")
    )
    new = bounds.index_scalar(bounds.high_water_mark(orders, "o_orderkey"), key_type)
    return bounds.extract_window(orders, "o_orderkey", new, bounds.index_scalar(middle, key_type))


@query
def first_load_window(spark: SparkSession, sf: str) -> DataFrame:
    events = d.table(spark, sf, "events")
    new = bounds.index_scalar(bounds.lookback_index(d.run_log(spark, sf), 2), events.schema["ts"].dataType)
    return bounds.extract_window(events, "ts", new)


@query
def lookback_window(spark: SparkSession, sf: str) -> DataFrame:
    """Every event type's own window, three runs back; types with too little history start at their latest value."""
    log = d.idx_log(spark, sf)
    marks = log.groupBy("table_name").agg(F.max("index_value").alias("index_value"))
    plan = written(bounds.window_plan(log, marks, 3), "bounds")
    windows = plan.select("table_name", "lower_value", F.col("new_index_value").alias("index_value"))
    return bounds.extract_windows(d.table(spark, sf, "events"), "event_type", "ts", windows)


@query
def null_index_window(spark: SparkSession, sf: str) -> DataFrame:
    events = d.events_nullidx(spark, sf)
    ts_type = events.schema["ts"].dataType
    return bounds.extract_window(events, "ts", bounds.index_scalar(bounds.high_water_mark(events, "ts"), ts_type))


@query
def custom_index_sql(spark: SparkSession, sf: str) -> DataFrame:
    d.table(spark, sf, "orders").createOrReplaceTempView("index_source")
    text = """
        SELECT max(CASE WHEN o_orderstatus = :table_open THEN o_orderkey END) AS index_value
        FROM index_source WHERE o_orderdate > CAST(:index_old_index_value AS TIMESTAMP_NTZ)
    """
    return sqltext.run_sql(spark, text, {"table_open": "O", "index_old_index_value": "1996-06-30 00:00:00.000000"})


@query
def custom_sql_extract(spark: SparkSession, sf: str) -> DataFrame:
    """A query with its own window. Both sides are read only in the columns it names."""
    d.table(spark, sf, "orders").createOrReplaceTempView("extract_orders")
    d.table(spark, sf, "customer").createOrReplaceTempView("extract_customer")
    text = """
        SELECT o.o_orderkey, o.o_orderdate, c.c_name, c.c_mktsegment
        FROM extract_orders o JOIN extract_customer c ON c.c_custkey = o.o_custkey
        WHERE o.o_orderdate > CAST(:run_old_index_value AS TIMESTAMP_NTZ)
          AND o.o_orderdate <= CAST(:run_new_index_value AS TIMESTAMP_NTZ) AND c.c_mktsegment <> :table_without
    """
    values = {"run_old_index_value": "1996-01-01", "run_new_index_value": "2000-12-31", "table_without": "MACHINERY"}
    return sqltext.run_sql(spark, text, values)


@query
def state_key_override(spark: SparkSession, sf: str) -> DataFrame:
    urgent = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("urgent"))
    overrides = d.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("database_name"), urgent.alias("override_database")
    )
    return bounds.override_state_key(d.orders_log(spark, sf), overrides.distinct())


@query
def index_check(spark: SparkSession, sf: str) -> DataFrame:
    follows = bounds.index_check(F.col("old_value"), F.col("new_value"), F.col("kind"))
    return d.index_pairs(spark, sf).select("event_id", "old_value", "new_value", "kind", follows.alias("follows"))


@query
def sync_plan(spark: SparkSession, sf: str) -> DataFrame:
    """The next window of every event type, from a log that lacks one of them."""
    log = d.idx_log(spark, sf).where(F.col("table_name") != "signup")
    marks = (
        d.table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("table_name"))
        .agg(F.max("ts").alias("m"))
    )
    text = index_text(F.col("m"), marks.schema["m"].dataType)
    return bounds.window_plan(log, marks.select("table_name", text.alias("index_value")), 2)


# Projections


@query
def project_drop(spark: SparkSession, sf: str) -> DataFrame:
    return extract.project(d.table(spark, sf, "orders"), ["o_orderpriority", "o_custkey"])


@query
def money_cast(spark: SparkSession, sf: str) -> DataFrame:
    customer = d.table(spark, sf, "customer")
    return customer.select("c_custkey", extract.money(F.col("c_acctbal")).alias("c_acctbal"))


@query_named("zero_date_default")
def zero_dates(spark: SparkSession, sf: str) -> DataFrame:
    dates = d.dates_txt(spark, sf)
    return dates.select("o_orderkey", "d", iso_timestamp(zero_date_default(F.col("d"))).alias("fixed"))


# Load modes


@query
def delete_using_staging(spark: SparkSession, sf: str) -> DataFrame:
    return load.delete_matching(d.orders_tgt(spark, sf), d.orders_stg(spark, sf), ["o_orderkey"])


@query
def delete_using_composite(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return load.delete_matching(d.lineitem_tgt(spark, sf), d.lineitem_stg(spark, sf), keys)


@query
def upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    return load.upsert(d.orders_tgt(spark, sf), d.orders_stg(spark, sf), ["o_orderkey"])


@query
def upsert_composite_dupes(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicate keys on both sides. The staged keys are written first, so the join knows their true size."""
    keys = ["l_orderkey", "l_linenumber"]
    staging = d.lineitem_stg(spark, sf)
    matches = written(load.staged_keys(staging, keys), "keys")
    return load.upsert(d.lineitem_tgt(spark, sf), staging, keys, matches=matches)


@query
def upsert_salted(spark: SparkSession, sf: str) -> DataFrame:
    """The same with every key spread over eight partitions."""
    keys = ["l_orderkey", "l_linenumber"]
    return load.upsert(d.lineitem_tgt(spark, sf), d.lineitem_stg(spark, sf), keys, salt=8)


@query
def upsert_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    target, staging = d.null_keyed(d.orders_tgt(spark, sf)), d.null_keyed(d.orders_stg(spark, sf))
    return load.upsert(target, staging, ["k"])


@query
def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    staging = d.orders_stg(spark, sf)
    return load.full_refresh(d.orders_tgt(spark, sf), staging, staging.isEmpty())


@query
def empty_refresh_keeps_target(spark: SparkSession, sf: str) -> DataFrame:
    nothing = d.table(spark, sf, "orders").where(F.col("o_orderdate") > d.ntz("2100-01-01"))
    return load.full_refresh(d.orders_tgt(spark, sf), nothing, nothing.isEmpty())


@query
def scoped_truncate_refresh(spark: SparkSession, sf: str) -> DataFrame:
    scope = sqltext.delete_predicate("DELETE FROM orders_tgt WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 1000;")
    return load.scoped_refresh(d.orders_tgt(spark, sf), d.orders_stg(spark, sf), F.expr(scope))


@query
def append_only_load(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that overlaps the target: the overlap is there twice."""
    events = d.table(spark, sf, "events")
    target = events.where(F.col("ts") <= d.ntz("2024-01-20"))
    return load.append(target, events.where(F.col("ts") > d.ntz("2024-01-15")))


@query
def rebuild_new_schema(spark: SparkSession, sf: str) -> DataFrame:
    """A table under the source's new columns takes the place of the stored one."""
    store = TargetStore(spark, scratch_dir(spark, "new_schema"))
    added = d.table(spark, sf, "orders").withColumn("o_channel", F.concat(F.lit("ch-"), F.col("o_orderstatus")))
    for rows in (d.orders_tgt(spark, sf), extract.project(added, ["o_custkey"])):
        run_id = store.new_run_id("orders")
        store.fill("orders", rows, Target(rows.schema, ("o_orderkey",), 4))
        store.swap("orders", run_id)
    return store.read("orders")


@query
def many_to_one_merge(spark: SparkSession, sf: str) -> DataFrame:
    target, staged = d.accounts(spark, sf)
    return load.merge_sources(target, staged, ["account_id"], "source_alias")


@query
def orphan_keys(spark: SparkSession, sf: str) -> DataFrame:
    gone = "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"
    source = d.table(spark, sf, "orders").where(f"NOT ({gone})")
    return load.orphan_keys(d.orders_tgt(spark, sf), source, ["o_orderkey"])


def _database(spark: SparkSession, label: str) -> str:
    """A database of its own for a query's tables."""
    folder = scratch_dir(spark, label)
    name = f"tidemark_{label}_{folder[-12:]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{folder}'")
    return name


@query
def upsert_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Target and staged rows as tables that are bucketed alike: neither is shuffled to meet the other."""
    database, keys = _database(spark, "bucketed"), ["o_orderkey"]
    target = layout.write_bucketed(d.orders_tgt(spark, sf), f"`{database}`.target", keys, 16)
    staged = layout.write_bucketed(d.orders_stg(spark, sf), f"`{database}`.staged", keys, 16)
    return load.upsert_bucketed(target, staged, keys)


@query
def delete_using_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """The target's rows meet the staged keys only where a bitmap of these says so."""
    keys = ["l_orderkey", "l_linenumber"]
    return load.delete_matching_bitmap(d.lineitem_tgt(spark, sf), d.lineitem_stg(spark, sf), keys)


@query
def source_drift(spark: SparkSession, sf: str) -> DataFrame:
    """In some ranges of the key the source has lost, changed and gained orders since they were loaded."""
    return drift.source_drift(d.orders_tgt(spark, sf), d.orders_drifted(spark, sf), "o_orderkey")


@query
def net_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows deleted, inserted and unchanged by shipping day when the staged lines replace those of their orders' lines."""
    old = d.lineitem_tgt(spark, sf)
    new = load.upsert(old, d.lineitem_stg(spark, sf), ["l_orderkey", "l_linenumber"])
    return load.net_changes(old, new, ["l_shipdate"])


@query
def load_counts(spark: SparkSession, sf: str) -> DataFrame:
    return load.load_counts(d.lineitem_tgt(spark, sf), d.lineitem_stg(spark, sf), ["l_orderkey", "l_linenumber"])


@query
def window_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps, overlaps and steps back of the logged windows."""
    return bounds.window_coverage(d.logged_windows(spark, sf), ["table_name"], "created_ts", "lower_ts", "upper_ts")


@query
def balanced_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Tables cut into 16 ranges of their index by a sketch: their rows, and whether the largest range is near the median."""
    found = []
    for name, index in (("lineitem", "l_orderkey"), ("events", "ts")):
        rows = d.table(spark, sf, name)
        ends = bounds.balanced_bounds(rows, index, 16)
        sizes = rows.groupBy(bounds.balanced_range(index, ends).alias("part")).agg(F.count(F.lit(1)).alias("n"))
        near = F.max("n") <= 1.1 * F.median("n")
        found.append(sizes.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("ranges"), F.sum("n").alias("rows"), near.alias("even")))
    return reduce(DataFrame.unionAll, found)


@query
def profile_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles of the events by day, kept and merged: beside one of all events, and beside exact counts."""
    events, columns = d.table(spark, sf, "events"), ["event_id", "user_id", "event_type", "value", "props"]
    kept = written(profile.window_profiles(events, F.to_date("ts"), columns), "profiles")
    merged = profile.merged_profile(kept)
    whole = profile.merged_profile(profile.window_profiles(events, F.lit(1), columns))
    exact = events.select(*[F.count_distinct(F.col(c).cast("string")).alias(c) for c in columns]).unpivot([], columns, "column_name", "exact")
    about = F.col("distinct_values")
    beside = merged.join(whole.select("column_name", about.alias("whole")), "column_name").join(exact, "column_name")
    return beside.select(
        "column_name", "row_count", "null_count", (F.abs(about - F.col("whole")) <= 0.02 * F.col("whole")).alias("as_the_whole"),
        (F.abs(about - F.col("exact")) <= 0.03 * F.col("exact")).alias("near_exact"),
    )


@query
def footer_high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    """Newest index values from the files' footers; that of a timestamp from its column."""
    marks = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "ts"}
    found = [
        bounds.footer_high_water_mark(spark, f"{sf}/{name}.parquet", column).select(F.lit(name).alias("table_name"), "index_value")
        for name, column in marks.items()
    ]
    return reduce(DataFrame.unionAll, found)


@query
def props_shape(spark: SparkSession, sf: str) -> DataFrame:
    return shape.shapes(d.events_props(spark, sf), "event_type", "props")


@query
def props_members(spark: SparkSession, sf: str) -> DataFrame:
    """Members of properties whose shape differs from type to type."""
    props = F.col("props")
    return d.events_props(spark, sf).select(
        "event_id",
        shape.member(props, "$.k", "double").alias("k"),
        shape.member(props, "$.label", "string").alias("label"),
        shape.member(props, "$.tags[1]", "string").alias("second_tag"),
    )


@query
def stream_lookback_once(spark: SparkSession, sf: str) -> DataFrame:
    """Three extracts of the events, each with some days of the one before, arrive as files; the stream is started again before
    the last one. Each event is loaded once."""
    root = scratch_dir(spark, "lookback")
    events = d.table(spark, sf, "events")
    ends = bounds.balanced_bounds(events, "ts", 3)
    lower = [None, *[end - timedelta(days=2) for end in ends]]
    for number, (first, last) in enumerate(zip(lower, [*ends, None])):
        rows = events if first is None else events.where(F.col("ts") > F.lit(first))
        rows = rows if last is None else rows.where(F.col("ts") <= F.lit(last))
        rows.coalesce(1).write.parquet(f"{root}/arrived/extract={number}")
        if number:
            append_once(spark, f"{root}/arrived", events.schema, ["event_id"], "ts", "3 days", f"{root}/loaded", f"{root}/checkpoint")
    return spark.read.schema(events.schema).parquet(f"{root}/loaded")


@query
def stream_index_window(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a database's table, which an in-process engine reads: a stream whose offsets are event times is started,
    and started again after the table has grown."""
    root = scratch_dir(spark, "indexed")
    events = d.table(spark, sf, "events")
    end = bounds.balanced_bounds(events, "ts", 2)[0]
    for number, rows in enumerate((events.where(F.col("ts") <= F.lit(end)), events.where(F.col("ts") > F.lit(end)))):
        rows.coalesce(1).write.parquet(f"{root}/table/part={number}")
        found = indexed_stream(spark, events.schema, f"read_parquet('{root}/table/*/*.parquet')", "ts", "duckdb", partitions=4)
        sink = found.writeStream.format("parquet").option("path", f"{root}/loaded").option("checkpointLocation", f"{root}/state")
        sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{root}/loaded")


# Schemas and types


@query
def conform_to_target(spark: SparkSession, sf: str) -> DataFrame:
    """Columns in another order and type, and one too many."""
    target = d.table(spark, sf, "orders").schema
    staged = d.orders_stg(spark, sf).select(
        F.lit("extra").alias("o_comment"), "o_orderpriority", F.col("o_totalprice").cast("string").alias("o_totalprice"),
        "o_orderdate", F.col("o_custkey").cast("int").alias("o_custkey"), "o_orderstatus", "o_orderkey",
    )
    return reconcile.conform_to_target(staged, target)


@query
def schema_diff(spark: SparkSession, sf: str) -> DataFrame:
    source, target, _ = d.column_lists(spark, sf)
    return reconcile.schema_diff(source, target)


@query
def target_status(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.target_statuses(*d.column_lists(spark, sf))


@query
def schema_profile(spark: SparkSession, sf: str) -> DataFrame:
    profiles = [reconcile.schema_profile(d.table(spark, sf, name), name) for name in d.TABLES]
    return reduce(DataFrame.unionAll, profiles)


@query
def key_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    checks = {
        "orders": ["o_orderkey"],
        "lineitem": ["l_orderkey", "l_linenumber"],
        "conversations": ["conv_id", "turn"],
    }
    return reduce(
        DataFrame.unionAll,
        [
            reconcile.key_uniqueness(d.table(spark, sf, name), keys).select(F.lit(name).alias("table_name"), "*")
            for name, keys in checks.items()
        ],
    )


@query
def not_null_violations(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.not_null_violations(d.events_nullidx(spark, sf), ["event_id", "ts", "event_type"])


@query
def mysql_type_map(spark: SparkSession, sf: str) -> DataFrame:
    target = mysql_type_column(F.col("source_type"), {"CHAR(36)": "char(36)"})
    return d.mysql_types(spark, sf).select("p_partkey", "source_type", target.alias("target_type"))


# Overrides by name, by sized type, and by column.
POSTGRES_OVERRIDES = {"mood": "varchar(15)", "numeric(10,3)": "real", "columns": {"PROMO": "varchar(99)"}}


@query
def postgres_type_map(spark: SparkSession, sf: str) -> DataFrame:
    described = [F.col(c) for c in ("source_type", "column_name", "size", "precision", "scale")]
    target = postgres_type_column(*described, type_map=POSTGRES_OVERRIDES)
    return d.postgres_columns(spark, sf).select("p_partkey", "source_type", target.alias("target_type"))


@query
def type_override_cast(spark: SparkSession, sf: str) -> DataFrame:
    """Overrides by column, by type name, and to a text type that cuts."""
    lineitem = d.table(spark, sf, "lineitem")
    overrides = {"double": "decimal(12,2)", "columns": {"l_shipdate": "varchar(10)", "l_linenumber": "bigint"}}
    return reconcile.conform_to_target(lineitem, override_types(lineitem.schema, overrides))


@query
def staging_types(spark: SparkSession, sf: str) -> DataFrame:
    """The staged form of an order whose price is a decimal, with the type of every staged column."""
    orders = extract.cast_columns(d.table(spark, sf, "orders"), {"o_totalprice": "decimal(15,2)", "o_custkey": "int"})
    staged = normalize_row(orders, as_staged=True)
    names = {f.name: f.dataType.simpleString() for f in staging_schema(orders.schema).fields}
    same = [F.typeof(F.col(name)) == F.lit(wanted) for name, wanted in names.items()]
    return staged.withColumn("as_declared", reduce(lambda a, b: a & b, same))


# Values


@query_named("iso_timestamp")
def iso_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Events have microseconds, order dates none."""
    orders = d.table(spark, sf, "orders")
    events = d.table(spark, sf, "events")
    return events.select(
        F.lit("events").alias("src"), F.col("event_id").alias("id"), iso_timestamp(F.col("ts")).alias("text")
    ).unionAll(orders.select(F.lit("orders"), "o_orderkey", iso_timestamp(F.col("o_orderdate"))))


@query_named("iso_date")
def iso_dates(spark: SparkSession, sf: str) -> DataFrame:
    date = F.col("o_orderdate").cast("date")
    return d.table(spark, sf, "orders").select("o_orderkey", iso_date(date).alias("text"))


@query
def time_of_day(spark: SparkSession, sf: str) -> DataFrame:
    since_epoch = F.col("ts") - d.ntz("1970-01-01")
    return d.table(spark, sf, "events").select("event_id", interval_time_of_day(since_epoch).alias("text"))


@query_named("iso_time")
def iso_times(spark: SparkSession, sf: str) -> DataFrame:
    """Times of day as the TIME type prints them, without trailing zeros; sessions have to allow that type itself."""
    printed = F.regexp_replace(F.date_format("ts", "HH:mm:ss.SSSSSS"), r"\.?0{0,6}$", "")
    whole = F.when(F.length(printed) < 8, F.date_format("ts", "HH:mm:ss")).otherwise(printed)
    return d.table(spark, sf, "events").select("event_id", iso_time(whole).alias("text"))


@query_named("interval_time_of_day")
def intervals(spark: SparkSession, sf: str) -> DataFrame:
    events = d.table(spark, sf, "events")
    first = events.agg(F.min("ts")).scalar()
    return events.select("event_id", interval_time_of_day(F.col("ts") - first).alias("text"))


@query_named("decimal_text")
def decimal_texts(spark: SparkSession, sf: str) -> DataFrame:
    def text(name: str, scale: int):
        return decimal_text(F.col(name).cast(f"decimal(19,{scale})"), scale).alias(name)

    return d.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", text("l_quantity", 0), text("l_extendedprice", 2), text("l_discount", 4),
        decimal_text(F.expr("cast(cast(l_tax as decimal(19,2)) * 0.00000001 as decimal(19,10))"), 10).alias("l_tax"),
    )


@query_named("ascii_fold")
def ascii_folds(spark: SparkSession, sf: str) -> DataFrame:
    return d.table(spark, sf, "documents").select("doc_id", ascii_fold(F.col("text")).alias("text"))


@query_named("truncate_text")
def truncate_texts(spark: SparkSession, sf: str) -> DataFrame:
    return d.table(spark, sf, "documents").select("doc_id", truncate_text(F.col("text"), 1000).alias("text"))


@query_named("fit_to_width")
def fit_widths(spark: SparkSession, sf: str) -> DataFrame:
    """Names as bytes of which the first, or the first two, are no UTF-8."""
    broken = F.when(F.col("p_size") % 2 == 0, F.lit(b"\xff")).otherwise(F.lit(b"\xff\xe9"))
    name = F.concat(broken, F.col("p_name").cast("binary"))
    return d.table(spark, sf, "part").select("p_partkey", fit_to_width(name, 8).alias("p_name"))


@query_named("json_text")
def json_texts(spark: SparkSession, sf: str) -> DataFrame:
    """An event as a struct of numbers, texts, an array and a map."""
    rows = d.table(spark, sf, "events").select(
        "event_id",
        F.struct(
            "event_id",
            F.col("event_type").alias("type"),
            F.col("props").alias("raw"),
            "value",
            F.array("user_id", F.lit(None).cast("long")).alias("users"),
            F.create_map(F.col("event_type"), F.col("value") > 50).alias("big"),
            F.col("ts").alias("at"),
        ).alias("payload"),
    )
    return rows.select("event_id", json_text(F.col("payload"), rows.schema["payload"].dataType).alias("json"))


@query
def json_array_text(spark: SparkSession, sf: str) -> DataFrame:
    vectors = d.table(spark, sf, "embeddings")
    return vectors.select("vec_id", json_text(F.col("embedding"), vectors.schema["embedding"].dataType).alias("json"))


@query_named("binary_text")
def binary_texts(spark: SparkSession, sf: str) -> DataFrame:
    raw = d.table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("raw"))
    return raw.select("doc_id", binary_text(F.col("raw")).alias("text"))


@query_named("uuid_text")
def uuid_texts(spark: SparkSession, sf: str) -> DataFrame:
    return d.document_uuids(spark, sf).select("doc_id", uuid_text(F.col("u")).alias("u"))


@query_named("normalize_row")
def normalize_rows(spark: SparkSession, sf: str) -> DataFrame:
    customer = extract.cast_columns(d.table(spark, sf, "customer"), {"c_acctbal": "decimal(19,2)"})
    noted = customer.withColumn("c_note", F.concat(F.lit("Zoë "), F.col("c_name"), F.lit(" — café")))
    return normalize_row(noted, as_staged=True)


# Metrics and state


@query
def extract_metrics(spark: SparkSession, sf: str) -> DataFrame:
    day = iso_date(F.to_date("ts")).alias("day")
    events = d.table(spark, sf, "events").select("event_id", "user_id", "event_type", "props", day)
    return metrics.extract_metrics(events, "day")


@query
def extract_monitor(spark: SparkSession, sf: str) -> DataFrame:
    orders = d.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    per_table = metrics.extract_metrics(orders, "o_orderpriority")
    return per_table.select(
        *metrics.extract_monitor_columns(
            "SyncTable", "dw", "sales", F.col("o_orderpriority"), F.col("row_count"), F.col("upload_size")
        )
    )


@query
def load_monitor(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per "table" (the order status) of an upsert of the staged orders."""
    target, staging = d.orders_tgt(spark, sf), d.orders_stg(spark, sf)
    source = F.col("o_orderpriority").alias("name")
    deleted = load.matching(target, load.staged_keys(staging, ["o_orderkey"]), ["o_orderkey"]).select(
        source, F.lit(1).alias("deleted"), F.lit(0).alias("inserted"), F.lit(0).alias("size")
    )
    inserted = staging.select(source, F.lit(0), F.lit(1), F.octet_length(F.col("o_orderpriority")))
    counts = deleted.unionAll(inserted).groupBy("name").agg(
        F.sum("deleted").alias("deleted"), F.sum("inserted").alias("inserted"), F.sum("size").alias("size")
    )
    return counts.select(
        *metrics.load_monitor_columns(
            "SyncTable", "dw", "sales", F.col("name"), "public", F.col("inserted"), F.col("deleted"), F.col("size")
        )
    )


@query
def state_append(spark: SparkSession, sf: str) -> DataFrame:
    log = d.idx_log(spark, sf)
    marks = bounds.high_water_marks(
        {
            "orders": (d.table(spark, sf, "orders"), "o_orderkey"),
            "nothing": (d.table(spark, sf, "orders").where("o_orderkey < 0"), "o_orderkey"),
            "lineitem": (d.table(spark, sf, "lineitem"), "l_shipdate"),
        }
    )
    return append_state(log, state_rows(marks, "dw", "sales", datetime(2024, 3, 1, 12)))


@query
def stage_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return written(normalize_row(d.orders_stg(spark, sf)), "stage")


# Access control and settings


@query
def acl_explode(spark: SparkSession, sf: str) -> DataFrame:
    return acl.explode_acl(d.acl_texts(spark, sf), "acl", "c_custkey")


@query
def acl_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries per text; malformed ones have NULL."""
    entries = F.size(acl.parse_acl(F.col("acl")))
    parsed = acl.parse_acl(F.col("acl"))
    return d.acl_texts(spark, sf).select("c_custkey", F.when(parsed.isNotNull(), entries).alias("entries"))


@query
def spec_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return rules.spec_conflicts(d.settings(spark, sf)).select("p_partkey", "conflict", "runtime_conflict")


@query
def clustered_layout(spark: SparkSession, sf: str) -> DataFrame:
    return layout.clustered(d.table(spark, sf, "lineitem"), ["l_orderkey"], ["l_orderkey", "l_linenumber"])


# Whole runs into published targets


def _orders_spec(sf: str, view: str, **given) -> SyncSpec:
    source = SourceSpec(alias="shop", database="sales", kind="table")
    base = dict(
        source=source, source_table=view, target_table="orders", index_column="o_orderdate",
        primary_key=("o_orderkey",), buckets=4,
    )
    return SyncSpec(**{**base, **given})


def _moved(spark: SparkSession, sf: str) -> DataFrame:
    """The old orders, and the staged ones a year later."""
    later = d.orders_stg(spark, sf).withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 365 DAYS"))
    return d.orders_tgt(spark, sf).unionByName(later)


def _two_runs(
    spark: SparkSession, sf: str, label: str, again: dict | None = None, more: dict | None = None, **given
) -> tuple[TargetStore, SyncSpec]:
    """A first load of the old orders, then a run over the same table after it has moved on.

    ``again`` is asked of the second run, which finds the columns ``more`` too.
    """
    view = f"source_{label}"
    store = TargetStore(spark, scratch_dir(spark, label))
    spec = _orders_spec(sf, view, **given)
    d.orders_tgt(spark, sf).createOrReplaceTempView(view)
    sync_table(spark, spec, store)
    _moved(spark, sf).withColumns(more or {}).createOrReplaceTempView(view)
    sync_table(spark, spec, store, **(again or {}))
    return store, spec


@query
def published_upsert(spark: SparkSession, sf: str) -> DataFrame:
    store, spec = _two_runs(spark, sf, "upsert")
    return store.read(spec.target)


@query
def published_append(spark: SparkSession, sf: str) -> DataFrame:
    store, spec = _two_runs(spark, sf, "append", append_only=True, columns_to_drop=("o_custkey",))
    return store.read(spec.target)


@query
def published_monitor(spark: SparkSession, sf: str) -> DataFrame:
    """What the monitor tables say of both runs."""
    store, _ = _two_runs(spark, sf, "shared")
    found = read_monitor(store, "extract").select(
        F.lit("extract").alias("monitor"), "task_id", "output_exists", F.col("row_count").alias("rows"),
        F.lit(None).cast("long").alias("rows_deleted"),
    )
    loaded = read_monitor(store, "load").select(
        F.lit("load").alias("monitor"), "task_id", F.lit(None).cast("boolean").alias("output_exists"),
        F.col("rows_inserted").alias("rows"), "rows_deleted",
    )
    return found.unionAll(loaded)


@query
def published_clean_up(spark: SparkSession, sf: str) -> DataFrame:
    """A run dies after its extract was staged. Cleaning up deletes what it has left, and the target's rows stay."""
    store, spec = _two_runs(spark, sf, "clean", again={"full_refresh": True})
    rows, base = spark.table(spec.source_table), store.latest(spec.target)
    land(spark, store, spec, rows, base.struct, "upsert", base, base.keys)
    gone = store.clean_up(spec.target)
    rows = store.read(spec.target)
    return rows.groupBy(F.lit(len(gone)).alias("folders_deleted")).agg(F.count(F.lit(1)).alias("row_count"))


@query
def published_rebuild_result(spark: SparkSession, sf: str) -> DataFrame:
    """What a rebuild reports: its mode, its status against the old target, and the rows it has counted."""
    store, spec = _two_runs(spark, sf, "rebuilt")
    results = results_frame(spark, [sync_table(spark, spec, store, rebuild=True)])
    return results.select("source_table", "status", "mode", "target_status", "new_index_value", "rows_inserted", "rows_deleted")


@query
def published_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A refresh of a target that exists, after its source has moved on."""
    store, spec = _two_runs(spark, sf, "refresh", again={"full_refresh": True})
    return store.read(spec.target)


@query
def published_scoped_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A refresh that deletes only the urgent orders, and loads all rows of the source."""
    scope = os.path.join(os.path.dirname(__file__), "sql", "urgent_orders.sql")
    store, spec = _two_runs(spark, sf, "scoped", again={"full_refresh": True}, truncate_file=scope)
    return store.read(spec.target)


@query
def published_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """A rebuild takes on a column that the target lacked."""
    store, spec = _two_runs(spark, sf, "rebuild", again={"rebuild": True}, more={"o_year": F.year("o_orderdate")})
    return store.read(spec.target)


@query
def published_comments(spark: SparkSession, sf: str) -> DataFrame:
    """A new target keeps the comments of the source's table and columns; how many values each column of it has."""
    database, store = _database(spark, "commented"), TargetStore(spark, scratch_dir(spark, "comments"))
    name = f"`{database}`.orders"
    orders = d.orders_tgt(spark, sf)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()} COMMENT 'the {f.name[2:]}'" for f in orders.schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet COMMENT 'all orders'")
    orders.write.insertInto(name)
    source = SourceSpec(alias="shop", database=database, kind="table", options={"qualified": "true"})
    spec = SyncSpec(source, "orders", "orders", index_column="o_orderdate", primary_key="o_orderkey", buckets=4)
    sync_table(spark, spec, store)
    target, rows = store.latest(spec.target), store.read(spec.target)
    counts = rows.select(*[F.count(c).alias(c) for c in rows.columns]).unpivot([], rows.columns, "column_name", "value_count")
    comments = F.create_map(*[F.lit(x) for f in target.struct for x in (f.name, f.metadata.get("comment", ""))])
    return counts.select(
        F.lit(target.comment).alias("table_comment"), "column_name", comments[F.col("column_name")].alias("comment"), "value_count"
    )


@query
def published_schema_file(spark: SparkSession, sf: str) -> DataFrame:
    """A target that is created from a file of column definitions, and not as its source is."""
    columns = os.path.join(os.path.dirname(__file__), "sql", "orders_columns.sql")
    store, spec = _two_runs(spark, sf, "columns", schema_file=columns)
    return store.read(spec.target)


@query
def published_lookback(spark: SparkSession, sf: str) -> DataFrame:
    """A third run reads from the second last index value on, and so sees changes that left the index as it was."""
    store, spec = _two_runs(spark, sf, "lookback", lookback=1)
    later = _moved(spark, sf).where(F.col("o_orderstatus") == "U").withColumn("o_orderstatus", F.lit("L"))
    d.orders_tgt(spark, sf).unionByName(later).createOrReplaceTempView(spec.source_table)
    sync_table(spark, spec, store)
    return store.read(spec.target)


@query
def published_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two sources feed one target; then one of them is refreshed."""
    store = TargetStore(spark, scratch_dir(spark, "merge"))

    def spec(alias: str, table: str) -> SyncSpec:
        source = SourceSpec(alias=alias, database="accounts", kind="table")
        return SyncSpec(source, table, "accounts", index_column="account_id", primary_key="account_id",
                        alias_column="source_alias", buckets=2)

    crm, erp = spec("crm", "source_crm"), spec("erp", "source_erp")
    customers, suppliers = (
        d.table(spark, sf, name).select(F.col(f"{c}_{key}").alias("account_id"), F.col(f"{c}_acctbal").alias("balance"))
        for name, c, key in (("customer", "c", "custkey"), ("supplier", "s", "suppkey"))
    )
    customers.createOrReplaceTempView("source_crm")
    suppliers.createOrReplaceTempView("source_erp")
    sync_table(spark, crm, store)
    sync_table(spark, erp, store)
    customers.where(F.col("balance") > 0).createOrReplaceTempView("source_crm")
    sync_table(spark, crm, store, full_refresh=True)
    return store.read(crm.target)


@query_named("plan_sync")
def planned(spark: SparkSession, sf: str) -> DataFrame:
    """What a sync would do next: go on with one table, create another, and refuse the settings of a third."""
    store, spec = _two_runs(spark, sf, "shared")
    lake = SourceSpec(alias="lake", database="files", kind="parquet", location=sf)
    specs = [
        spec,
        SyncSpec(lake, "events", "events", index_column="ts", append_only=True, sort_keys=("ts",)),
        SyncSpec(lake, "part", "part"),
    ]
    planned = plan_sync(spark, specs, store)
    return planned.select(
        "source_table", "status", "mode", "old_index_value", "new_index_value", "create_columns", "layout", "conflict"
    )


@query
def published_state(spark: SparkSession, sf: str) -> DataFrame:
    store, spec = _two_runs(spark, sf, "state")
    rows = StateLog(store).of(spec.state_key, spec.target)
    return rows.select("datastore_name", "database_name", "index_value")


@query
def published_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that the target's files hold together."""
    store, spec = _two_runs(spark, sf, "manifest")
    files = store.manifest(spec.target)
    return files.groupBy("mandatory").agg(F.sum("row_count").alias("row_count"))


@query
def sync_many(spark: SparkSession, sf: str) -> DataFrame:
    """Several tables in one call: a first load, an upsert without a key, and an append."""
    source = SourceSpec(alias="lake", database="files", kind="parquet", location=sf)
    store = TargetStore(spark, scratch_dir(spark, "many"))
    specs = [
        SyncSpec(source, "orders", "orders", index_column="o_orderkey", primary_key="o_orderkey", buckets=2),
        SyncSpec(source, "lineitem", "lineitem", index_column="l_shipdate"),
        SyncSpec(source, "events", "events", index_column="ts", append_only=True),
        SyncSpec(source, "customer", "customer", full_refresh=True),
        SyncSpec(source, "part", "part", full_refresh=True, enabled=False),
    ]
    results = results_frame(spark, sync_all(spark, specs, store))
    return results.select(
        "source_table", "status", "mode", "target_status", "new_index_value", "rows_extracted", "rows_inserted",
        "rows_deleted",
    )


@query
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The staged orders arrive as a stream of files."""
    root = scratch_dir(spark, "stream")
    store = TargetStore(spark, f"{root}/store")
    view = "source_stream"
    spec = _orders_spec(sf, view, buckets=4)
    d.orders_tgt(spark, sf).createOrReplaceTempView(view)
    sync_table(spark, spec, store)

    def staged(rows: DataFrame) -> DataFrame:
        date = F.col("o_orderdate")
        batch = rows.where((date > d.ntz("1998-03-31")) & (date <= d.ntz("1998-12-31")))
        return batch.withColumns({"o_orderstatus": F.lit("U"), "o_totalprice": F.col("o_totalprice") + 1})

    schema = d.table(spark, sf, "orders").schema
    stream_sync(spark, StreamSource(f"{sf}/orders.parquet", schema), spec, store, f"{root}/checkpoint", staged)
    return store.read(spec.target)
