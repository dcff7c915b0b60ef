"""Index windows: where the last run ended, where this one ends, and the rows between."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.temporal import index_text, index_value

STATE_KEY = ("datastore_name", "database_name", "table_name")

# The least value of each type that an index column can have.
LEAST = {
    "byte": str(-(2**7)),
    "short": str(-(2**15)),
    "integer": str(-(2**31)),
    "long": str(-(2**63)),
    "timestamp": "0001-01-01 00:00:00",
    "timestamp_ntz": "0001-01-01 00:00:00",
}


def high_water_mark(df: DataFrame, index_column: str) -> DataFrame:
    """The greatest index value as one row ``index_value``, in the state log's text form.

    The maximum is taken per task first; one value per task is shuffled.
    """
    data_type = df.schema[index_column].dataType
    return df.agg(F.max(F.col(index_column)).alias("m")).select(index_text(F.col("m"), data_type).alias("index_value"))


def high_water_marks(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The high-water marks of many ``{name: (frame, index column)}`` in one job."""
    marks = [
        high_water_mark(df, column).select(F.lit(name).alias("table_name"), "index_value")
        for name, (df, column) in tables.items()
    ]
    return reduce(DataFrame.unionAll, marks)


def latest_index(state: DataFrame) -> DataFrame:
    """The newest index value of every state key, in one pass with map-side aggregation."""
    return state.groupBy(*STATE_KEY).agg(F.max_by("index_value", "created_ts").alias("index_value"))


def lookback_index(state: DataFrame, runs_back: int) -> DataFrame:
    """The index value that was current ``runs_back`` runs before the newest one, per state key.

    Keys with too little history are absent. Only the newest ``runs_back + 1`` rows of a key are ever held: the
    rank filter becomes a per-task limit before the shuffle.
    """
    newest_first = Window.partitionBy(*STATE_KEY).orderBy(F.col("created_ts").desc())
    return (
        state.select(*STATE_KEY, "index_value", F.row_number().over(newest_first).alias("rn"), "created_ts")
        .where(F.col("rn") <= runs_back + 1)
        .where(F.col("rn") == runs_back + 1)
        .select(*STATE_KEY, "index_value")
    )


def latest_and_lookback(state: DataFrame, runs_back: int) -> DataFrame:
    """Per state key the newest index value, and the one ``runs_back`` runs before it or NULL, from one pass."""
    newest_first = Window.partitionBy(*STATE_KEY).orderBy(F.col("created_ts").desc())
    ranked = state.select(*STATE_KEY, "index_value", F.row_number().over(newest_first).alias("rn"))
    near = ranked.where(F.col("rn") <= runs_back + 1)

    def value(rank: int) -> Column:
        return F.any_value(F.when(F.col("rn") == rank, F.col("index_value")), True)

    return near.groupBy(*STATE_KEY).agg(
        value(1).alias("index_value"), value(runs_back + 1).alias("lookback_index_value")
    )


def override_state_key(state: DataFrame, overrides: DataFrame) -> DataFrame:
    """Replace database names in the state key. ``overrides`` has the columns database_name and override_database."""
    return (
        state.join(overrides, "database_name", "left")
        .withColumn("database_name", F.coalesce("override_database", "database_name"))
        .drop("override_database")
        .select(*state.columns)
    )


def index_literal(value: str | int | None, data_type: T.DataType) -> Column | None:
    """A logged value as a literal of the index column's own type, so that comparisons push down to the scan."""
    return None if value is None else index_value(F.lit(str(value)), data_type)


def index_scalar(bound: DataFrame, data_type: T.DataType) -> Column:
    """A one-row frame ``index_value`` as a bound. The subquery runs first and its value reaches the scan."""
    return bound.select(index_value(F.col("index_value"), data_type)).scalar()


def in_window(
    index: Column, new: Column | None, old: Column | None = None, lookback: Column | None = None
) -> Column | None:
    """``lower < index <= new``, where lower is the lookback value if there is one, else the old value.

    No new value means no filter at all, which is None here. The upper bound holds on a first load too, so that
    what is logged is what was read.
    """
    if new is None:
        return None
    lower = lookback if lookback is not None else old
    return index <= new if lower is None else (index > lower) & (index <= new)


def extract_window(
    df: DataFrame,
    index_column: str,
    new: Column | None,
    old: Column | None = None,
    lookback: Column | None = None,
) -> DataFrame:
    """The rows of the window. Rows without an index value are in no window."""
    condition = in_window(F.col(index_column), new, old, lookback)
    return df if condition is None else df.where(condition)


def extract_windows(df: DataFrame, table_column: str, index_column: str, bounds: DataFrame) -> DataFrame:
    """The windows of many tables kept in one frame.

    ``bounds`` has one row per table: table_name, lower_value, index_value (texts; a NULL lower value means a
    first load). The lowest lower bound and the highest upper bound of all tables are scalar subqueries and prune
    the scan before the join.
    """
    data_type = df.schema[index_column].dataType
    index = F.col(index_column)
    typed = bounds.select(
        F.col("table_name").alias("_table"),
        index_value(F.col("lower_value"), data_type).alias("_lower"),
        index_value(F.col("index_value"), data_type).alias("_upper"),
    )
    # A table without a lower bound takes the common one down to the least value of the type.
    least = F.lit(LEAST[data_type.typeName()]).cast(data_type)
    # Two aggregates of one frame would be merged into a struct, whose fields do not push down; these two are not alike.
    highest = typed.agg(F.max("_upper")).scalar()
    lowest = typed.select(F.coalesce("_lower", least).alias("lo")).orderBy("lo").limit(1).scalar()
    pruned = df.where((index <= highest) & (index >= lowest))
    matched = pruned.join(typed, pruned[table_column] == typed["_table"])
    inside = (index <= F.col("_upper")) & (F.col("_lower").isNull() | (index > F.col("_lower")))
    return matched.where(inside).select(*df.columns)


def index_check(old: Column, new: Column, kind: Column) -> Column:
    """Whether a new index value may follow an old one.

    ``old`` and ``new`` are texts, ``kind`` is the new value's type: ``int``, ``timestamp``, or anything else,
    which cannot be compared. A missing old value is fine; a missing new one, or an old one that cannot be read as
    the new one's type, is not.
    """
    def ordered(old_value: Column, new_value: Column) -> Column:
        return F.coalesce(old_value <= new_value, F.lit(False))

    whole = old.rlike(r"^\s*[+-]?\d+\s*$")
    stamp = old.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}$")
    return (
        F.when(old.isNull(), F.lit(True))
        .when(new.isNull(), F.lit(False))
        .when(kind == "int", whole & ordered(F.trim(old).try_cast("decimal(38,0)"), new.try_cast("decimal(38,0)")))
        .when(kind == "timestamp", stamp & ordered(old.try_cast("timestamp_ntz"), new.try_cast("timestamp_ntz")))
        .otherwise(F.lit(False))
    )


def window_plan(state: DataFrame, marks: DataFrame, runs_back: int = 0) -> DataFrame:
    """The next window of many tables at once: one row per table of ``marks`` (table_name, index_value).

    ``state`` is the log of one database. Tables without history are first loads.
    """
    known = latest_and_lookback(state, runs_back).select(
        "table_name", F.col("index_value").alias("old_index_value"), "lookback_index_value"
    )
    joined = marks.select("table_name", F.col("index_value").alias("new_index_value")).join(known, "table_name", "left")
    lookback = F.col("lookback_index_value") if runs_back else F.lit(None).cast("string")
    return joined.select(
        "table_name",
        F.when(F.col("old_index_value").isNull(), F.lit("first_load")).otherwise(F.lit("incremental")).alias("mode"),
        "old_index_value",
        lookback.alias("lookback_index_value"),
        F.coalesce(lookback, F.col("old_index_value")).alias("lower_value"),
        "new_index_value",
    )


def window_coverage(windows: DataFrame, keys: Sequence[str], order: str, lower: str, upper: str) -> DataFrame:
    """Whether the logged windows of each key follow each other: the windows with reached, step and island.

    ``reached`` is the greatest upper bound of the windows before, in the order of ``order`` (a key's run times, no two alike).
    ``step`` is ``first`` for a key's first window, ``back`` if a window ends below what was reached, ``overlap`` if it begins
    there, ``gap`` if it begins above it, so that rows between were never loaded, and else ``adjoins``. ``island`` numbers, from
    1, the runs of windows without a gap. A window without a lower bound covers all below its upper one.
    """
    before = Window.partitionBy(*keys).orderBy(order)
    reached = F.max(upper).over(before.rowsBetween(Window.unboundedPreceding, -1))
    step = (
        F.when(F.row_number().over(before) == 1, "first")
        .when(F.col(upper) < F.col("reached"), "back")
        .when(F.col(lower) > F.col("reached"), "gap")
        .when(F.coalesce(F.col(lower) < F.col("reached"), F.lit(True)), "overlap")
        .otherwise("adjoins")
    )
    found = windows.withColumn("reached", reached).withColumn("step", step)
    gaps = F.sum((F.col("step") == "gap").cast("long")).over(before)
    return found.withColumn("island", gaps + 1)


def _as_number(index: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.TimestampNTZType):
        return F.unix_micros(F.to_timestamp_ltz(index))
    return F.unix_micros(index) if isinstance(data_type, T.TimestampType) else index.cast("long")


#: The size of the sketch of an index column: ranks are right to about 0.2 %, whatever the number of rows.
SKETCH_K = 2000


def balanced_bounds(df: DataFrame, index_column: str, parts: int) -> list[Any]:
    """The greatest values of ``parts`` ranges of an index column that hold about as many rows each; the last range has no end.

    One pass gives a quantile sketch of fixed size; it is combined per task, and a few numbers come back. A value that very
    many rows share cannot be cut, so there may be fewer ranges. Rows without an index value are not looked at.
    """
    data_type = df.schema[index_column].dataType
    sketch = F.kll_sketch_agg_bigint(_as_number(F.col(f"`{index_column}`"), data_type), F.lit(SKETCH_K))
    ranks = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    if parts < 2:
        return []
    known = F.when(F.kll_sketch_get_n_bigint("s") > 0, F.kll_sketch_get_quantile_bigint("s", ranks))
    ends = df.agg(sketch.alias("s")).select(F.explode(known).alias("n")).distinct()
    if isinstance(data_type, T.TimestampNTZType):
        ends = ends.select(F.timestamp_micros("n").cast("timestamp_ntz").alias("n"))
    elif isinstance(data_type, T.TimestampType):
        ends = ends.select(F.timestamp_micros("n").alias("n"))
    return sorted(r["n"] for r in ends.where("n IS NOT NULL").collect())


def balanced_range(index_column: str, ends: Sequence[Any]) -> Column:
    """The number, from 0, of the range of :func:`balanced_bounds` that a row is in; NULL without an index value."""
    found = F.when(F.col(f"`{index_column}`").isNull(), None)
    for number, end in enumerate(ends):
        found = found.when(F.col(f"`{index_column}`") <= F.lit(end), number)
    return found.otherwise(len(ends))


def footer_high_water_mark(spark: SparkSession, path: str, index_column: str) -> DataFrame:
    """The greatest index value of a folder of Parquet files, as :func:`high_water_mark` gives it, from the files' footers.

    The V2 reader answers a maximum of whole numbers from statistics and reads no data; for types whose statistics do not tell
    (timestamps among them) it falls back to the column.
    """
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    # Which reader a frame has is decided when it is made.
    first = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in first.split(",") if x != "parquet"))
    try:
        rows = spark.read.parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", first)
    return high_water_mark(rows, index_column)
