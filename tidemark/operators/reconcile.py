"""Source and target schemas: which columns differ, whether a load may go on, and how rows are made to fit."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OK = "ok"
REBUILD = "rebuild"
MISSING = "non-existent"
INCORRECT = "incorrect"


def target_status(source: Collection[str], target: Collection[str], dropped: Collection[str] = (), rebuild: bool = False) -> str:
    """Whether a target can take the source's rows. Only names count, not types or order."""
    if not target:
        return MISSING
    if rebuild:
        return REBUILD
    return INCORRECT if set(target) - (set(source) - set(dropped)) else OK


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns on one side only, for many tables at once.

    Both frames list (table_name, column_name). ``side`` is ``source`` or ``target``. Each side is made distinct
    before the join, so a column that is listed often costs nothing there.
    """
    key = ["table_name", "column_name"]
    left = source.select(*key).distinct().withColumn("in_source", F.lit(True))
    right = target.select(*key).distinct().withColumn("in_target", F.lit(True))
    both = left.join(right, key, "full")
    side = F.when(F.col("in_target").isNull(), F.lit("source")).when(F.col("in_source").isNull(), F.lit("target"))
    return both.select(*key, side.alias("side")).where(F.col("side").isNotNull())


def target_statuses(source: DataFrame, target: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """:func:`target_status` for many tables at once: one row per source table.

    ``source`` and ``target`` list (table_name, column_name); ``rebuilt`` lists the table_name of tables to rebuild.
    The lists are tagged and aggregated together, so that a table's columns are counted without collecting them.
    """
    tagged = reduce(
        DataFrame.unionAll,
        [
            source.select("table_name", "column_name", F.lit(1).alias("s"), F.lit(0).alias("t"), F.lit(0).alias("r")),
            target.select("table_name", "column_name", F.lit(0).alias("s"), F.lit(1).alias("t"), F.lit(0).alias("r")),
            rebuilt.select(
                "table_name", F.lit(None).cast("string").alias("column_name"),
                F.lit(0).alias("s"), F.lit(0).alias("t"), F.lit(1).alias("r"),
            ),
        ],
    )
    columns = tagged.groupBy("table_name", "column_name").agg(F.max("s").alias("s"), F.max("t").alias("t"), F.max("r").alias("r"))
    tables = columns.groupBy("table_name").agg(
        F.max("s").alias("in_source"),
        F.sum("t").alias("target_columns"),
        F.sum(F.when((F.col("t") == 1) & (F.col("s") == 0), 1).otherwise(0)).alias("extra_target_columns"),
        F.sum(F.when((F.col("s") == 1) & (F.col("t") == 0), 1).otherwise(0)).alias("extra_source_columns"),
        F.max("r").alias("rebuild"),
    )
    status = (
        F.when(F.col("target_columns") == 0, F.lit(MISSING))
        .when(F.col("rebuild") == 1, F.lit(REBUILD))
        .when(F.col("extra_target_columns") > 0, F.lit(INCORRECT))
        .otherwise(F.lit(OK))
    )
    return tables.where(F.col("in_source") == 1).select(
        "table_name", status.alias("status"), "extra_target_columns", "extra_source_columns"
    )


def conform_to_target(df: DataFrame, target: T.StructType) -> DataFrame:
    """The target's columns, by name, in its order and types; text is cut to the width its column declares."""
    columns = []
    for f in target.fields:
        c = F.col(f"`{f.name}`").cast(f.dataType)
        if (width := f.metadata.get("width")) is not None:
            c = F.substring(c, 1, width)
        columns.append(c.alias(f.name, metadata=f.metadata))
    return df.select(*columns)


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column that must not have any: one pass, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return unpivot(counts, columns, "column_name", "violations")


def unpivot(one_row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    return one_row.unpivot([], list(columns), name, value)


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows as one row. Rows are counted per key on the map side first."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def text_size(c: Column, data_type: T.DataType) -> Column:
    """Bytes of a value's text; NULL for types without one."""
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.lit(None).cast("int")
    return F.octet_length(c if isinstance(data_type, T.BinaryType) else c.cast("string"))


def schema_profile(df: DataFrame, table_name: str) -> DataFrame:
    """A table's columns in order with their staging type, NULL count and longest text, from one scan."""
    from tidemark.functions.types import staging_schema

    staged = staging_schema(df.schema)
    fields = df.schema.fields
    counts = df.agg(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(staged[f.name].dataType.simpleString().replace("bigint", "long")).alias("staging_type"),
                F.count_if(F.col(f.name).isNull()).alias("null_count"),
                F.coalesce(F.max(text_size(F.col(f.name), f.dataType)), F.lit(0)).cast("long").alias("max_bytes"),
            ).alias(f"c{position}")
            for position, f in enumerate(fields, 1)
        ]
    )
    rows = F.explode(F.array(*[F.col(f"c{i}") for i in range(1, len(fields) + 1)]))
    return counts.select(rows.alias("c")).select(F.lit(table_name).alias("table_name"), "c.*")
