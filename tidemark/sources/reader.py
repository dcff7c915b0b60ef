"""A source table or a source query as a frame, whatever the kind of source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.extract import project
from tidemark.sources import jdbc, sqltext
from tidemark.spec import DIALECTS, SourceSpec, SyncSpec


def read_table(
    spark: SparkSession, spec: SyncSpec, lower: Any = None, upper: Any = None, cut: bool = False,
    columns: Sequence[Mapping[str, Any]] | None = None,
) -> DataFrame:
    """The source table without its dropped columns, but with its index column in any case.

    With ``cut`` a JDBC read is cut into ranges; the bounds only say where. ``columns`` are those of
    :func:`catalogue_columns` if they were read before.
    """
    source = spec.source
    dropped = [c for c in spec.columns_to_drop if c != spec.index_column]
    if source.kind == "table":
        return project(spark.table(qualified(source, spec.source_table)), dropped)
    if source.kind == "parquet":
        path = f"{source.location.rstrip('/')}/{spec.source_table}{source.suffix}"
        return project(spark.read.parquet(path), dropped)
    if source.kind == "mssql":
        raise NotImplementedError("SQL Server tables need a query_file")
    if columns is None:
        columns = catalogue_columns(spark, spec)
    pairs = [(c["column_name"], c["data_type"]) for c in columns if c["column_name"] not in dropped]
    sql = jdbc.select_query(source.kind, spec.source_table, pairs, str(spec.type_map.get("money", "decimal(19,2)")))
    ranges = read_ranges(spark, source, sql, spec.index_column, lower, upper) if cut else {}
    rows = jdbc.read(spark, jdbc.table_options(source, sql, ranges, bool(spec.not_null_date)))
    return described(rows, columns, source.kind)


def catalogue_columns(spark: SparkSession, spec: SyncSpec) -> list[dict[str, Any]]:
    """What a database says about the columns of a table, read once per run."""
    if spec.source.kind not in ("postgresql", "mysql"):
        return []
    sql = jdbc.column_query(spec.source.kind, spec.source_table)
    return [r.asDict() for r in jdbc.read(spark, jdbc.query_options(spec.source, sql)).collect()]


def read_ranges(
    spark: SparkSession, source: SourceSpec, sql: str, column: str | None, lower: Any = None, upper: Any = None
) -> dict[str, str]:
    """Options for a read in ``numPartitions`` ranges of the index column.

    Bounds that a run does not have, as on a first load or a refresh, are asked for: both in one query. Bounds cut ranges
    and filter nothing, so rows beyond them, and rows without an index value, are read too.
    """
    partitions = int(source.options.get("numPartitions", 1))
    if column is None or partitions <= 1:
        return {}
    if lower is None or upper is None:
        row = jdbc.read(spark, jdbc.query_options(source, jdbc.bounds_query(source.kind, sql, column))).first()
        lower = row["least"] if lower is None else lower
        upper = row["greatest"] if upper is None else upper
    return jdbc.range_options(column, lower, upper, partitions)


def described(df: DataFrame, columns: Sequence[Mapping[str, Any]], kind: str) -> DataFrame:
    """Put what a database says about its columns into their metadata: comment, own type and sizes."""
    by_name = {c["column_name"]: c for c in columns}

    def metadata(f: T.StructField) -> dict[str, Any]:
        about = by_name.get(f.name, {})
        sizes = {k: about.get(k) for k in ("text_size", "digits", "scale")}
        found = {"comment": about.get("comment"), "source_type": about.get("data_type"), **sizes}
        given = {k: v if isinstance(v, str) else int(v) for k, v in found.items() if v not in (None, "")}
        return {**f.metadata, **given, "source_kind": kind, "required": about.get("is_nullable") == "NO"}

    return df.select(*[F.col(f"`{f.name}`").alias(f.name, metadata=metadata(f)) for f in df.schema.fields])


def qualified(source: SourceSpec, table: str) -> str:
    """The session's name for a table: under its database when the source says so, else as it is."""
    return f"{source.database}.{table}" if source.options.get("qualified") == "true" else table


def table_comment(spark: SparkSession, spec: SyncSpec) -> str | None:
    """The comment on the source table, where the source keeps one."""
    source = spec.source
    if spec.query_file:
        return None
    if source.kind == "table":
        name = qualified(source, spec.source_table)
        return spark.catalog.getTable(name).description if spark.catalog.tableExists(name) else None
    if source.kind in DIALECTS and (sql := jdbc.table_comment_query(source.kind, spec.source_table)):
        return jdbc.read(spark, jdbc.query_options(source, sql)).first()[0]
    return None


def read_query(
    spark: SparkSession, source: SourceSpec, text: str, values: Mapping[str, Any], index_column: str | None = None
) -> DataFrame:
    """The result of SQL text: run by the database for JDBC sources, by Spark for others.

    With an index column, which the text has to return, a database's result is read in ranges of it.
    """
    if source.kind not in DIALECTS:
        return sqltext.run_sql(spark, text, values)
    sql = sqltext.with_literals(text, values).rstrip().rstrip(";")
    ranges = read_ranges(spark, source, sql, index_column)
    return jdbc.read(spark, jdbc.table_options(source, sql, ranges) if ranges else jdbc.query_options(source, sql))


def primary_key(spark: SparkSession, spec: SyncSpec) -> tuple[str, ...]:
    """The configured key, else the one a database declares. Files and views declare none."""
    if spec.primary_key or spec.source.kind not in ("postgresql", "mysql") or spec.query_file:
        return spec.primary_key
    sql = jdbc.primary_key_query(spec.source.kind, spec.source_table)
    rows = jdbc.read(spark, jdbc.query_options(spec.source, sql)).collect()
    return tuple(r["column_name"] for r in rows)
