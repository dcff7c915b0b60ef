"""Reads from PostgreSQL, MySQL and SQL Server through Spark's JDBC source.

Windows are pushed into the database's own WHERE. When the index column is a number or a timestamp, the window is
also cut into ranges that are read in parallel, instead of through one cursor.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.spec import SourceSpec

DRIVERS = {
    "postgresql": "org.postgresql.Driver",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "mssql": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
}
PORTS = {"postgresql": 5432, "mysql": 3306, "mssql": 1433}
QUOTES = {"postgresql": ('"', '"'), "mysql": ("`", "`"), "mssql": ("[", "]")}
FETCH_SIZE = 10_000


def quoted(kind: str, name: str) -> str:
    opening, closing = QUOTES[kind]
    return opening + name.replace(closing, closing * 2) + closing


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def jdbc_url(kind: str, host: str, database: str, port: int | None = None, extra: Mapping[str, str] | None = None) -> str:
    port = port or PORTS[kind]
    extra = extra or {}
    if kind == "mssql":
        settings = "".join(f";{k}={v}" for k, v in {"databaseName": database, **extra}.items())
        return f"jdbc:sqlserver://{host}:{port}{settings}"
    settings = "&".join(f"{k}={v}" for k, v in extra.items())
    return f"jdbc:{kind}://{host}:{port}/{database}" + (f"?{settings}" if settings else "")


def connection_options(source: SourceSpec, zero_dates: bool = False) -> dict[str, str]:
    """Options that every read of a source shares. A ``url`` option wins over ``host`` and ``port``.

    ``zero_dates`` asks MySQL for year one in place of dates that are present but not valid; they are NULL otherwise.
    """
    given = {str(k): str(v) for k, v in source.options.items()}
    host, port = given.pop("host", "localhost"), given.pop("port", None)
    url = given.pop("url", None) or jdbc_url(source.kind, host, source.database, int(port) if port else None)
    options = {
        "url": url,
        "driver": DRIVERS[source.kind],
        "fetchsize": str(FETCH_SIZE),
        "preferTimestampNTZ": "true",
        **given,
    }
    if source.kind == "mysql":
        # Rows are streamed instead of buffered as a whole.
        separator = "&" if "?" in url else "?"
        behaviour = "ROUND" if zero_dates else "CONVERT_TO_NULL"
        # Without the last two, tinyint(1) is a bit and year a date: other values would be lost.
        options["url"] = (
            f"{url}{separator}useCursorFetch=true&zeroDateTimeBehavior={behaviour}"
            "&tinyInt1isBit=false&yearIsDateType=false"
        )
    return options


def high_water_query(kind: str, table: str, index_column: str) -> str:
    """The newest index value, found by the database. SQL Server tables need an SQL text of their own."""
    if kind == "mssql":
        raise NotImplementedError("SQL Server tables need index_sql")
    return f"SELECT MAX({quoted(kind, index_column)}) AS index_value FROM {quoted(kind, table)}"


def bounds_query(kind: str, sql: str, column: str, alias: str = "src") -> str:
    """The least and the greatest value of a query's column, for a parallel read of all of it."""
    name = quoted(kind, column)
    return f"SELECT MIN({name}) AS least, MAX({name}) AS greatest FROM ({sql}) {alias}"


def primary_key_query(kind: str, table: str) -> str:
    """A query with one row per key column, in key order."""
    name = text_literal(table)
    if kind == "mssql":
        raise NotImplementedError("SQL Server tables need primary_key")
    schema = "current_schema()" if kind == "postgresql" else "DATABASE()"
    return (
        "SELECT k.column_name AS column_name FROM information_schema.table_constraints c "
        "JOIN information_schema.key_column_usage k ON k.constraint_name = c.constraint_name "
        "AND k.table_schema = c.table_schema AND k.table_name = c.table_name "
        f"WHERE c.constraint_type = 'PRIMARY KEY' AND c.table_schema = {schema} AND c.table_name = {name} "
        "ORDER BY k.ordinal_position"
    )


def column_query(kind: str, table: str, dropped: Sequence[str] = ()) -> str:
    """A query with the columns of a table in order: name, own type, sizes, nullability and comment."""
    name = text_literal(table)
    if kind == "postgresql":
        comment = f"pg_catalog.col_description({name}::regclass, ordinal_position::int)"
        own_type, schema = "udt_name", "current_schema()"
    elif kind == "mysql":
        comment, own_type, schema = "column_comment", "column_type", "DATABASE()"
    else:
        comment, own_type, schema = "CAST(NULL AS VARCHAR(1))", "data_type", "SCHEMA_NAME()"
    without = f" AND column_name NOT IN ({', '.join(map(text_literal, dropped))})" if dropped else ""
    return (
        f"SELECT column_name AS column_name, {own_type} AS data_type, character_maximum_length AS text_size, "
        "numeric_precision AS digits, numeric_scale AS scale, is_nullable AS is_nullable, "
        f"{comment} AS comment FROM information_schema.columns "
        f"WHERE table_schema = {schema} AND table_name = {name}{without} ORDER BY ordinal_position"
    )


def table_comment_query(kind: str, table: str) -> str | None:
    if kind != "postgresql":
        return None
    return f"SELECT pg_catalog.obj_description({text_literal(table)}::regclass, 'pg_class') AS comment"


def select_query(kind: str, table: str, columns: Sequence[tuple[str, str]], money: str = "decimal(19,2)") -> str:
    """An explicit column list from (name, type) pairs.

    Postgres money is cast, which loses nothing. Times of day are read as text: as such they are kept.
    """
    def item(name: str, data_type: str) -> str:
        text = quoted(kind, name)
        own = data_type.lower().split("(")[0]
        if kind == "postgresql" and own == "money":
            return f"{text}::{money} AS {text}"
        if own == "time":
            return f"CAST({text} AS {'CHAR' if kind == 'mysql' else 'TEXT'}) AS {text}"
        return text

    return f"SELECT {', '.join(item(*c) for c in columns)} FROM {quoted(kind, table)}"


def range_options(column: str, lower: Any, upper: Any, partitions: int) -> dict[str, str]:
    """Options for a parallel read in ranges of a column; empty when there is nothing to cut."""
    if lower is None or upper is None or partitions <= 1:
        return {}
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def range_predicates(kind: str, column: str, ends: Sequence[Any]) -> list[str]:
    """Conditions that cut a table into the ranges of :func:`tidemark.operators.bounds.balanced_bounds`, one per read; rows
    without an index value go with the first. Each row meets exactly one."""
    name = quoted(kind, column)
    literals = [str(e) if isinstance(e, int) else text_literal(str(e)) for e in ends]
    if not ends:
        return ["1 = 1"]
    first = [f"{name} IS NULL OR {name} <= {literals[0]}"]
    inner = [f"{name} > {a} AND {name} <= {b}" for a, b in zip(literals, literals[1:])]
    return [*first, *inner, f"{name} > {literals[-1]}"]


def read_in_ranges(spark: SparkSession, options: Mapping[str, str], predicates: Sequence[str]) -> DataFrame:
    """A parallel read of ``dbtable``, one task for each condition."""
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=list(predicates), properties=rest)


def query_options(source: SourceSpec, sql: str) -> dict[str, str]:
    return {**connection_options(source), "query": sql}


def table_options(
    source: SourceSpec, sql: str, ranges: Mapping[str, str] | None = None, zero_dates: bool = False
) -> dict[str, str]:
    """A subquery as a table, which ranges can be put on (the ``query`` option takes none)."""
    return {**connection_options(source, zero_dates), "dbtable": f"({sql}) src", **(ranges or {})}


def read(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
