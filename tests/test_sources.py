from __future__ import annotations

import pytest

from tidemark.functions import normalize_row
from tidemark.plans.sync import new_target_schema
from tidemark.sources import jdbc, reader, sqltext
from tidemark.spec import SourceSpec, SyncSpec


def source(kind, **options):
    return SourceSpec("a", "db1", kind, options=options)


def test_urls():
    assert jdbc.jdbc_url("postgresql", "h", "d", extra={"sslmode": "require"}) == "jdbc:postgresql://h:5432/d?sslmode=require"
    assert jdbc.jdbc_url("mysql", "h", "d", 99) == "jdbc:mysql://h:99/d"
    assert jdbc.jdbc_url("mssql", "h", "d", extra={"encrypt": "true"}) == "jdbc:sqlserver://h:1433;databaseName=d;encrypt=true"


def test_connection_options():
    options = jdbc.connection_options(source("postgresql", host="h", user="u", password="p"))
    assert options["url"] == "jdbc:postgresql://h:5432/db1"
    assert (options["user"], options["password"], options["fetchsize"]) == ("u", "p", "10000")
    assert options["driver"] == "org.postgresql.Driver"
    assert "host" not in options
    assert jdbc.connection_options(source("postgresql", url="jdbc:x", fetchsize="5"))["fetchsize"] == "5"


def test_mysql_zero_dates_follow_the_spec():
    plain = jdbc.connection_options(source("mysql", host="h"))["url"]
    assert plain == "jdbc:mysql://h:3306/db1?useCursorFetch=true&zeroDateTimeBehavior=CONVERT_TO_NULL&tinyInt1isBit=false&yearIsDateType=false"
    assert "&zeroDateTimeBehavior=ROUND&" in jdbc.connection_options(source("mysql", host="h"), zero_dates=True)["url"]


def test_high_water_queries():
    assert jdbc.high_water_query("postgresql", "t", 'a"b') == 'SELECT MAX("a""b") AS index_value FROM "t"'
    assert jdbc.high_water_query("mysql", "t", "c") == "SELECT MAX(`c`) AS index_value FROM `t`"
    with pytest.raises(NotImplementedError):
        jdbc.high_water_query("mssql", "t", "c")


def test_money_is_cast_in_the_database():
    columns = [("a", "integer"), ("m", "money")]
    assert jdbc.select_query("postgresql", "t", columns) == 'SELECT "a", "m"::decimal(19,2) AS "m" FROM "t"'
    assert jdbc.select_query("postgresql", "t", columns, "decimal(10,1)").count("decimal(10,1)") == 1
    assert jdbc.select_query("mysql", "t", columns) == "SELECT `a`, `m` FROM `t`"


def test_catalogue_queries():
    text = jdbc.column_query("postgresql", "it's", ["x", "y"])
    assert "table_name = 'it''s'" in text and "NOT IN ('x', 'y')" in text and text.endswith("ordinal_position")
    assert "DATABASE()" in jdbc.primary_key_query("mysql", "t")
    assert "PRIMARY KEY" in jdbc.primary_key_query("postgresql", "t")
    assert jdbc.table_comment_query("mysql", "t") is None


def test_times_are_read_as_text():
    assert jdbc.select_query("mysql", "t", [("a", "time(6)"), ("b", "timestamp")]) == (
        "SELECT CAST(`a` AS CHAR) AS `a`, `b` FROM `t`"
    )
    assert 'CAST("a" AS TEXT) AS "a"' in jdbc.select_query("postgresql", "t", [("a", "time")])


def catalogue_row(name, data_type, **given):
    return {"column_name": name, "data_type": data_type, "is_nullable": "YES", "comment": None, **given}


def test_postgres_columns_keep_their_own_types(spark):
    rows = spark.sql("SELECT 'b' AS kind, CAST(1 AS DECIMAL(38,18)) AS n, 'x' AS t, 1L AS id, '{\"k\": \"é\"}' AS j")
    described = reader.described(
        rows,
        [
            catalogue_row("kind", "enum1"),
            catalogue_row("n", "numeric"),
            catalogue_row("t", "varchar", text_size=63, comment="note"),
            catalogue_row("id", "int8", is_nullable="NO"),
            catalogue_row("j", "jsonb"),
        ],
        "postgresql",
    )
    normal = normalize_row(described)
    assert normal.first().j == r'{"k": "\u00e9"}'
    spec = SyncSpec(source("postgresql"), "s", "t", type_map={"enum1": "varchar(15)"})
    schema = new_target_schema(spec, normal, described.schema)
    assert schema["kind"].metadata["width"] == 15
    assert schema["n"].dataType.simpleString() == "decimal(38,18)"
    assert (schema["t"].metadata["width"], schema["t"].metadata["comment"]) == (63, "note")
    assert not schema["id"].nullable
    assert schema["j"].metadata["width"] == 65535


def test_mysql_columns_keep_their_own_types(spark):
    rows = spark.sql("SELECT 1 AS a, 2 AS b, 'é' AS c, true AS d")
    described = reader.described(
        rows,
        [
            catalogue_row("a", "tinyint(1)"),
            catalogue_row("b", "int(11) unsigned"),
            catalogue_row("c", "varchar(10)"),
            catalogue_row("d", "bit(1)"),
        ],
        "mysql",
    )
    spec = SyncSpec(source("mysql"), "s", "t", type_map={"tinyint(1)": "bigint", "columns": {}})
    schema = new_target_schema(spec, normalize_row(described), described.schema)
    assert [f.dataType.simpleString() for f in schema] == ["bigint", "bigint", "string", "boolean"]
    assert schema["c"].metadata["width"] == 40


def test_parallel_ranges_follow_the_window():
    ranges = jdbc.range_options("id", 13, 42, 4)
    options = jdbc.table_options(source("postgresql", host="h"), "SELECT 1", ranges)
    assert options["dbtable"] == "(SELECT 1) src"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("13", "42", "4")
    assert jdbc.range_options("id", None, 42, 4) == {}


def test_a_first_load_is_read_in_ranges_too(spark, monkeypatch):
    asked = []

    def read(spark, options):
        asked.append(options.get("query", options.get("dbtable")))
        columns = [("id", "int4", None, None, None, "NO", None)]
        if "information_schema" in asked[-1]:
            names = "column_name string, data_type string, text_size int, digits int, scale int, is_nullable string, comment string"
            return spark.createDataFrame(columns, names)
        if "MIN(" in asked[-1]:
            return spark.createDataFrame([(3, 99)], "least int, greatest int")
        asked.append({k: options.get(k) for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")})
        return spark.range(5).toDF("id")

    monkeypatch.setattr(jdbc, "read", read)
    spec = SyncSpec(source("postgresql", host="h", numPartitions="8"), "s", "t", index_column="id")
    for refreshed in (spec, spec.forced(full_refresh=True)):
        asked.clear()
        columns = reader.catalogue_columns(spark, refreshed)
        reader.read_table(spark, refreshed, None, None, True, columns)
        assert asked[-1] == {"partitionColumn": "id", "lowerBound": "3", "upperBound": "99", "numPartitions": "8"}
        assert sum("information_schema" in str(q) for q in asked) == 1
    asked.clear()
    reader.read_query(spark, spec.source, "SELECT id FROM a;", {}, "id")
    assert asked[0] == 'SELECT MIN("id") AS least, MAX("id") AS greatest FROM (SELECT id FROM a) src'
    assert asked[1] == "(SELECT id FROM a) src" and asked[2]["numPartitions"] == "8"
    asked.clear()
    reader.read_table(spark, spec, 50, 70, True, columns)
    assert not any("MIN(" in str(q) for q in asked) and asked[-1]["lowerBound"] == "50"


def test_parameters_are_bound(spark):
    got = sqltext.run_sql(spark, "SELECT :run_a + 1 AS x, ':no' AS y -- :neither", {"run_a": 1, "unused": 2})
    assert tuple(got.first()) == (2, ":no")


def test_a_name_without_a_value_is_an_error(spark):
    with pytest.raises(ValueError, match="run_b"):
        sqltext.run_sql(spark, "SELECT :run_b", {"run_a": 1})


def test_literals():
    text = "SELECT a::int, ':x' FROM t WHERE b > :lo AND c = :name AND d IS :none"
    got = sqltext.with_literals(text, {"lo": 5, "name": "O'Hara", "none": None})
    assert got == "SELECT a::int, ':x' FROM t WHERE b > 5 AND c = 'O''Hara' AND d IS NULL"


def test_template_values():
    spec = SyncSpec(
        SourceSpec("a", "db1", data={"zone": "z"}), "src", "dst", "sch", index_column="id", data={"limit": 3}
    )
    values = sqltext.template_values(spec, "1", "2")
    assert values["run_old_index_value"] == "1" and values["run_new_index_value"] == "2"
    assert values["run_destination_table_name"] == "dst" and values["run_db_name"] == "db1"
    assert values["db_zone"] == "z" and values["table_limit"] == 3 and values["index_old_index_value"] == "1"


@pytest.mark.parametrize(
    ("text", "predicate"),
    [
        ("DELETE FROM t WHERE a = 1;", "a = 1"),
        ("delete from s.t\n where a = 1 and b\n", "a = 1 and b"),
        ("DELETE FROM t;", "true"),
        ("a = 1", "a = 1"),
    ],
)
def test_delete_predicate(text, predicate):
    assert sqltext.delete_predicate(text) == predicate
