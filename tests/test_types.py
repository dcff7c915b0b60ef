from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import types as ty

# MySQL types, also as MySQL 8 reports them, and the types that they must get.
MYSQL = {
    "tinyint": "smallint",
    "tinyint(3) unsigned": "smallint",
    "tinyint unsigned": "smallint",
    "SMALLINT(5) UNSIGNED": "integer",
    "smallint unsigned": "integer",
    "smallint": "smallint",
    "mediumint unsigned": "integer",
    "int(7)": "integer",
    "int unsigned": "bigint",
    "int unsigned zerofill": "bigint",
    "integer": "integer",
    "bigint": "bigint",
    "bigint unsigned": "numeric(65, 0)",
    "bigint(20) unsigned zerofill": "numeric(65, 0)",
    "float unsigned": "real",
    "float(7,3)": "real",
    "double unsigned": "double precision",
    "decimal(12,3) unsigned": "decimal(12,3)",
    "numeric(9)": "numeric(9)",
    "bit(1)": "boolean",
    "bit(17)": "varchar(17)",
    "char(3)": "varchar(12)",
    "varchar(33)": "varchar(132)",
    "varchar(16384)": "varchar(65535)",
    "longtext": "varchar(65535)",
    "blob": "varchar(65535)",
    "json": "varchar(65535)",
    "set('on','off')": "varchar(65535)",
    "interval unsigned": "varchar(65535)",
    "date": "date",
    "time(3)": "varchar(40)",
    "datetime(3)": "timestamp",
    "timestamp": "timestamp",
    "year": "integer",
    "year(4)": "integer",
}


@pytest.mark.parametrize("source", MYSQL)
def test_mysql_type(source):
    assert ty.mysql_type(source) == MYSQL[source]


def test_mysql_type_column_agrees(spark):
    frame = spark.createDataFrame([(s,) for s in [*MYSQL, None]], "s string")
    got = {r[0]: r[1] for r in frame.select("s", ty.mysql_type_column(F.col("s"))).collect()}
    assert got == {**MYSQL, None: None}


def test_mysql_overrides_ignore_case(spark):
    overrides = {"Year(4)": "varchar(4)"}
    assert ty.mysql_type("year(4)", overrides) == "varchar(4)"
    frame = spark.createDataFrame([("YEAR(4)",), ("year",)], "s string")
    assert [r[0] for r in frame.select(ty.mysql_type_column(F.col("s"), overrides)).collect()] == ["varchar(4)", "integer"]


def test_postgres_types():
    assert ty.postgres_type("int4") == "int4"
    assert ty.postgres_type("text") == "varchar(max)"
    assert ty.postgres_type("uuid") == "char(36)"
    assert ty.postgres_type("money") == "decimal(19,2)"
    assert ty.postgres_type("varchar", size=15) == "varchar(15)"
    assert ty.postgres_type("varchar", size=-1) == "varchar(max)"
    assert ty.postgres_type("numeric", precision=10, scale=2) == "numeric(10,2)"
    assert ty.postgres_type("numeric", precision=10, scale=0) == "numeric(10)"
    assert ty.postgres_type("numeric", precision=65535, scale=65531) == "numeric(38,37)"


def test_postgres_overrides():
    overrides = {"Enum1": "varchar(15)", "numeric(10,2)": "real", "columns": {"c": "bigint"}, "text": "varchar(9)"}
    assert ty.postgres_type("enum1", type_map=overrides) == "varchar(15)"
    assert ty.postgres_type("numeric", precision=10, scale=2, type_map=overrides) == "real"
    assert ty.postgres_type("numeric", column="c", precision=10, scale=2, type_map=overrides) == "bigint"
    assert ty.postgres_type("text", type_map=overrides) == "varchar(9)"


@pytest.mark.parametrize(
    ("target", "wanted"),
    [
        ("int4", (T.IntegerType(), None)),
        ("double precision", (T.DoubleType(), None)),
        ("decimal(19,2)", (T.DecimalType(19, 2), None)),
        ("numeric(65, 0)", (T.DecimalType(38, 0), None)),
        ("numeric(38,37)", (T.DecimalType(38, 18), None)),
        ("numeric(10)", (T.DecimalType(10, 0), None)),
        ("varchar(max)", (T.StringType(), 65535)),
        ("VARCHAR(15)", (T.StringType(), 15)),
        ("char(36)", (T.StringType(), 36)),
        ("timestamp", (T.TimestampNTZType(), None)),
        ("boolean", (T.BooleanType(), None)),
    ],
)
def test_spark_types(target, wanted):
    assert ty.spark_type(target) == wanted


def test_override_types(spark):
    schema = T.StructType.fromDDL("a string, b decimal(10,2), c int NOT NULL")
    got = ty.override_types(schema, {"columns": {"a": "varchar(5)"}, "decimal(10,2)": "real", "int": "bigint"})
    assert got["a"].metadata == {"width": 5}
    assert got["b"].dataType == T.FloatType()
    assert got["c"].dataType == T.LongType() and not got["c"].nullable


def test_postgres_type_column_agrees(spark):
    names = ["int4", "varchar", "numeric", "text", "uuid", "money", "Enum1", "enum1", "decimal"]
    rows = [(n, c, s, p, q) for n in names for c in ("c", "x") for s in (-1, 20) for p, q in ((10, 2), (60, 50), (5, 0))]
    rows = [(n, c, s, *((p, q) if n in ("numeric", "decimal") else (None, None))) for n, c, s, p, q in rows]
    overrides = {"Enum1": "varchar(15)", "numeric(10,2)": "real", "columns": {"c": "bigint"}}
    frame = spark.createDataFrame(rows, "n string, c string, s int, p int, q int")
    for given in (overrides, None):
        target = ty.postgres_type_column(*[F.col(x) for x in "ncspq"], type_map=given)
        for r in frame.withColumn("got", target).collect():
            assert r.got == ty.postgres_type(r.n, r.c, r.s, r.p, r.q, given)
