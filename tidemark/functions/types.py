"""Source column types to target column types, as text and as Spark types.

Each mapping is a short table of rules. The MySQL table drives a plain function (one type, on the driver, when a
target is created) and a column expression (a catalogue of types as a frame).
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import MAX_TEXT

# The target's limits for decimals.
MAX_PRECISION = 38
MAX_SCALE = 37

# What may follow a type's name: sizes, or the attributes that MySQL 8 reports without one.
_TAIL = r" *(\(.*|(unsigned|zerofill).*)?$"
_UNSIGNED = r"\b.*\bunsigned\b.*$"

# MySQL types. The first pattern that matches the lower-cased type decides.
MYSQL_RULES: tuple[tuple[str, str], ...] = (
    (rf"^tinyint{_TAIL}", "smallint"),
    (rf"^mediumint(eger)?{_TAIL}", "integer"),
    (rf"^float{_TAIL}", "real"),
    (rf"^double{_TAIL}", "double precision"),
    (rf"^smallint{_UNSIGNED}", "integer"),
    (rf"^smallint{_TAIL}", "smallint"),
    (rf"^int(eger)?{_UNSIGNED}", "bigint"),
    (rf"^int(eger)?{_TAIL}", "integer"),
    (rf"^bigint{_UNSIGNED}", "numeric(65, 0)"),
    (rf"^bigint{_TAIL}", "bigint"),
    (r"^bit *(\(1\).*)?$", "boolean"),
    (r"^date *(\(.*)?$", "date"),
    (r"^time *(\(.*)?$", "varchar(40)"),
    (r"^datetime *(\(.*)?$", "timestamp"),
    (r"^timestamp *(\(.*)?$", "timestamp"),
    (rf"^year{_TAIL}", "integer"),
)
MYSQL_DECIMAL = rf"^(decimal|numeric){_TAIL}"
MYSQL_BITS = r"^bit *\((\d+)\).*$"
MYSQL_TEXT = r"^(?:var)?char *\((\d+)\).*$"
# A character takes up to four bytes.
MYSQL_BYTES_PER_CHAR = 4
MYSQL_DEFAULT = f"varchar({MAX_TEXT})"

# Postgres types that get another type in the target.
POSTGRES_DEFAULTS = {
    "text": "varchar(max)",
    "citext": "varchar(max)",
    "jsonb": "varchar(max)",
    "json": "varchar(max)",
    "array": "varchar(max)",
    "uuid": "char(36)",
    "money": "decimal(19,2)",
}

def lower_keys(type_map: Mapping[str, object] | None) -> dict[str, object]:
    """Overrides under their lower-cased and their original names."""
    given = dict(type_map or {})
    return {**given, **{name.lower(): value for name, value in given.items()}}


def mysql_type(source: str, type_map: Mapping[str, str] | None = None) -> str:
    """The target type of a MySQL type such as ``int(11) unsigned``."""
    name = source.lower()
    overrides = lower_keys(type_map)
    if name in overrides:
        return str(overrides[name])
    for pattern, target in MYSQL_RULES:
        if re.match(pattern, name):
            return target
    if re.match(MYSQL_DECIMAL, name):
        return re.sub(" *(unsigned|zerofill)", "", name).rstrip()
    if bits := re.match(MYSQL_BITS, name):
        return f"varchar({bits[1]})"
    if chars := re.match(MYSQL_TEXT, name):
        return f"varchar({min(MAX_TEXT, MYSQL_BYTES_PER_CHAR * int(chars[1]))})"
    return MYSQL_DEFAULT


def mysql_type_column(source: Column, type_map: Mapping[str, str] | None = None) -> Column:
    """:func:`mysql_type` over a column of type texts."""
    name = F.lower(source)
    overrides = {k.lower(): v for k, v in (type_map or {}).items()}
    branches = [(name == F.lit(k), F.lit(v)) for k, v in overrides.items()]
    branches += [(name.rlike(pattern), F.lit(target)) for pattern, target in MYSQL_RULES]
    chars = F.regexp_extract(name, MYSQL_TEXT, 1).try_cast("long")
    sized = F.least(F.lit(MAX_TEXT), chars * MYSQL_BYTES_PER_CHAR).cast("string")
    branches += [
        (name.rlike(MYSQL_DECIMAL), F.rtrim(F.regexp_replace(name, " *(unsigned|zerofill)", ""))),
        (name.rlike(MYSQL_BITS), F.concat(F.lit("varchar("), F.regexp_extract(name, MYSQL_BITS, 1), F.lit(")"))),
        (name.rlike(MYSQL_TEXT), F.concat(F.lit("varchar("), sized, F.lit(")"))),
    ]
    chosen = F.when(source.isNull(), F.lit(None).cast("string"))
    for condition, target in branches:
        chosen = chosen.when(condition, target)
    return chosen.otherwise(F.lit(MYSQL_DEFAULT))


def postgres_type(
    source: str,
    column: str | None = None,
    size: int = -1,
    precision: int | None = None,
    scale: int | None = None,
    type_map: Mapping[str, object] | None = None,
) -> str:
    """The target type of a Postgres column.

    An override for the column wins, then one for the sized type such as ``numeric(10,2)``, then one for the name.
    """
    overrides = {**POSTGRES_DEFAULTS, **lower_keys(type_map)}
    by_column = overrides.pop("columns", {})
    if column in by_column:
        return by_column[column]
    name = str(overrides.get(source, source))
    if name.lower() in ("decimal", "numeric"):
        precision, scale = min(int(precision), MAX_PRECISION), min(int(scale), MAX_SCALE)
    if name == "varchar":
        sizes = [str(size) if size > 0 else "max"]
    else:
        sizes = [str(n) for n in (precision, scale) if n]
    sized = f"{name}({','.join(sizes)})" if sizes else name
    return str(overrides.get(sized, sized))


def postgres_type_column(
    source: Column,
    column: Column,
    size: Column,
    precision: Column,
    scale: Column,
    type_map: Mapping[str, object] | None = None,
) -> Column:
    """:func:`postgres_type` over columns that describe one source column per row."""
    overrides = {**POSTGRES_DEFAULTS, **lower_keys(type_map)}
    by_column = overrides.pop("columns", {})

    def replaced(name: Column, pairs: Mapping[str, object]) -> Column:
        if not pairs:
            return name
        found = F.create_map(*[F.lit(str(x)) for pair in pairs.items() for x in pair])
        return F.coalesce(F.try_element_at(found, name), name)

    name = replaced(source, overrides)
    exact = F.lower(name).isin("decimal", "numeric")
    digits = F.when(exact, F.least(precision, F.lit(MAX_PRECISION))).otherwise(precision)
    behind = F.when(exact, F.least(scale, F.lit(MAX_SCALE))).otherwise(scale)
    numbers = F.concat_ws(",", F.when(digits != 0, digits.cast("string")), F.when(behind != 0, behind.cast("string")))
    length = F.when(size > 0, size.cast("string")).otherwise(F.lit("max"))
    sizes = F.when(name == "varchar", length).otherwise(numbers)
    sized = F.when(sizes == "", name).otherwise(F.concat(name, F.lit("("), sizes, F.lit(")")))
    own = F.try_element_at(F.create_map(*[F.lit(str(x)) for p in by_column.items() for x in p]), column) if by_column else None
    return replaced(sized, overrides) if own is None else F.coalesce(own, replaced(sized, overrides))


_TARGET_TYPES: dict[str, T.DataType] = {
    "smallint": T.ShortType(),
    "int2": T.ShortType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "int4": T.IntegerType(),
    "bigint": T.LongType(),
    "int8": T.LongType(),
    "long": T.LongType(),
    "oid": T.LongType(),
    "real": T.FloatType(),
    "float4": T.FloatType(),
    "double precision": T.DoubleType(),
    "double": T.DoubleType(),
    "float8": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(),
}


def spark_type(target: str) -> tuple[T.DataType, int | None]:
    """The Spark type of a target type text, and the width that text is cut to."""
    text = " ".join(target.lower().split())
    name, _, sizes = text.rstrip(")").partition("(")
    name = name.strip()
    if name in _TARGET_TYPES:
        return _TARGET_TYPES[name], None
    numbers = [int(n) for n in re.findall(r"\d+", sizes)]
    if name in ("decimal", "numeric"):
        precision, scale = (numbers + [18, 0])[:2] if not numbers else (numbers + [0])[:2]
        if scale >= MAX_SCALE:
            # An unconstrained numeric: one digit before the point would hold nothing of use.
            return T.DecimalType(MAX_PRECISION, 18), None
        return T.DecimalType(min(precision, MAX_PRECISION), scale), None
    if name in ("varchar", "char", "bpchar", "character varying", "character"):
        return T.StringType(), min(numbers[0], MAX_TEXT) if numbers else MAX_TEXT
    return T.StringType(), None


def _declared(f: T.StructField, type_map: Mapping[str, object] | None) -> str | None:
    """The target type that a database column's own type maps to, overrides included."""
    about = f.metadata
    if about.get("source_kind") == "mysql":
        by_name = {k: v for k, v in (type_map or {}).items() if k != "columns"}
        return mysql_type(about["source_type"], by_name)
    if about.get("source_kind") == "postgresql":
        own = about["source_type"]
        sized = own.lower() in ("numeric", "decimal")
        precision, scale = (about.get("digits", 65535), about.get("scale", 65535)) if sized else (None, None)
        return postgres_type(own, f.name, about.get("text_size", -1), precision, scale, type_map)
    return None


def override_types(schema: T.StructType, type_map: Mapping[str, object] | None) -> T.StructType:
    """The types a target is created with.

    Overrides are looked up by column name, by Spark type text, and by that text's name without its size. Columns of
    a database go by their own type instead. The width of a sized text type is kept in the field's metadata.
    """
    overrides = lower_keys(type_map)
    by_column = overrides.pop("columns", {})
    fields = []
    for f in schema.fields:
        text = f.dataType.simpleString().lower()
        wanted = by_column.get(f.name, overrides.get(text, overrides.get(text.split("(")[0])))
        wanted = wanted if wanted is not None else _declared(f, type_map)
        if wanted is None:
            fields.append(f)
            continue
        data_type, width = spark_type(str(wanted))
        metadata = {**f.metadata, "width": width} if width is not None else f.metadata
        fields.append(T.StructField(f.name, data_type, f.nullable, metadata))
    return T.StructType(fields)


def staging_schema(schema: T.StructType) -> T.StructType:
    """The nullable string / long / double / boolean form of a schema."""
    def staged(data_type: T.DataType) -> T.DataType:
        if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return T.LongType()
        if isinstance(data_type, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        return data_type if isinstance(data_type, T.BooleanType) else T.StringType()

    return T.StructType([T.StructField(f.name, staged(f.dataType), True) for f in schema.fields])
