"""One select, composed from the schema, that brings every column to the form the target takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.jsontext import escape_unprintable, json_text
from tidemark.functions.temporal import (
    INTEGER_TYPES,
    TIMESTAMP_TYPES,
    interval_time_of_day,
    iso_date,
    iso_time,
    iso_timestamp,
)
from tidemark.functions.text import MAX_TEXT, ascii_fold, binary_text, decimal_text, truncate_text

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def _as_text(c: Column, data_type: T.DataType) -> Column | None:
    """The text form of values that no target column can hold as they are, else None."""
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return ascii_fold(c)
    if isinstance(data_type, T.BinaryType):
        return binary_text(c)
    if isinstance(data_type, _NESTED):
        return json_text(c, data_type)
    if isinstance(data_type, T.DayTimeIntervalType):
        return interval_time_of_day(c)
    if isinstance(data_type, T.TimeType):
        return iso_time(c)
    return None


def normalize_value(c: Column, data_type: T.DataType, as_staged: bool = False, size: int | None = MAX_TEXT) -> Column:
    """Normalise one column.

    Text is folded to ASCII; bytes, nested values, intervals and times become text; all text is cut at ``size``, if there is one.
    With ``as_staged`` the result has only the staging types string, long, double and boolean: dates, timestamps
    and decimals become text too, and numbers are widened.
    """
    text = _as_text(c, data_type)
    if text is None and as_staged:
        if isinstance(data_type, INTEGER_TYPES):
            return c.cast("long")
        if isinstance(data_type, (T.FloatType, T.DoubleType)):
            return c.cast("double")
        if isinstance(data_type, T.BooleanType):
            return c
        if isinstance(data_type, T.DecimalType):
            text = decimal_text(c, data_type.scale)
        elif isinstance(data_type, TIMESTAMP_TYPES):
            text = iso_timestamp(c, zoned=isinstance(data_type, T.TimestampType))
        elif isinstance(data_type, T.DateType):
            text = iso_date(c)
        else:
            text = c.cast("string")
    return c if text is None else _cut(text, size)


def _cut(text: Column, size: int | None) -> Column:
    return text if size is None else truncate_text(text, size)


def _holds_json(f: T.StructField) -> bool:
    return f.metadata.get("source_kind") == "postgresql" and f.metadata.get("source_type") in ("json", "jsonb")


def normalize_row(df: DataFrame, as_staged: bool = False, size: int | None = MAX_TEXT) -> DataFrame:
    """Normalise all columns in one projection; names, order and comments stay.

    JSON that a database hands over as text is escaped instead of folded, as any other nested value is.
    """
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if _holds_json(f):
            value = _cut(escape_unprintable(c), size)
        else:
            value = normalize_value(c, f.dataType, as_staged, size)
        columns.append(value.alias(f.name, metadata=f.metadata))
    return df.select(*columns)


def cut_texts(df: DataFrame, size: int | None) -> tuple[DataFrame, Column]:
    """The frame with all text cut at ``size``, and an expression over the old frame of how many of a row's values that cuts."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)] if size is not None else []
    long = [F.coalesce((F.char_length(F.col(f"`{n}`")) > size).cast("long"), F.lit(0)) for n in texts]
    cut = {n: truncate_text(F.col(f"`{n}`"), size) for n in texts}
    kept = [
        cut[f.name].alias(f.name, metadata=f.metadata) if f.name in cut else F.col(f"`{f.name}`") for f in df.schema.fields
    ]
    return df.select(*kept), sum(long, F.lit(0).cast("long"))
