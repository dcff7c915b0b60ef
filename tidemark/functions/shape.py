"""JSON text of drifting shape, as variants: its members are read whatever else it holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def variant_of(text: Column) -> Column:
    """A text's JSON value; NULL for text that is none."""
    return F.try_parse_json(text)


def shapes(df: DataFrame, by: str, text: str) -> DataFrame:
    """For each value of ``by``: row_count, malformed (texts that are no JSON), and shape, which all other texts fit.

    One pass; shapes are merged per task.
    """
    value = variant_of(F.col(text))
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(text).isNotNull() & value.isNull()).alias("malformed"),
        F.schema_of_variant_agg(value).alias("shape"),
    )


def member(text: Column, path: str, data_type: str) -> Column:
    """A member of a JSON text as a type; NULL where the text, the member or the type does not fit."""
    return F.try_variant_get(variant_of(text), path, data_type)
