"""Projections of a source: dropped columns, cast columns, zero dates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.types import spark_type

# Fixed value: the target type of money columns.
MONEY = "decimal(19,2)"


def project(df: DataFrame, columns_to_drop: Sequence[str] = ()) -> DataFrame:
    """All columns in source order but the dropped ones, as an explicit list so that the scan is pruned."""
    dropped = set(columns_to_drop)
    return df.select(*[f"`{c}`" for c in df.columns if c not in dropped])


def money(c: Column, target: str = MONEY) -> Column:
    return c.cast(spark_type(target)[0])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns to target types given as text, such as ``{"price": "decimal(19,2)"}``."""
    casts = {}
    for name, target in types.items():
        data_type, width = spark_type(target)
        column = F.col(name).cast(data_type)
        casts[name] = column if width is None else F.substring(column, 1, width)
    return df.withColumns(casts)
