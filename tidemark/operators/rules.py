"""The spec rules over a frame of settings."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import RUNTIME_RULES, STATIC_RULES, Rule, SpecFlags


def first_conflict(flags: SpecFlags, rules: tuple[Rule, ...] = STATIC_RULES) -> Column:
    """The first broken rule per row; NULL when all hold."""
    return F.coalesce(*[F.when(broken(flags), F.lit(name)) for name, broken in rules])


def spec_conflicts(specs: DataFrame) -> DataFrame:
    """Adds the columns ``conflict`` and ``runtime_conflict`` to a frame with one boolean column per flag.

    Flags that the frame lacks are false.
    """
    flags = SpecFlags(
        **{
            f.name: F.coalesce(F.col(f.name), F.lit(False)) if f.name in specs.columns else F.lit(False)
            for f in fields(SpecFlags)
        }
    )
    return specs.withColumns(
        {"conflict": first_conflict(flags), "runtime_conflict": first_conflict(flags, RUNTIME_RULES)}
    )
