"""How a target's rows are laid out: by a distribution key, hash buckets, and sort keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The hash bucket of a key. NULLs hash too, so every row has one."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def clustered(
    df: DataFrame, by: Sequence[str] = (), sort_keys: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Bring rows with equal ``by`` values together and sort within each task.

    Rebalancing, unlike a plain repartition, lets AQE split a value that holds too many rows and merge small ones.
    ``partitions`` is the number to start from, by default the session's.
    """
    first = [partitions] if partitions else []
    placed = df.hint("rebalance", *first, *[F.col(f"`{c}`") for c in by]) if by else df
    return placed.sortWithinPartitions(*[f"`{c}`" for c in sort_keys]) if sort_keys else placed


def layout_clause(distribution_key: str | None, sort_keys: Sequence[str] = ()) -> str:
    """The layout as text, for a plan of what would be created."""
    parts = [f"distkey({distribution_key})"] if distribution_key else []
    if sort_keys:
        parts.append(f"{'compound ' if len(sort_keys) > 1 else ''}sortkey({','.join(sort_keys)})")
    return "\n".join(parts)


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write a table of the catalogue whose files are split by a hash of the key and sorted by it, and read it back.

    Two tables with the same buckets meet by key without a shuffle. A bucket is one task of the write, so it has one file.
    """
    columns = [F.col(f"`{k}`") for k in keys]
    by_key = df.repartition(buckets, *columns)
    by_key.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
