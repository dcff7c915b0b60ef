"""Deletes and changes at the source that incremental runs do not see, found by digests of key ranges.

Both sides give a count and a sum of row hashes for each range of the key. Only ranges that differ are cut into smaller ones and
read again; at last the rows of the smallest differing ranges are compared key by key. So what travels is a few numbers for each
range, and the rows of what has drifted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.load import row_hash
from tidemark.session import written

#: Keys of the smallest ranges, and how many ranges a differing one is cut into.
LEAF, FANOUT = 4096, 64
#: Runs of neighbouring ranges that become a filter of the scan. More of them are met by a join, within their bounds.
MAX_RUNS = 500


def range_digests(df: DataFrame, key: str, columns: Sequence[str], width: int) -> DataFrame:
    """range, n, digest: for each range of ``width`` keys the number of rows and the sum of their hashes. Combined before the
    shuffle; rows without a key are left out."""
    number = F.floor(F.col(f"`{key}`") / F.lit(width)).cast("long")
    hashed = df.where(F.col(f"`{key}`").isNotNull()).select(
        number.alias("range"), row_hash(columns).cast("decimal(20,0)").alias("h")
    )
    return hashed.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("digest"))


def _differing(target: DataFrame, source: DataFrame, key: str, columns: Sequence[str], width: int) -> DataFrame:
    """The ranges whose digests are not the same on both sides, written."""
    left, right = (range_digests(side, key, columns, width) for side in (target, source))
    right = right.select("range", F.col("n").alias("n2"), F.col("digest").alias("digest2"))
    both = left.join(right, "range", "full")
    same = F.col("n").eqNullSafe(F.col("n2")) & F.col("digest").eqNullSafe(F.col("digest2"))
    return written(both.where(~same).select("range"), "ranges")


def runs_of(ranges: Sequence[int], width: int) -> list[tuple[int, int]]:
    """Neighbouring ranges as runs of keys, first and last."""
    runs: list[list[int]] = []
    for number in sorted(ranges):
        if runs and runs[-1][1] + 1 == number:
            runs[-1][1] = number
        else:
            runs.append([number, number])
    return [(a * width, (b + 1) * width - 1) for a, b in runs]


def _between(key: str, first: int, last: int) -> Column:
    return (F.col(f"`{key}`") >= F.lit(first)) & (F.col(f"`{key}`") <= F.lit(last))


def _within(side: DataFrame, ranges: DataFrame, key: str, width: int) -> DataFrame:
    """The rows whose key is in one of the ranges. A filter on the key alone reaches the scan and skips row groups."""
    bounds = ranges.agg(F.min("range").alias("a"), F.max("range").alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not bounds["n"]:
        return side.where(F.lit(False))
    if bounds["n"] <= MAX_RUNS:
        runs = runs_of([r["range"] for r in ranges.collect()], width)
        some = _between(key, *runs[0])
        for run in runs[1:]:
            some |= _between(key, *run)
        # The bounds of all, which are pushed down also where a long alternative is not.
        return side.where(_between(key, runs[0][0], runs[-1][1]) & some)
    near = side.where(_between(key, bounds["a"] * width, (bounds["b"] + 1) * width - 1))
    number = F.floor(F.col(f"`{key}`") / F.lit(width)).cast("long")
    return near.withColumn("_range", number).join(ranges.withColumnRenamed("range", "_range"), "_range", "left_semi").drop("_range")


def source_drift(
    target: DataFrame, source: DataFrame, key: str, columns: Sequence[str] | None = None, leaf: int = LEAF, fanout: int = FANOUT
) -> DataFrame:
    """The keys (a whole-number column) whose rows are not the same on both sides: the key, and change, which is ``deleted``
    (the source lacks it), ``added`` (the target lacks it) or ``changed``.

    ``columns`` are compared, by default all of the target's, which the source has too. A key that several rows share is changed
    when their number or values are. Rows without a key are not compared. Both sides are read whole once, for the widest
    ranges; where nothing differs, that is all.
    """
    columns = list(columns or target.columns)
    ends = [side.agg(F.min(f"`{key}`").alias("a"), F.max(f"`{key}`").alias("b")).first() for side in (target, source)]
    known = [abs(v) for end in ends for v in (end["a"], end["b"]) if v is not None]
    widths = [leaf]
    while known and widths[0] * fanout < 2 * max(known):
        widths.insert(0, widths[0] * fanout)
    for width in widths:
        ranges = _differing(target, source, key, columns, width)
        target, source = (_within(side, ranges, key, width) for side in (target, source))

    def by_key(side: DataFrame, n: str, digest: str) -> DataFrame:
        hashed = row_hash(columns).cast("decimal(20,0)")
        kept = side.where(F.col(f"`{key}`").isNotNull())
        return kept.groupBy(f"`{key}`").agg(F.count(F.lit(1)).alias(n), F.sum(hashed).alias(digest))

    both = by_key(target, "n", "digest").join(by_key(source, "n2", "digest2"), key, "full")
    same = F.col("n").eqNullSafe(F.col("n2")) & F.col("digest").eqNullSafe(F.col("digest2"))
    change = F.when(F.col("n2").isNull(), "deleted").when(F.col("n").isNull(), "added").otherwise("changed")
    return both.where(~same).select(key, change.alias("change"))
