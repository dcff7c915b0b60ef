"""Load modes: what a target holds after a run, as a frame over the old target and the staged rows.

A target is usually far larger than what is staged. Only keys of the staged side meet the target, so that a small
batch is broadcast by Catalyst (on its known size) and the target is not shuffled. For batches too large for that,
both sides are shuffled on the key, and AQE splits the partition of a key that has a large share of the target. Where
AQE is off, ``salt`` spreads every key over that many partitions instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SALT = "_salt"
_HASH = "_hash"
_EXACT_TEXT = (T.IntegralType, T.StringType, T.DateType, T.TimestampNTZType, T.DecimalType)


def staged_keys(staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct complete keys of the staged rows. Keys with a NULL match nothing and are left out.

    Duplicates are dropped per task before the shuffle, so a key that is staged very often costs nothing there. They
    are grouped by a hash besides the key: the result is then not partitioned by the key alone, and a shuffle join
    reads both of its sides from exchanges of its own. Only such joins have a hot key split by AQE; the price is one
    more shuffle of the bare keys.
    """
    complete = staging.select(*keys).dropna(how="any")
    return complete.withColumn(_HASH, F.xxhash64(*keys)).distinct().select(*keys)


def _matched(target: DataFrame, matches: DataFrame, keys: Sequence[str], how: str, salt: int) -> DataFrame:
    if salt <= 1:
        return target.join(matches, list(keys), how).select(*target.columns)
    # A hash of the whole row: a task that runs again deals its rows out as before.
    row = F.xxhash64(*[F.col(f"`{c}`") for c in target.columns])
    salted_target = target.withColumn(_SALT, F.pmod(row, F.lit(salt).cast("long")))
    every_salt = F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))
    salted_keys = matches.withColumn(_SALT, F.explode(every_salt))
    return salted_target.join(salted_keys, [*keys, _SALT], how).select(*target.columns)


def delete_matching(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    salt: int = 1,
    distinct: bool = True,
) -> DataFrame:
    """Target rows whose key is not staged. Matching is SQL equality: rows with a NULL in the key always stay.

    ``distinct=False`` says that ``staging`` holds each key once already, such as a written result of
    :func:`staged_keys`.
    """
    if not keys:
        raise ValueError("deleting by key needs a key; without one every row would go")
    matches = staged_keys(staging, keys) if distinct else staging.select(*keys)
    return _matched(target, matches, keys, "left_anti", salt)


def matching(target: DataFrame, matches: DataFrame, keys: Sequence[str], salt: int = 1) -> DataFrame:
    """Target rows whose key is among the distinct keys ``matches``: what a load deletes."""
    return _matched(target, matches, keys, "left_semi", salt)


def key_bounds(matches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The number of keys, the bytes they take in memory, about, and, as texts, the bounds of each key column: one row."""
    texts = [agg(k).cast("string").alias(f"{name}_{k}") for k in keys for name, agg in (("min", F.min), ("max", F.max))]
    # A row has some words of its own, and a word for each column besides the bytes of texts.
    fixed = 16 + 8 * len(keys)
    varying = [F.octet_length(k) for k in keys if isinstance(matches.schema[k].dataType, (T.StringType, T.BinaryType))]
    size = F.coalesce(F.sum(sum(varying, F.lit(fixed)).cast("long")), F.lit(0))
    return matches.agg(F.count(F.lit(1)).alias("n"), size.alias("bytes"), *texts)


def within(target: DataFrame, found: Row, keys: Sequence[str]) -> DataFrame:
    """Target rows between the bounds of :func:`key_bounds`, column by column.

    The bounds become literals that reach the scan, so that row groups of other ranges are skipped. Only types whose
    text says everything about a value take part.
    """
    for key in keys:
        data_type = target.schema[key].dataType
        if not isinstance(data_type, _EXACT_TEXT) or found[f"min_{key}"] is None:
            continue
        least, greatest = (F.lit(found[f"{name}_{key}"]).cast(data_type) for name in ("min", "max"))
        target = target.where((F.col(key) >= least) & (F.col(key) <= greatest))
    return target


def insert_all(target: DataFrame, staging: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept; staged columns are matched by name and others are ignored."""
    return target.unionByName(staging.select(*target.columns))


def upsert(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    salt: int = 1,
    matches: DataFrame | None = None,
) -> DataFrame:
    """Delete by key, then insert all staged rows. Staged rows that share a key all survive.

    ``matches`` are the distinct staged keys if they were written beforehand.
    """
    if matches is not None:
        kept = delete_matching(target, matches, keys, salt, distinct=False)
    else:
        kept = delete_matching(target, staging, keys, salt)
    return insert_all(kept, staging)


def upsert_bucketed(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An upsert of two tables that are bucketed alike by the key, see :func:`tidemark.operators.layout.write_bucketed`.

    Buckets meet where they lie: neither side is shuffled or broadcast, however large.
    """
    # The key alone, unlike in ``staged_keys``: so the distinct keys stay in their buckets.
    matches = staging.select(*keys).dropna(how="any").distinct()
    kept = target.join(matches.hint("merge"), list(keys), "left_anti").select(*target.columns)
    return insert_all(kept, staging)


#: Bitmaps of a key filter; each has 32,768 bits in 4 KB.
BITMAPS = 2048
_PLACE, _BITMAP, _BITS = "_place", "_bitmap", "_bits"


def key_bitmap(staging: DataFrame, keys: Sequence[str], bitmaps: int = BITMAPS) -> DataFrame:
    """Which hashes complete keys have, as at most ``bitmaps`` rows of 4 KB each, however many keys there are."""
    place = _place(keys, bitmaps)
    complete = staging.select(*keys).dropna(how="any")
    return complete.groupBy(F.bitmap_bucket_number(place).alias(_BITMAP)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(_BITS)
    )


def _place(keys: Sequence[str], bitmaps: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(bitmaps * 32768)) + 1


def delete_matching_bitmap(target: DataFrame, staging: DataFrame, keys: Sequence[str], bitmaps: int = BITMAPS) -> DataFrame:
    """Target rows whose key is not staged, for more staged keys than can be sent to every executor.

    A bitmap of the staged keys' hashes is broadcast; its size is fixed. Rows whose bit is unset stay without meeting the keys.
    Only the others are shuffled and compared with them, so hashes that are equal by chance lose nothing. The target is read
    twice.
    """
    marked = target.withColumn(_PLACE, F.bitmap_bit_position(_place(keys, bitmaps)))
    marked = marked.withColumn(_BITMAP, F.bitmap_bucket_number(_place(keys, bitmaps)))
    marked = marked.join(F.broadcast(key_bitmap(staging, keys, bitmaps)), _BITMAP, "left")
    # One byte of the bitmap, as a character's code.
    byte = F.ascii(F.decode(F.substring(F.col(_BITS), (F.col(_PLACE) / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    found = F.coalesce(F.bit_get(byte, (F.col(_PLACE) % 8).cast("int")) == 1, F.lit(False))
    doubtful = marked.where(found).select(*target.columns)
    survivors = marked.where(~found).select(*target.columns)
    return survivors.unionAll(delete_matching(doubtful, staging, keys))


def full_refresh(target: DataFrame, staging: DataFrame, staging_is_empty: bool, allow_empty: bool = False) -> DataFrame:
    """The staged rows replace the target; an empty extract leaves it as it is unless that is allowed."""
    if staging_is_empty and not allow_empty:
        return target
    return staging.select(*target.columns)


def scoped_refresh(target: DataFrame, staging: DataFrame, scope: Column) -> DataFrame:
    """Replace only the rows where ``scope`` is true; rows where it is false or unknown stay."""
    return insert_all(target.where(~F.coalesce(scope, F.lit(False))), staging)


def append(target: DataFrame, staging: DataFrame) -> DataFrame:
    return insert_all(target, staging)


def merge_sources(target: DataFrame, staged: dict[str, DataFrame], keys: Sequence[str], alias_column: str) -> DataFrame:
    """Several sources feed one target. Each row names its source, and the name is part of the key.

    One upsert serves all: the keys of different sources never meet.
    """
    labelled = [df.withColumn(alias_column, F.lit(alias)).select(*target.columns) for alias, df in staged.items()]
    together = labelled[0]
    for df in labelled[1:]:
        together = together.unionAll(df)
    return upsert(target, together, [alias_column, *keys])


def orphan_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys in the target that the source no longer has: deletes that incremental runs do not see.

    Both sides are made distinct before they meet, on the partitioning that the join needs anyway.
    """
    held = target.select(*keys).distinct()
    return held.join(staged_keys(source, keys), list(keys), "left_anti")


def load_counts(target: DataFrame, staging: DataFrame, keys: Sequence[str], salt: int = 1) -> DataFrame:
    """Rows that an upsert deletes and inserts, as one row."""
    deleted = matching(target, staged_keys(staging, keys), keys, salt).agg(F.count(F.lit(1)).alias("rows_deleted"))
    inserted = staging.agg(F.count(F.lit(1)).alias("rows_inserted"))
    return deleted.select("rows_deleted", inserted.scalar().alias("rows_inserted"))


def row_hash(columns: Sequence[str], lane: int = 0) -> Column:
    """A hash of a row's values in which a NULL counts by its place."""
    values = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(lane), *values)


def net_changes(old: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """What became of a table without a key: for each value of ``by`` the rows deleted, inserted and unchanged.

    Equal rows are told apart by their number alone: three of them that become five are two inserted. Each row counts with its
    side's sign under 128 bits of hash; counts are combined before the one shuffle, so rows themselves are not moved.
    """
    kept = [F.col(f"`{c}`") for c in by]
    hashes = [row_hash(old.columns, lane).alias(f"_row{lane}") for lane in (0, 1)]
    was, now = (F.lit(1).cast("long"), F.lit(0).cast("long")), (F.lit(0).cast("long"), F.lit(1).cast("long"))
    sides = [
        side.select(*kept, *hashes, signs[0].alias("was"), signs[1].alias("now"))
        for side, signs in ((old, was), (new.select(*old.columns), now))
    ]
    net = sides[0].unionAll(sides[1]).groupBy(*kept, "_row0", "_row1").agg(F.sum("was").alias("was"), F.sum("now").alias("now"))
    return net.groupBy(*kept).agg(
        F.sum(F.greatest(F.col("was") - F.col("now"), F.lit(0))).alias("deleted"),
        F.sum(F.greatest(F.col("now") - F.col("was"), F.lit(0))).alias("inserted"),
        F.sum(F.least("was", "now")).alias("unchanged"),
    )
