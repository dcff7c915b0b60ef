"""Target tables in Spark's catalogue.

A target is a Parquet table that Spark writes, reads and prunes by itself. Keyed targets are partitioned by a hash bucket of
the key; a load finds the buckets that hold a row to delete, from the key columns alone, and overwrites just these partitions
(dynamic partition overwrite); rows of other buckets are inserted. Targets without a key are partitioned by the window that a
run has loaded, named by its lower bound, so that a run that is repeated after a crash overwrites what it has written before.
A refresh or rebuild fills a table of its own, which then takes the name of the old one.

Every load can be repeated: the index value is logged last, the next run starts from the same window, and an upsert, a window
or a refresh that is loaded again leaves the same rows. There is no other record of what is current than the catalogue. A
target has one writer at a time; while a load is committed, readers may see some of its partitions before others.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import math
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import load
from tidemark.operators.layout import bucket_of, clustered
from tidemark.sources import files

BUCKET, WINDOW = "_bucket", "_window"
#: Bytes of a bucket when the number of buckets is chosen.
BUCKET_BYTES = 1 << 30
#: Staged keys that take so many bytes in memory are sent to every executor; more of them are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
#: The window of a run without a lower bound.
FIRST = "first"
_STAMP = "%Y%m%dT%H%M%S%f"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class Target:
    """What the catalogue says of a target. NOT NULL columns and the key are properties, since Parquet tables have neither."""

    struct: T.StructType
    keys: tuple[str, ...] = ()
    buckets: int | None = None
    run_id: str | None = None
    comment: str | None = None


@dataclass(frozen=True)
class Written:
    """Distinct keys that were written and read back, so that their number, bounds and bytes in memory are known."""

    rows: DataFrame
    bounds: Row

    @property
    def small(self) -> bool:
        return self.bounds["bytes"] <= BROADCAST_BYTES


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class TargetStore:
    """The target tables of one database, with their state log and monitor tables.

    ``root`` is the database's folder. Without a name the database is named after it. The tables live as long as the session's
    catalogue: with a metastore, for good.
    """

    def __init__(self, spark: SparkSession, root: str, database: str | None = None, bucket_bytes: int = BUCKET_BYTES):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database or f"tidemark_{hashlib.md5(self.root.encode()).hexdigest()[:12]}"
        self.bucket_bytes = bucket_bytes
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(self.database)} LOCATION {_text(self.root)}")

    # Names and descriptions

    def name(self, table: str) -> str:
        """A target's name in SQL; a schema becomes part of the name."""
        return f"{_quoted(self.database)}.{_quoted(table.replace('.', '__').lower())}"

    def stage_folder(self, table: str, run_id: str) -> str:
        return f"{self.root}/_stage/{table}/{run_id}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def properties(self, table: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return {r["key"].removeprefix("tidemark."): r["value"] for r in rows if r["key"].startswith("tidemark.")}

    def latest(self, table: str) -> Target | None:
        """Nothing is read but the catalogue."""
        if not self.exists(table):
            return None
        known = self.properties(table)
        strict = set(known["not_null"].split("\n"))
        more = {k.removeprefix("column."): json.loads(v) for k, v in known.items() if k.startswith("column.")}
        fields = [
            T.StructField(f.name, f.dataType, f.name not in strict, {**(f.metadata or {}), **more.get(f.name, {})})
            for f in self.spark.table(self.name(table)).schema
            if f.name not in (BUCKET, WINDOW)
        ]
        described = self.spark.catalog.getTable(self.name(table)).description
        keys = tuple(k for k in known["keys"].split("\n") if k)
        buckets = int(known["buckets"]) if known["buckets"] else None
        return Target(T.StructType(fields), keys, buckets, known.get("run"), described or None)

    def new_run_id(self, table: str, now: datetime | None = None) -> str:
        """Greater than the id of the table's last run, also when a clock went back."""
        now = now or datetime.now(timezone.utc).replace(tzinfo=None)
        last = self.properties(table).get("run") if self.exists(table) else None
        if last:
            now = max(now, datetime.strptime(last.split("-")[0], _STAMP) + timedelta(microseconds=1))
        return f"{now.strftime(_STAMP)}-{uuid.uuid4().hex[:8]}"

    def bucket_count(self, size: int) -> int:
        return max(1, math.ceil(size / self.bucket_bytes))

    # Reading

    def _whole(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def read(self, table: str) -> DataFrame:
        """The rows; a filter on the key's bucket, see :meth:`of_keys`, prunes partitions."""
        if not self.exists(table):
            raise LookupError(f"{table} does not exist")
        return self._whole(table).drop(BUCKET, WINDOW)

    def of_keys(self, table: str, keys: DataFrame) -> DataFrame:
        """The rows with the given keys, from the partitions that can hold them. ``keys`` has the table's key columns."""
        base = self.latest(table)
        reached = self._reached(keys, base)
        rows = self._whole(table).where(F.col(BUCKET).isin(reached))
        return load.matching(rows, load.staged_keys(keys, base.keys), base.keys).drop(BUCKET)

    def manifest(self, table: str) -> DataFrame:
        """The files of a target with their row counts, as its scan reports them."""
        files_of = self._whole(table).groupBy(F.col("_metadata.file_path").alias("url"))
        return files_of.agg(F.count(F.lit(1)).alias("row_count")).withColumn("mandatory", F.lit(True))

    def create_view(self, table: str, name: str) -> None:
        """The rows under a name that SQL of this session can use."""
        self.read(table).createOrReplaceTempView(name)

    def sizes(self, rows: DataFrame) -> tuple[int, int]:
        """Rows of a frame over files, and the bytes of these files, in one job that reads no column."""
        by_file = rows.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
        found = by_file.agg(F.sum("n").alias("n"), F.sum("file_size").alias("size")).first()
        return found["n"] or 0, found["size"] or 0

    # Writing

    @contextlib.contextmanager
    def _overwriting(self) -> Iterator[None]:
        """Inserts that overwrite replace only the partitions that they have rows for."""
        before = self.spark.conf.get(_OVERWRITE)
        self.spark.conf.set(_OVERWRITE, "dynamic")
        try:
            yield
        finally:
            self.spark.conf.set(_OVERWRITE, before)

    def _create(self, name: str, target: Target) -> None:
        columns = [
            f"{_quoted(f.name)} {f.dataType.simpleString()}"
            + (f" COMMENT {_text(f.metadata['comment'])}" if f.metadata.get("comment") else "")
            for f in target.struct
        ]
        part = f"{BUCKET} INT" if target.buckets else f"{WINDOW} STRING"
        known = {
            "keys": "\n".join(target.keys),
            "buckets": str(target.buckets or ""),
            "not_null": "\n".join(f.name for f in target.struct if not f.nullable),
        }
        for f in target.struct:
            if more := {k: v for k, v in f.metadata.items() if k != "comment"}:
                known[f"column.{f.name}"] = json.dumps(more)
        self.spark.sql(
            f"CREATE TABLE {name} ({', '.join([*columns, part])}) USING parquet PARTITIONED BY ({part.split()[0]})"
            + (f" COMMENT {_text(target.comment)}" if target.comment else "")
            + f" TBLPROPERTIES ({self._settings(known)})"
        )

    def _settings(self, known: Mapping[str, str]) -> str:
        return ", ".join(f"{_text('tidemark.' + k)} = {_text(v)}" for k, v in known.items())

    def _note_run(self, name: str, run_id: str) -> None:
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({self._settings({'run': run_id})})")

    def create(self, table: str, schema: T.StructType, keys: Sequence[str] = (), buckets: int | None = None,
               comment: str | None = None) -> None:
        """An empty table."""
        self._create(self.name(table), Target(schema, tuple(keys), (buckets or 1) if keys else None, None, comment))

    def _insert(self, name: str, rows: DataFrame, overwrite: bool = False) -> None:
        """``rows`` have the table's columns and its partition, in any order."""
        placed = rows.select(*[F.col(_quoted(c)) for c in self.spark.table(name).columns])
        if overwrite:
            with self._overwriting():
                placed.write.insertInto(name, overwrite=True)
        else:
            placed.write.insertInto(name)

    def _placed(self, rows: DataFrame, target: Target, sort_keys: Sequence[str]) -> DataFrame:
        """Rows with their bucket, brought together by it and sorted by the key unless the table has sort keys.

        AQE splits a bucket that is too large for one task, and merges small ones.
        """
        labelled = rows.withColumn(BUCKET, bucket_of(target.keys, target.buckets))
        return clustered(labelled, [BUCKET], [BUCKET, *(sort_keys or target.keys)], target.buckets)

    def fill(
        self, table: str, rows: DataFrame, target: Target, window: str = FIRST, distribution_key: str | None = None,
        sort_keys: Sequence[str] = (),
    ) -> str:
        """Write rows to a new table beside the target; returns its name. :meth:`swap` makes it the target."""
        pending = self.name(f"{table}__new")
        self.spark.sql(f"DROP TABLE IF EXISTS {pending}")
        self._create(pending, target)
        if target.buckets:
            self._insert(pending, self._placed(rows, target, sort_keys))
        else:
            placed = clustered(rows, [distribution_key] if distribution_key else [], sort_keys)
            self._insert(pending, placed.withColumn(WINDOW, F.lit(window)))
        return pending

    def swap(self, table: str, run_id: str) -> None:
        """The table that :meth:`fill` has written takes the target's name."""
        pending, name = self.name(f"{table}__new"), self.name(table)
        self._note_run(pending, run_id)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(f"ALTER TABLE {pending} RENAME TO {name}")
        self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")

    def discard(self, table: str) -> None:
        name = self.name(f"{table}__new")
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def append(
        self, table: str, run_id: str, rows: DataFrame, window: str, distribution_key: str | None = None,
        sort_keys: Sequence[str] = (),
    ) -> None:
        """Write a window's rows. A window that was written before, by a run that died, is overwritten.

        A table with buckets gets the rows inserted into them instead.
        """
        name, base = self.name(table), self.latest(table)
        if base.buckets:
            self._insert(name, self._placed(rows, base, sort_keys))
        else:
            placed = clustered(rows, [distribution_key] if distribution_key else [], sort_keys)
            self._insert(name, placed.withColumn(WINDOW, F.lit(window)), overwrite=True)
        self._note_run(name, run_id)

    def of_window(self, table: str, window: str) -> DataFrame:
        return self._whole(table).where(F.col(WINDOW) == window)

    def drop_window(self, table: str, window: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({WINDOW} = {_text(window)})")

    def _reached(self, keyed: DataFrame, base: Target) -> list[int]:
        """The buckets that a frame's keys fall into: at most the number of buckets."""
        return sorted(r[0] for r in keyed.select(bucket_of(base.keys, base.buckets)).distinct().collect())

    def upsert(
        self, table: str, run_id: str, staged: DataFrame, matches: Written, keys: Sequence[str], size: int = 0,
        buckets: int | None = None, sort_keys: Sequence[str] = (),
    ) -> int:
        """Delete by key and insert the staged rows; returns the number of rows deleted.

        Only partitions that lose a row are written again; they keep one at least, as each deleted key is staged. A table that
        is not partitioned by these keys is written anew.
        """
        base, name = self.latest(table), self.name(table)
        found = F.broadcast(matches.rows) if matches.small else matches.rows
        if not base.buckets or base.keys != tuple(keys):
            live = self.read(table)
            deleted = load.matching(live, found, keys).count()
            count = buckets or self.bucket_count(size + self.sizes(self._whole(table))[1])
            self.fill(table, load.upsert(live, staged, keys, matches=found), Target(base.struct, tuple(keys), count, None, base.comment),
                      sort_keys=sort_keys)
            self.swap(table, run_id)
            return deleted
        near = self._whole(table).where(F.col(BUCKET).isin(self._reached(matches.rows, base)))
        doomed = load.matching(load.within(near.select(*keys, BUCKET), matches.bounds, keys), found, keys)
        lost = {r[BUCKET]: r["n"] for r in doomed.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}
        hit = F.col(BUCKET).isin(list(lost))
        placed = self._placed(staged, base, sort_keys)
        if lost:
            left = load.delete_matching(self._whole(table).where(hit), found, keys, distinct=False)
            together = load.insert_all(left, placed.where(hit))
            self._insert(name, clustered(together, [BUCKET], [BUCKET, *(sort_keys or keys)], base.buckets), overwrite=True)
        self._insert(name, placed.where(~hit) if lost else placed)
        self._note_run(name, run_id)
        return sum(lost.values())

    def replace_where(
        self, table: str, run_id: str, staged: DataFrame, scope: Column, window: str = FIRST, sort_keys: Sequence[str] = ()
    ) -> int:
        """Put the staged rows in place of those where ``scope`` is true; returns the number of rows deleted.

        Partitions without such a row are left as they are, and those that keep none are dropped.
        """
        base, name = self.latest(table), self.name(table)
        part = BUCKET if base.buckets else WINDOW
        gone = F.coalesce(scope, F.lit(False))
        counts = self._whole(table).groupBy(part).agg(F.sum(gone.cast("long")).alias("gone"), F.count(F.lit(1)).alias("n"))
        # At most one row per partition of the target.
        lost = {r[part]: r for r in counts.where("gone > 0").collect()}
        placed = self._placed(staged, base, sort_keys) if base.buckets else staged.withColumn(WINDOW, F.lit(window))
        if lost:
            hit = F.col(part).isin(list(lost))
            left = self._whole(table).where(hit & ~gone)
            staying = {r[0] for r in placed.where(hit).select(part).distinct().collect()}
            together = load.insert_all(left, placed.where(hit))
            for value in [v for v, r in lost.items() if r["gone"] == r["n"] and v not in staying]:
                literal = str(value) if base.buckets else _text(value)
                self.spark.sql(f"ALTER TABLE {name} DROP PARTITION ({part} = {literal})")
                together = together.where(F.col(part) != value)
            self._insert(name, clustered(together, [part], [part, *sort_keys], base.buckets), overwrite=True)
            placed = placed.where(~hit)
        self._insert(name, placed)
        self._note_run(name, run_id)
        return sum(r["gone"] for r in lost.values())

    def compact(self, table: str, sort_keys: Sequence[str] = ()) -> None:
        """Write each bucket's rows into as few files as they need."""
        base, name = self.latest(table), self.name(table)
        by = [BUCKET] if base.buckets else [WINDOW]
        order = [*by, *(sort_keys or base.keys)]
        self._insert(name, clustered(self._whole(table), by, order, base.buckets), overwrite=True)

    def clean_up(self, table: str) -> list[str]:
        """Delete what runs that died have left: the new table beside the target, and staged extracts."""
        self.discard(table)
        folder = f"{self.root}/_stage/{table}"
        left = files.names(self.spark, folder)
        files.delete_folder(self.spark, folder)
        return left
