"""Scheduled incremental runs as a stream: each run loads the files that are new, then stops.

The checkpoint plays the part of the state log. A batch that is repeated after a crash leaves the same rows: an upsert by its
keys, a refresh by its nature, and an append since the stream and the batch's number name its window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators import reconcile
from tidemark.operators.bounds import high_water_mark
from tidemark.operators.extract import project
from tidemark.plans.tables import TargetStore
from tidemark.plans.state import StateLog
from tidemark.plans.sync import (
    keyed_by_source,
    land,
    leave,
    load_staged,
    log_extract,
    log_load,
    mode_for,
    normal_rows,
    stamp_of,
    utc_now,
)
from tidemark.sources import files
from tidemark.spec import SchemaMismatch, SyncSpec


@dataclass(frozen=True)
class StreamSource:
    """A Parquet file, or a folder of them, or those of its files that match a pattern."""

    path: str
    schema: T.StructType
    pattern: str | None = None
    max_files: int | None = None

    def frame(self, spark: SparkSession) -> DataFrame:
        """The stream. A path that holds no file is an error: such a stream would load nothing for ever."""
        if not files.holds(spark, self.path, self.pattern):
            raise FileNotFoundError(f"{self.path}: no file" + (f" is named like {self.pattern}" if self.pattern else ""))
        reader = spark.readStream.schema(self.schema)
        if self.pattern:
            reader = reader.option("pathGlobFilter", self.pattern)
        if self.max_files:
            reader = reader.option("maxFilesPerTrigger", self.max_files)
        if not files.is_file(spark, self.path):
            return reader.parquet(self.path)
        # Streams read folders: one file is the folder it lies in, and its name as the pattern.
        folder, _, name = self.path.rstrip("/").rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)


def load_batch(
    spark: SparkSession, spec: SyncSpec, store: TargetStore, rows: DataFrame, stream: str, batch: int, monitor: bool = True
) -> None:
    """Load one batch as one run.

    As in a run without a stream, columns are checked against the target's, the newest index value is logged, and the
    monitor tables get a row each.
    """
    started = utc_now()
    base = store.latest(spec.target)
    if spec.mode == "upsert" and not spec.primary_key:
        raise SchemaMismatch(f"{spec.target}: an upsert needs a primary key")
    keys = () if spec.mode == "append" else keyed_by_source(spec, spec.primary_key)
    normal = normal_rows(spec, rows)
    target_columns = base.struct.fieldNames() if base else ()
    if reconcile.target_status(normal.columns, target_columns, (), False) == reconcile.INCORRECT:
        extra = sorted(set(target_columns) - set(normal.columns))
        raise SchemaMismatch(f"{spec.target} has columns that the stream lacks: {', '.join(extra)}")
    schema, mode = base.struct if base else normal.schema, mode_for(spec, base)
    staged = land(spark, store, spec, normal, schema, mode, base, keys, f"{stream}#{batch}")
    if monitor:
        log_extract(store, spec, staged, started, utc_now())
    if staged.count:
        loading, newest = utc_now(), None
        if spec.index_column and spec.index_column in staged.rows.columns:
            newest = high_water_mark(staged.rows, spec.index_column).first()["index_value"]
        deleted = load_staged(spark, spec, store, mode, base, staged, keys)
        if newest is not None:
            StateLog(store).add(spec.state_key, spec.target, staged.run_id, newest, stamp_of(staged.run_id))
        if monitor:
            log_load(store, spec, staged, deleted, loading, utc_now())
    leave(store, spec, staged)


def stream_sync(
    spark: SparkSession, source: StreamSource, spec: SyncSpec, store: TargetStore, checkpoint: str, transform=None
) -> None:
    """Load everything that has arrived since the last call, then return.

    ``transform`` is applied to the stream before it is loaded, such as a filter or added columns.
    """
    rows = project(source.frame(spark), spec.columns_to_drop)
    if transform is not None:
        rows = transform(rows)
    query = (
        rows.writeStream.foreachBatch(lambda df, batch: load_batch(df.sparkSession, spec, store, df, checkpoint, batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
