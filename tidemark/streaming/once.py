"""Append-only tables whose extracts overlap: what was loaded before is not loaded again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def first_seen(rows: DataFrame, keys: Sequence[str], index_column: str, overlap: str) -> DataFrame:
    """A stream without the rows whose key it has had before, at most ``overlap`` of the index column earlier.

    Keys are state that is dropped once the stream's newest index value lies further on, so the state holds an overlap's keys,
    not the table's. Rows that come later than that are left out, so ``overlap`` has to be as long as the lookback is.
    """
    micros = T.TimestampNTZType()
    timed = rows
    if rows.schema[index_column].dataType == micros:
        # Watermarks are for instants.
        timed = rows.withColumn("_instant", rows[index_column].cast("timestamp"))
    column = "_instant" if "_instant" in timed.columns else index_column
    return timed.withWatermark(column, overlap).dropDuplicatesWithinWatermark(list(keys)).select(*rows.columns)


def append_once(
    spark: SparkSession, arrived: str, schema: T.StructType, keys: Sequence[str], index_column: str, overlap: str, loaded: str,
    checkpoint: str, max_files: int = 1000,
) -> None:
    """Append all rows of files that are new since the last call, each key once, then return.

    Keys that were seen, what was read and what was written are in the checkpoint, so a run that dies goes on where it was.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{arrived}/*")
    once = first_seen(rows, keys, index_column, overlap)
    query = (
        once.writeStream.format("parquet").option("path", loaded).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
