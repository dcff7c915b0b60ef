"""What a run did, as rows of the extract and load monitor tables."""

from __future__ import annotations

import json
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns of the monitor tables.
EXTRACT_MONITOR = (
    "task_id STRING NOT NULL, class_name STRING NOT NULL, task_date_params STRING, task_other_params STRING, "
    "start_dt TIMESTAMP_NTZ NOT NULL, end_dt TIMESTAMP_NTZ, run_time_sec INT, manifest_path STRING, "
    "data_path STRING, output_exists BOOLEAN, row_count BIGINT, upload_size BIGINT, exception STRING, "
    "created_at TIMESTAMP_NTZ NOT NULL"
)
LOAD_MONITOR = (
    "task_id STRING NOT NULL, class_name STRING NOT NULL, task_date_params STRING, task_other_params STRING, "
    "target_table STRING NOT NULL, start_dt TIMESTAMP_NTZ NOT NULL, end_dt TIMESTAMP_NTZ, run_time_sec INT, "
    "extract_task_update_id STRING, s3_load_path STRING, manifest_cleaned BOOLEAN, rows_inserted BIGINT, "
    "rows_deleted BIGINT, load_size BIGINT, exception STRING, created_at TIMESTAMP_NTZ NOT NULL"
)


def row_bytes(df: DataFrame) -> Column:
    """The bytes of a row's values as text, NULL counting nothing."""
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    return sum(sizes[1:], sizes[0])


def extract_metrics(df: DataFrame, *group: str) -> DataFrame:
    """Rows and bytes of an extract, in total or per group; partial sums are made before the shuffle."""
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(row_bytes(df)), F.lit(0)).cast("long").alias("upload_size"),
    )


def task_id(task: str, alias: str, database: str, table: str) -> str:
    return f"{task}(alias={alias}, database={database}, table={table})"


def extract_monitor_columns(
    task: str, alias: str, database: str, table: Column, row_count: Column, upload_size: Column
) -> list[Column]:
    """The extract monitor's columns that follow from the data, without clock and paths."""
    return [
        _task_id_column(task, alias, database, table),
        F.lit(task).alias("class_name"),
        (row_count > 0).alias("output_exists"),
        row_count.alias("row_count"),
        upload_size.alias("upload_size"),
    ]


def load_monitor_columns(
    task: str, alias: str, database: str, table: Column, schema: str, inserted: Column, deleted: Column, size: Column
) -> list[Column]:
    """The load monitor's columns that follow from the data, without clock and paths."""
    return [
        _task_id_column(task, alias, database, table),
        F.lit(task).alias("class_name"),
        F.concat(F.lit(f"{schema}."), table).alias("target_table"),
        F.lit(False).alias("manifest_cleaned"),
        inserted.alias("rows_inserted"),
        deleted.alias("rows_deleted"),
        size.alias("load_size"),
    ]


def _task_id_column(task: str, alias: str, database: str, table: Column) -> Column:
    head = F.lit(f"{task}(alias={alias}, database={database}, table=")
    return F.concat(head, table, F.lit(")")).alias("task_id")


def extract_monitor_row(
    task: str, key: tuple[str, str, str], started: datetime, ended: datetime, data_path: str, row_count: int,
    upload_size: int, cut_values: int = 0,
) -> dict[str, Any]:
    return {
        **_task(task, key, started, ended),
        "manifest_path": f"{data_path}/_SUCCESS",
        "data_path": data_path,
        "output_exists": row_count > 0,
        "row_count": row_count,
        "upload_size": upload_size,
        "task_other_params": json.dumps({"cut_values": cut_values}),
    }


def load_monitor_row(
    task: str, key: tuple[str, str, str], target: str, started: datetime, ended: datetime, data_path: str,
    inserted: int, deleted: int, load_size: int,
) -> dict[str, Any]:
    return {
        **_task(task, key, started, ended),
        "target_table": target,
        "extract_task_update_id": task_id(task, *key),
        "s3_load_path": data_path,
        "manifest_cleaned": False,
        "rows_inserted": inserted,
        "rows_deleted": deleted,
        "load_size": load_size,
    }


def _task(task: str, key: tuple[str, str, str], started: datetime, ended: datetime) -> dict[str, Any]:
    return {
        "task_id": task_id(task, *key),
        "class_name": task,
        "start_dt": started.replace(microsecond=0),
        "end_dt": ended.replace(microsecond=0),
        "run_time_sec": int((ended - started).total_seconds()),
        "created_at": ended,
    }
