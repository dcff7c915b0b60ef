"""The state log and the monitor tables of a store: tables of its database, only added to, created when first written."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.bounds import STATE_KEY
from tidemark.operators.metrics import EXTRACT_MONITOR, LOAD_MONITOR
from tidemark.plans.tables import TargetStore

# The columns of the state log; the last two tell which run a row belongs to.
STATE = (
    "datastore_name STRING NOT NULL, database_name STRING NOT NULL, table_name STRING NOT NULL, "
    "index_value STRING NOT NULL, created_ts TIMESTAMP_NTZ, run_id STRING, target STRING"
)


def state_rows(df: DataFrame, alias: str, database: str, created_ts: datetime) -> DataFrame:
    """New log rows from (table_name, index_value); tables without a new value get none."""
    return df.where(F.col("index_value").isNotNull()).select(
        F.lit(alias).alias("datastore_name"),
        F.lit(database).alias("database_name"),
        "table_name",
        "index_value",
        F.lit(created_ts.isoformat(" ")).cast("timestamp_ntz").alias("created_ts"),
    )


def append_state(log: DataFrame, rows: DataFrame) -> DataFrame:
    return log.unionByName(rows.select(*log.columns))


def _added(store: TargetStore, table: str, columns: str, row: dict[str, Any], parts: Sequence[str] = ()) -> None:
    """Insert one row into a table of the store, which is created if it is not there. ``parts`` are the columns it is
    partitioned by."""
    name = store.name(table)
    schema = T.StructType.fromDDL(columns)
    by = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
    store.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by}")

    def value(field: T.StructField) -> Column:
        given = row.get(field.name)
        return F.lit(given.isoformat(" ") if isinstance(given, datetime) else given).cast(field.dataType).alias(field.name)

    values = store.spark.range(1, numPartitions=1).select(*[value(f) for f in schema])
    values.select(*store.spark.table(name).columns).write.insertInto(name)


def _found(store: TargetStore, table: str, columns: str) -> DataFrame:
    schema = T.StructType.fromDDL(columns)
    if not store.exists(table):
        return store.spark.createDataFrame([], schema)
    return store.spark.table(store.name(table)).select(*schema.names)


class StateLog:
    """Index values of all runs: one row per run, in a table that is partitioned by the state key.

    A row is added once the run's rows are in the target.
    """

    def __init__(self, store: TargetStore):
        self.store = store

    def rows(self) -> DataFrame:
        """All rows; a filter on the key columns prunes partitions."""
        return _found(self.store, "tidemark_state", STATE)

    def of(self, key: tuple[str, str, str], target: str) -> DataFrame:
        """One table's rows, from its partition alone."""
        rows = self.rows()
        for column, value in zip(STATE_KEY, key):
            rows = rows.where(F.col(column) == F.lit(value))
        return rows.where(F.col("target") == target)

    def bounds(self, key: tuple[str, str, str], target: str, runs_back: int) -> tuple[str | None, str | None]:
        """The newest value and the one ``runs_back`` runs before it. Runs' ids are in the order of time."""
        newest = self.of(key, target).orderBy(F.desc("run_id")).limit(runs_back + 1).collect()

        def value(back: int) -> str | None:
            return newest[back]["index_value"] if back < len(newest) else None

        return value(0), value(runs_back) if runs_back else None

    def add(self, key: tuple[str, str, str], target: str, run_id: str, index_value: str, created_ts: datetime) -> None:
        row = {"index_value": index_value, "created_ts": created_ts, "run_id": run_id, "target": target}
        _added(self.store, "tidemark_state", STATE, row | dict(zip(STATE_KEY, key)), STATE_KEY)


_MONITORS = {"extract": EXTRACT_MONITOR, "load": LOAD_MONITOR}


def append_monitor(store: TargetStore, name: str, run_id: str, row: dict[str, Any]) -> None:
    _added(store, f"tidemark_{name}_monitor", _MONITORS[name], row)


def read_monitor(store: TargetStore, name: str) -> DataFrame:
    """The ``extract`` or ``load`` monitor table."""
    return _found(store, f"tidemark_{name}_monitor", _MONITORS[name])
