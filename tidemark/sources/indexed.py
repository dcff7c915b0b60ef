"""A stream of a database table, whose offsets are values of its index column.

A trigger asks the database for the newest index value and reads what lies above the last trigger's, in ranges of the index. So a
table that only grows by its index is followed without files, and the checkpoint has what the state log has in other runs. The
database is reached by any module of Python's DB-API.
"""

from __future__ import annotations

import importlib
import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "tidemark_indexed"
#: Rows of a batch.
BATCH = 10_000


@dataclass
class Range(InputPartition):
    """Index values above ``lower``, all if it is None, up to ``upper``, as texts."""

    lower: str | None
    upper: str


class IndexedReader(DataSourceStreamReader):
    """Options: ``module`` and ``connect`` (JSON of its arguments), ``table`` (what stands after FROM), ``index``, ``partitions``."""

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.options = schema, dict(options)
        kind = schema[options["index"]].dataType
        if not isinstance(kind, (T.IntegralType, T.TimestampNTZType)):
            raise TypeError("an index is a whole number or a timestamp without a zone")
        self.whole = isinstance(kind, T.IntegralType)

    def _rows(self, sql: str, values: tuple = ()) -> Iterator[list[tuple]]:
        module = importlib.import_module(self.options["module"])
        mark = "?" if module.paramstyle == "qmark" else "%s"
        connection = module.connect(**json.loads(self.options.get("connect", "{}")))
        try:
            cursor = connection.cursor()
            cursor.execute(sql.replace("{}", mark), values)
            while rows := cursor.fetchmany(BATCH):
                yield rows
        finally:
            connection.close()

    def _value(self, text: str) -> Any:
        return int(text) if self.whole else datetime.fromisoformat(text)

    def _one(self, sql: str) -> str | None:
        value = next(self._rows(sql), [(None,)])[0][0]
        return None if value is None else str(value)

    def initialOffset(self) -> dict:
        return {"index": None}

    def latestOffset(self) -> dict:
        return {"index": self._one(f"SELECT max({self.options['index']}) FROM {self.options['table']}")}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        """The window above ``start`` up to ``end``, cut into ranges of equal width."""
        if end["index"] is None or start == end:
            return []
        parts, upper = int(self.options.get("partitions", 1)), self._value(end["index"])
        least = start["index"] or self._one(f"SELECT min({self.options['index']}) FROM {self.options['table']}")
        low = self._value(least)
        if parts < 2 or not low < upper:
            return [Range(start["index"], end["index"])]
        cuts = sorted({low + (upper - low) * i // parts if self.whole else low + (upper - low) * (i / parts) for i in range(1, parts)} - {low, upper})
        ends = [*map(str, cuts), end["index"]]
        return [Range(a, b) for a, b in zip([start["index"], *ends], ends)]

    def read(self, partition: Range) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, index = to_arrow_schema(self.schema), self.options["index"]
        conditions, values = [f"{index} <= {{}}"], [self._value(partition.upper)]
        if partition.lower is not None:
            conditions.insert(0, f"{index} > {{}}")
            values.insert(0, self._value(partition.lower))
        sql = f"SELECT {', '.join(self.schema.names)} FROM {self.options['table']} WHERE {' AND '.join(conditions)}"
        for rows in self._rows(sql, tuple(values)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


class IndexedTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: T.StructType) -> IndexedReader:
        return IndexedReader(schema, self.options)


def indexed_stream(
    spark: SparkSession, schema: T.StructType, table: str, index: str, module: str, partitions: int = 1, **connect: Any
) -> DataFrame:
    """The table as a stream of all rows that have an index value, which must not be lower than what was read before.

    ``table`` and ``index`` are SQL of the database; ``connect`` are the arguments of the module's ``connect``, which every
    executor can use.
    """
    # The reader travels to Python workers by value.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(IndexedTable)
    options = {"module": module, "connect": json.dumps(connect), "table": table, "index": index, "partitions": str(partitions)}
    return spark.readStream.format(NAME).schema(schema).options(**options).load()
