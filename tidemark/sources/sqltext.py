"""SQL text with named parameters.

Parameters are ``:name`` markers, named after their namespace: ``run_*`` for the run, ``db_*`` for the source's data,
``table_*`` for the table's, ``index_old_index_value`` in index SQL. A marker without a value is an error.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.spec import SyncSpec

# Quoted text, comments and casts are skipped, so that a colon in them is no marker.
_MARKER = re.compile(r"'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/|::|:([A-Za-z_]\w*)", re.DOTALL)


def read_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read().rstrip("; \n\t")


def template_values(spec: SyncSpec, old: Any = None, new: Any = None) -> dict[str, Any]:
    """All parameters that a spec's SQL may name."""
    run = {
        "destination_schema_name": spec.target_schema,
        "destination_table_name": spec.target_table,
        "db_name": spec.source.database,
        "source_table_name": spec.source_table,
        "index_column": spec.index_column,
        "old_index_value": old,
        "new_index_value": new,
    }
    spaces = {"run": run, "db": spec.source.data, "table": spec.data, "index": {"old_index_value": old}}
    return {f"{space}_{name}": value for space, values in spaces.items() for name, value in values.items()}


def used_values(text: str, values: Mapping[str, Any]) -> dict[str, Any]:
    """The values that the text names; a name without a value is an error, as it is for ``spark.sql``."""
    names = {m[1] for m in _MARKER.finditer(text) if m[1]}
    if missing := sorted(names - set(values)):
        raise ValueError(f"SQL text names values that are not given: {', '.join(missing)}")
    return {name: values[name] for name in names}


def run_sql(spark: SparkSession, text: str, values: Mapping[str, Any]) -> DataFrame:
    return spark.sql(text, args=used_values(text, values))


def _literal(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def with_literals(text: str, values: Mapping[str, Any]) -> str:
    """The text with literals in place of its markers, for SQL that another database runs."""
    used = used_values(text, values)
    return _MARKER.sub(lambda m: _literal(used[m[1]]) if m[1] else m[0], text)


def delete_predicate(text: str) -> str:
    """The condition of a ``DELETE FROM t WHERE ...``, or the text itself if it is a condition already."""
    found = re.match(r"\s*delete\s+from\s+\S+(?:\s+where\s+(.*))?$", text.rstrip("; \n\t"), re.I | re.S)
    if not found:
        return text
    return found[1] or "true"
