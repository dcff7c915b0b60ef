"""What to sync: sources, tables, and the rules on which settings go together."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

import numpy as np

from tidemark.functions.text import MAX_TEXT

DIALECTS = ("postgresql", "mysql", "mssql")


class SpecError(ValueError):
    """Settings that contradict each other."""


class SchemaMismatch(Exception):
    """The target has columns that the source lacks, or cannot be created."""


@dataclass(frozen=True)
class SourceSpec:
    """Where tables come from.

    ``kind`` is a database dialect (read over JDBC), ``parquet`` (one file or folder per table under
    ``location``), or ``table`` (tables and views of the session). ``database`` and ``alias`` are part of the key
    under which index values are kept; ``override_database`` replaces the former there.
    """

    alias: str
    database: str
    kind: str = "table"
    location: str = ""
    suffix: str = ".parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    override_database: str | None = None
    data: Mapping[str, Any] = field(default_factory=dict)
    enabled: bool = True

    def __post_init__(self) -> None:
        if self.kind not in (*DIALECTS, "parquet", "table"):
            raise SpecError(f"{self.alias}: unknown kind of source {self.kind}")


@dataclass(frozen=True)
class SyncSpec:
    """One table to keep in step with its source.

    ``query_file``, ``truncate_file`` and ``schema_file`` name files of SQL text with named parameters.
    ``index_sql`` is SQL text with a column ``index_value``. ``buckets`` is the number of hash buckets of a keyed
    target; None derives it from the size of the first load. Text is cut at ``max_text`` characters, if that is given; the
    extract monitor has the number of values that were. ``alias_column`` is a column of the target that takes the source's
    alias, so that several sources can feed one target: it is part of the key, and a refresh replaces its own source's rows.
    """

    source: SourceSpec
    source_table: str
    target_table: str
    target_schema: str = "public"
    index_column: str | None = None
    index_sql: str | None = None
    query_file: str | None = None
    truncate_file: str | None = None
    schema_file: str | None = None
    primary_key: tuple[str, ...] = ()
    columns_to_drop: tuple[str, ...] = ()
    type_map: Mapping[str, Any] = field(default_factory=dict)
    append_only: bool = False
    full_refresh: bool = False
    rebuild: bool = False
    not_null_date: Mapping[str, str] | bool = False
    lookback: int = 0
    distribution_key: str | None = None
    sort_keys: tuple[str, ...] = ()
    include_comments: bool = True
    override_database: str | None = None
    data: Mapping[str, Any] = field(default_factory=dict)
    enabled: bool = True
    allow_empty_refresh: bool = False
    buckets: int | None = None
    max_text: int | None = MAX_TEXT
    alias_column: str | None = None

    def __post_init__(self) -> None:
        key = self.primary_key
        object.__setattr__(self, "primary_key", (key,) if isinstance(key, str) else tuple(key or ()))
        object.__setattr__(self, "columns_to_drop", tuple(self.columns_to_drop or ()))
        object.__setattr__(self, "sort_keys", tuple(self.sort_keys or ()))

    @property
    def target(self) -> str:
        return f"{self.target_schema}.{self.target_table}"

    @property
    def state_database(self) -> str:
        """The database name in the state key: a table's override, then the source's, then the real one."""
        return self.override_database or self.source.override_database or self.source.database

    @property
    def state_key(self) -> tuple[str, str, str]:
        return (self.source.alias, self.state_database, self.source_table)

    @property
    def mode(self) -> str:
        if self.rebuild:
            return "rebuild"
        if self.full_refresh:
            return "scoped_refresh" if self.truncate_file else "full_refresh"
        return "append" if self.append_only else "upsert"

    def forced(self, full_refresh: bool = False, rebuild: bool = False) -> SyncSpec:
        """This spec with a refresh or rebuild asked for at run time."""
        if rebuild:
            return replace(self, rebuild=True, full_refresh=True)
        return replace(self, full_refresh=True) if full_refresh else self

    def _flags(self) -> SpecFlags:
        return SpecFlags(
            index_column=np.bool_(bool(self.index_column)),
            index_sql=np.bool_(bool(self.index_sql)),
            append_only=np.bool_(self.append_only),
            full_refresh=np.bool_(self.full_refresh),
            rebuild=np.bool_(self.rebuild),
            primary_key=np.bool_(bool(self.primary_key)),
            query_file=np.bool_(bool(self.query_file)),
            query_file_missing=np.bool_(bool(self.query_file) and not os.path.isfile(self.query_file or "")),
            schema_file=np.bool_(bool(self.schema_file)),
            schema_file_missing=np.bool_(bool(self.schema_file) and not os.path.isfile(self.schema_file or "")),
            truncate_file=np.bool_(bool(self.truncate_file)),
        )

    def conflict(self) -> str | None:
        """The first static rule that this spec breaks."""
        flags = self._flags()
        return next((name for name, broken in STATIC_RULES if broken(flags)), None)

    def runtime_conflict(self) -> str | None:
        """The first rule on forced refreshes and rebuilds that this spec breaks."""
        flags = self._flags()
        return next((name for name, broken in RUNTIME_RULES if broken(flags)), None)

    def validate(self) -> SyncSpec:
        if found := self.conflict():
            raise SpecError(f"{self.source_table}: {found}")
        return self

    def validate_runtime(self) -> SyncSpec:
        if found := self.runtime_conflict():
            raise SpecError(f"{self.source_table}: {found}")
        return self


@dataclass(frozen=True)
class SpecFlags:
    """The settings that rules look at: numpy booleans for one spec, boolean columns for a frame of specs.

    Both take ``&``, ``|`` and ``~``, so that each rule is written once.
    """

    index_column: Any
    index_sql: Any
    append_only: Any
    full_refresh: Any
    rebuild: Any
    primary_key: Any
    query_file: Any
    query_file_missing: Any
    schema_file: Any
    schema_file_missing: Any
    truncate_file: Any

    @property
    def indexed(self) -> Any:
        return self.index_column | self.index_sql


Rule = tuple[str, Callable[[SpecFlags], Any]]

# In order: the first broken rule is the one reported.
STATIC_RULES: tuple[Rule, ...] = (
    ("append_only without index", lambda s: s.append_only & ~s.indexed),
    ("append_only with full_refresh", lambda s: s.append_only & s.full_refresh),
    ("incremental without index", lambda s: ~s.indexed & ~s.full_refresh),
    ("full_refresh with index_column", lambda s: s.index_column & s.full_refresh),
    ("full_refresh with index_sql", lambda s: s.index_sql & s.full_refresh),
    ("index_sql with index_column", lambda s: s.index_sql & s.index_column),
    (
        "incremental query_file without primary_key",
        lambda s: s.query_file & ~s.primary_key & ~s.append_only & ~s.full_refresh,
    ),
    ("missing query_file", lambda s: s.query_file_missing),
    ("missing schema_file", lambda s: s.schema_file_missing),
)
RUNTIME_RULES: tuple[Rule, ...] = (
    ("rebuild with truncate_file", lambda s: s.rebuild & s.truncate_file),
    ("rebuild with schema_file", lambda s: s.rebuild & s.schema_file),
    ("rebuild without full_refresh", lambda s: s.rebuild & ~s.full_refresh),
)
