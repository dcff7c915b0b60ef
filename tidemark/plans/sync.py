"""Sync of one table or many: bounds, schema check, extract, load, publish, record."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import astuple, dataclass, fields, replace
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.normalize import cut_texts, normalize_row
from tidemark.functions.temporal import TIMESTAMP_TYPES, index_text, replace_zero_dates
from tidemark.functions.types import override_types
from tidemark.operators import load, metrics, reconcile
from tidemark.operators.bounds import extract_window, index_check, index_literal
from tidemark.operators.extract import project
from tidemark.operators.layout import layout_clause
from tidemark.plans.tables import FIRST, Target, TargetStore, Written
from tidemark.plans.state import StateLog, append_monitor
from tidemark.sources import files, jdbc, reader, sqltext
from tidemark.spec import DIALECTS, SchemaMismatch, SpecError, SyncSpec

log = logging.getLogger("tidemark")

TASK = "SyncTable"


@dataclass(frozen=True)
class Bounds:
    """Index values of a run as texts. ``follows`` is whether the new one may follow the old one."""

    old: str | None = None
    lookback: str | None = None
    new: str | None = None
    follows: bool = True


@dataclass(frozen=True)
class SyncResult:
    """What became of one table. ``status`` is loaded, empty, skipped, failed, aborted or invalid."""

    alias: str
    source_table: str
    target: str
    status: str
    mode: str
    target_status: str | None = None
    old_index_value: str | None = None
    new_index_value: str | None = None
    rows_extracted: int | None = None
    rows_inserted: int | None = None
    rows_deleted: int | None = None
    run_id: str | None = None
    error: str | None = None


RESULT_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.LongType() if f.name.startswith("rows_") else T.StringType())
        for f in fields(SyncResult)
    ]
)


class InvalidSpecs(SpecError):
    """Some specs were invalid. The others were synced; ``results`` has what became of each."""

    def __init__(self, names: Sequence[str], results: Sequence[SyncResult]):
        super().__init__(f"invalid table settings: {', '.join(names)}")
        self.results = list(results)


def _new_index(spark: SparkSession, spec: SyncSpec, old: str | None, table: DataFrame | None) -> tuple[str | None, bool]:
    """The new index value and whether it may follow the old one, both from one job."""
    source = spec.source
    if spec.index_sql:
        found = reader.read_query(spark, source, spec.index_sql, sqltext.template_values(spec, old))
        column = next(c for c in found.columns if c.lower() == "index_value")
        marks = found.select(F.col(column).alias("m"))
    elif spec.index_column and source.kind in DIALECTS:
        sql = jdbc.high_water_query(source.kind, spec.source_table, spec.index_column)
        marks = jdbc.read(spark, jdbc.query_options(source, sql)).toDF("m")
    elif spec.index_column:
        table = reader.read_table(spark, spec) if table is None else table
        if old is not None:
            # Most of the table is older than the last run: with the bound, the scan skips it.
            recent = table.where(F.col(spec.index_column) >= index_literal(old, table.schema[spec.index_column].dataType))
            found = _mark(recent.agg(F.max(spec.index_column).alias("m")), old)
            if found[0] is not None:
                return found
        marks = table.agg(F.max(spec.index_column).alias("m"))
    else:
        return None, True
    return _mark(marks, old)


def _mark(marks: DataFrame, old: str | None) -> tuple[str | None, bool]:
    """The text of the first row's ``m``, and whether it may follow the old value. One row is fetched."""
    data_type = marks.schema["m"].dataType
    kind = "timestamp" if isinstance(data_type, TIMESTAMP_TYPES) else "int"
    text = index_text(F.col("m"), data_type)
    row = marks.select(text.alias("new"), index_check(F.lit(old), text, F.lit(kind)).alias("follows")).first()
    return (row["new"], row["follows"]) if row else (None, old is None)


def resolve_bounds(spark: SparkSession, spec: SyncSpec, state: StateLog, table: DataFrame | None) -> Bounds:
    """The window of the next run. A refresh forgets the old value but still finds the new one."""
    old, lookback = (None, None) if spec.full_refresh else state.bounds(spec.state_key, spec.target, spec.lookback)
    new, follows = _new_index(spark, spec, old, table)
    if new is None and spec.query_file and spec.index_sql:
        new = "0"
    follows = follows or spec.full_refresh or spec.append_only
    if not follows:
        log.warning("%s: new index value %s does not follow %s", spec.source_table, new, old)
    return Bounds(old, lookback, new, follows)


def extract(
    spark: SparkSession, spec: SyncSpec, bounds: Bounds, table: DataFrame | None,
    columns: Sequence[Mapping[str, Any]] | None = None,
) -> DataFrame:
    """The rows of a run, normalised. Nothing is read yet but, for a database's first load, the bounds of its ranges."""
    if spec.query_file:
        text = sqltext.read_text(spec.query_file)
        values = sqltext.template_values(spec, bounds.old, bounds.new)
        rows = reader.read_query(spark, spec.source, text, values, spec.index_column)
    else:
        rows = table
        if spec.source.kind in DIALECTS and spec.index_column:
            rows = reader.read_table(spark, spec, bounds.lookback or bounds.old, bounds.new, True, columns)
        if spec.index_column:
            data_type = rows.schema[spec.index_column].dataType
            literals = [index_literal(v, data_type) for v in (bounds.new, bounds.old, bounds.lookback)]
            rows = extract_window(rows, spec.index_column, *literals)
    if spec.not_null_date and not isinstance(spec.not_null_date, bool):
        rows = replace_zero_dates(rows, dict(spec.not_null_date))
    return normal_rows(spec, project(rows, spec.columns_to_drop))


def normal_rows(spec: SyncSpec, rows: DataFrame) -> DataFrame:
    """Normalised rows, with their source's alias if the target keeps it.

    Text keeps one character more than it will have, so that values that are cut can be told, and counted as they are
    written.
    """
    normal = normalize_row(rows, size=None if spec.max_text is None else spec.max_text + 1)
    return normal.withColumn(spec.alias_column, F.lit(spec.source.alias)) if spec.alias_column else normal


def new_target_schema(spec: SyncSpec, rows: DataFrame, source: T.StructType) -> T.StructType:
    """The schema a target is created with: from the schema file, else the source's with overrides.

    NULLs are allowed where the source allows them. Of a PostgreSQL query that is unknown, and all of its columns are
    taken as NOT NULL.
    """
    if spec.schema_file:
        values = sqltext.template_values(spec)
        text = sqltext.with_literals(sqltext.read_text(spec.schema_file), values)
        return T.StructType.fromDDL(_columns_of(text))
    declared = {} if spec.query_file else {f.name: f.nullable for f in source.fields}
    strict = spec.query_file is not None and spec.source.kind == "postgresql"
    known = [
        T.StructField(
            f.name, f.dataType, declared.get(f.name, True) and not strict and not f.metadata.get("required"),
            f.metadata if spec.include_comments else {k: v for k, v in f.metadata.items() if k != "comment"},
        )
        for f in rows.schema.fields
    ]
    return override_types(T.StructType(known), spec.type_map)


def _columns_of(text: str) -> str:
    """The column list of a ``CREATE TABLE t (...)``, or the text itself if it is a column list."""
    if not text.lstrip().lower().startswith("create"):
        return text
    return text[text.index("(") + 1 : text.rindex(")")]


def without_nulls(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows; writing them fails, before anything is committed, at a NULL in a NOT NULL column, which Parquet would take."""
    strict = {f.name: F.raise_error(F.lit(f"NULL in {f.name}")) for f in schema.fields if not f.nullable}
    return rows.withColumns({name: F.coalesce(F.col(f"`{name}`"), error) for name, error in strict.items()}) if strict else rows


def keyed_by_source(spec: SyncSpec, keys: Sequence[str]) -> tuple[str, ...]:
    """The key in the target: with an alias column, keys of different sources never meet."""
    return (spec.alias_column, *keys) if spec.alias_column and keys else tuple(keys)


def mode_for(spec: SyncSpec, base: Target | None) -> str:
    """The load mode. A refresh of one source among several replaces that source's rows."""
    merged = spec.alias_column and base is not None and spec.mode == "full_refresh"
    return "scoped_refresh" if merged else spec.mode


def sync_table(
    spark: SparkSession,
    spec: SyncSpec,
    store: TargetStore,
    full_refresh: bool = False,
    rebuild: bool = False,
    monitor: bool = True,
    now: datetime | None = None,
) -> SyncResult:
    """Bring one target up to date with its source, then log its index value.

    An extract that is used twice is written first and read back, and its true size decides how it is joined. A run that dies
    logs no index value, so the next one loads the same window again, which leaves the same rows.
    """
    spec = spec.forced(full_refresh, rebuild).validate_runtime()
    started = _clock(now)
    state = StateLog(store)
    base = store.latest(spec.target)
    mode = spec.mode

    columns = None if spec.query_file else reader.catalogue_columns(spark, spec)
    table = None if spec.query_file else reader.read_table(spark, spec, columns=columns)
    bounds = resolve_bounds(spark, spec, state, table)
    rows = extract(spark, spec, bounds, table, columns)
    source_schema = rows.schema if table is None else table.schema

    status = reconcile.target_status(
        rows.columns, base.struct.fieldNames() if base else (), (), spec.rebuild
    )
    if status == reconcile.INCORRECT:
        extra = sorted(set(base.struct.fieldNames()) - set(rows.columns))
        raise SchemaMismatch(f"{spec.target} has columns that the source lacks: {', '.join(extra)}")
    keys = () if mode == "append" else reader.primary_key(spark, spec)
    if mode == "upsert" and not keys:
        raise SchemaMismatch(f"{spec.target}: an upsert needs a primary key, or every row would be deleted")
    keys = keyed_by_source(spec, keys)
    mode = mode_for(spec, base)

    result = SyncResult(
        spec.source.alias, spec.source_table, spec.target, "empty", mode, status, bounds.old, bounds.new
    )
    if status in (reconcile.MISSING, reconcile.REBUILD):
        schema = new_target_schema(spec, rows, source_schema)
    else:
        schema = base.struct
        if ignored := [c for c in rows.columns if c not in schema.fieldNames()]:
            log.warning("%s: source columns without a target column: %s", spec.target, ", ".join(ignored))

    staged = land(spark, store, spec, rows, schema, mode, base, keys, window_of(bounds), now)
    if monitor:
        log_extract(store, spec, staged, started, _clock(now))

    if staged.count == 0 and not (spec.allow_empty_refresh and spec.full_refresh):
        if base is None:
            store.create(spec.target, schema, keys, spec.buckets)
        leave(store, spec, staged)
        return replace(result, rows_extracted=0)

    load_started = _clock(now)
    deleted = load_staged(spark, spec, store, mode, base, staged, keys, bounds)
    if bounds.new is not None:
        state.add(spec.state_key, spec.target, staged.run_id, bounds.new, stamp_of(staged.run_id))
    if monitor:
        log_load(store, spec, staged, deleted, load_started, _clock(now))
    leave(store, spec, staged)
    return replace(
        result, status="loaded", rows_extracted=staged.count, rows_inserted=staged.count, rows_deleted=deleted,
        run_id=staged.run_id,
    )


def window_of(bounds: Bounds) -> str | None:
    """The name of a run's window: its lower bound, which a run that is repeated has again. None without an index value, when
    every run stands for itself."""
    return None if bounds.new is None else bounds.old or FIRST


@dataclass(frozen=True)
class Staged:
    """An extract that was written, with its exact row count and size.

    ``place`` is ``stage`` for a staging folder, ``new`` for a table beside the target, and ``window`` for a partition of the
    target itself.
    """

    run_id: str
    place: str
    folder: str
    rows: DataFrame
    schema: T.StructType
    count: int
    size: int
    window: str = FIRST
    cut_values: int = 0


def land(
    spark: SparkSession, store: TargetStore, spec: SyncSpec, rows: DataFrame, schema: T.StructType, mode: str,
    base: Target | None, keys: Sequence[str], window: str | None = None, now: datetime | None = None,
) -> Staged:
    """Write the rows in the target's form, from one pass over the source.

    Loads that keep or drop all old rows write straight into a partition or a new table. Loads that look at the old rows, or
    need the size of the extract to choose the number of buckets, write to a staging folder first. Counts come from the written
    files, so a task that is run twice counts once.
    """
    run_id = store.new_run_id(spec.target, now)
    window = window or run_id
    seen = Observation()
    counted = rows.observe(seen, F.sum(cut_texts(rows, spec.max_text)[1]).alias("cut"))
    fitted = reconcile.conform_to_target(cut_texts(counted, spec.max_text)[0], schema)
    fitted = without_nulls(fitted, schema)
    layout = {"distribution_key": spec.distribution_key, "sort_keys": spec.sort_keys}
    folder = store.stage_folder(spec.target, run_id)
    appends = base is not None and mode == "append"
    if (base is not None and mode in ("upsert", "scoped_refresh")) or (keys and spec.buckets is None) or (appends and base.buckets):
        place = "stage"
        fitted.write.parquet(f"{folder}/rows")
        back = spark.read.schema(schema).parquet(f"{folder}/rows")
    elif appends:
        place, folder = "window", store.name(spec.target)
        store.append(spec.target, run_id, fitted, window, **layout)
        back = store.of_window(spec.target, window)
    else:
        place = "new"
        folder = store.fill(spec.target, fitted, new_target(store, spec, schema, keys, spec.buckets), window, **layout)
        back = spark.table(folder)
    count, size = store.sizes(back)
    # Nothing is observed where the plan is known to be empty.
    cut = seen.get["cut"] or 0 if count else 0
    return Staged(run_id, place, folder, back.select(*[F.col(f"`{c}`") for c in schema.names]), schema, count, size, window, cut)


def new_target(store: TargetStore, spec: SyncSpec, schema: T.StructType, keys: Sequence[str], buckets: int | None) -> Target:
    comment = reader.table_comment(store.spark, spec) if spec.include_comments else None
    return Target(schema, tuple(keys), (buckets or 1) if keys else None, None, comment)


def leave(store: TargetStore, spec: SyncSpec, staged: Staged) -> None:
    """Nothing of an extract stays beside the target, loaded or not."""
    if staged.place == "stage":
        files.delete_folder(store.spark, staged.folder)
    elif staged.place == "new":
        store.discard(spec.target)


def load_staged(
    spark: SparkSession, spec: SyncSpec, store: TargetStore, mode: str, base: Target | None, staged: Staged,
    keys: Sequence[str], bounds: Bounds = Bounds(),
) -> int:
    """Apply an extract to the target by its load mode; returns the rows that it deletes."""
    target, run_id, rows = spec.target, staged.run_id, staged.rows
    layout = {"distribution_key": spec.distribution_key, "sort_keys": spec.sort_keys}
    if base is not None and mode == "append":
        if staged.place == "stage":
            store.append(target, run_id, rows, staged.window, **layout)
        return 0
    if base is None or mode in ("rebuild", "full_refresh"):
        deleted = store.read(target).count() if base and mode == "full_refresh" else 0
        if staged.place == "stage":
            made = new_target(store, spec, staged.schema, keys, store.bucket_count(staged.size))
            store.fill(target, rows, made, staged.window, **layout)
        store.swap(target, run_id)
        return deleted
    if mode == "scoped_refresh":
        scope = F.lit(True)
        if spec.truncate_file:
            text = sqltext.read_text(spec.truncate_file)
            values = sqltext.template_values(spec, bounds.old, bounds.new)
            scope = F.expr(sqltext.with_literals(sqltext.delete_predicate(text), values))
        if spec.alias_column:
            scope &= F.col(spec.alias_column) == F.lit(spec.source.alias)
        return store.replace_where(target, run_id, rows, scope, staged.window, spec.sort_keys)
    load.staged_keys(rows, keys).write.parquet(f"{staged.folder}/keys")
    key_schema = T.StructType([staged.schema[k] for k in keys])
    back = spark.read.schema(key_schema).parquet(f"{staged.folder}/keys")
    matches = Written(back, load.key_bounds(back, keys).first())
    return store.upsert(target, run_id, rows, matches, keys, staged.size, spec.buckets, spec.sort_keys)


def log_extract(store: TargetStore, spec: SyncSpec, staged: Staged, started: datetime, ended: datetime) -> None:
    """The run's row in the extract monitor."""
    row = metrics.extract_monitor_row(
        TASK, spec.state_key, started, ended, staged.folder, staged.count, staged.size, staged.cut_values
    )
    append_monitor(store, "extract", staged.run_id, row)


def log_load(store: TargetStore, spec: SyncSpec, staged: Staged, deleted: int, started: datetime, ended: datetime) -> None:
    """The run's row in the load monitor."""
    row = metrics.load_monitor_row(
        TASK, spec.state_key, spec.target, started, ended, staged.folder, staged.count, deleted, staged.size
    )
    append_monitor(store, "load", staged.run_id, row)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _clock(now: datetime | None) -> datetime:
    return now or utc_now()


def stamp_of(run_id: str) -> datetime:
    return datetime.strptime(run_id.split("-")[0], "%Y%m%dT%H%M%S%f")


def sync_all(
    spark: SparkSession,
    specs: Iterable[SyncSpec],
    store: TargetStore,
    only: Sequence[str] = (),
    full_refresh: bool = False,
    rebuild: bool = False,
    monitor: bool = True,
) -> list[SyncResult]:
    """Sync many tables. One table's trouble does not stop the others of its source, unless it is of no known kind.

    Disabled tables and sources are left out unless the table is named in ``only``. Invalid specs are reported
    together at the end.
    """
    results: list[SyncResult] = []
    invalid: list[str] = []
    aborted: set[str] = set()
    for spec in specs:
        if (only and spec.source_table not in only) or (not only and not (spec.enabled and spec.source.enabled)):
            continue
        blank = SyncResult(spec.source.alias, spec.source_table, spec.target, "failed", spec.mode)
        if spec.source.alias in aborted:
            results.append(replace(blank, status="aborted", error="an earlier table of this source failed"))
            continue
        try:
            spec.validate()
        except SpecError as e:
            invalid.append(spec.source_table)
            results.append(replace(blank, status="invalid", error=str(e)))
            continue
        try:
            results.append(sync_table(spark, spec, store, full_refresh, rebuild, monitor))
        except (SchemaMismatch, NotImplementedError) as e:
            log.error("%s", e)
            results.append(replace(blank, status="skipped", error=str(e)))
        except (ValueError, TypeError, AnalysisException, PySparkException) as e:
            log.error("%s: %s", spec.source_table, e)
            results.append(replace(blank, error=str(e)))
        except Exception as e:
            log.exception("%s: giving up on source %s", spec.source_table, spec.source.alias)
            aborted.add(spec.source.alias)
            results.append(replace(blank, status="aborted", error=str(e)))
    if invalid:
        raise InvalidSpecs(invalid, results)
    return results


def results_frame(spark: SparkSession, results: Sequence[SyncResult]) -> DataFrame:
    return spark.createDataFrame([astuple(r) for r in results], RESULT_SCHEMA)


def plan_sync(spark: SparkSession, specs: Iterable[SyncSpec], store: TargetStore) -> DataFrame:
    """What a sync would do, one row per table, without extracting: status, bounds, mode, schema and layout."""
    rows: list[tuple[Any, ...]] = []
    state = StateLog(store)
    for spec in specs:
        conflict = spec.conflict() or spec.runtime_conflict()
        if conflict:
            rows.append((spec.source.alias, spec.source_table, spec.target, None, spec.mode, None, None, None, None, None, conflict))
            continue
        columns = None if spec.query_file else reader.catalogue_columns(spark, spec)
        table = None if spec.query_file else reader.read_table(spark, spec, columns=columns)
        bounds = resolve_bounds(spark, spec, state, table)
        extracted = extract(spark, spec, bounds, table, columns)
        base = store.latest(spec.target)
        status = reconcile.target_status(
            extracted.columns, base.struct.fieldNames() if base else (), (), spec.rebuild
        )
        creates = status in (reconcile.MISSING, reconcile.REBUILD)
        source_schema = extracted.schema if table is None else table.schema
        ddl = new_target_schema(spec, extracted, source_schema).toDDL() if creates else None
        rows.append(
            (
                spec.source.alias, spec.source_table, spec.target, status, spec.mode, bounds.old, bounds.lookback,
                bounds.new, ddl, layout_clause(spec.distribution_key, spec.sort_keys) or None, None,
            )
        )
    return spark.createDataFrame(
        rows,
        "alias STRING, source_table STRING, target STRING, status STRING, mode STRING, old_index_value STRING, "
        "lookback_index_value STRING, new_index_value STRING, create_columns STRING, layout STRING, conflict STRING",
    )
