from __future__ import annotations

from dataclasses import fields

import pytest

from tidemark.operators.reconcile import INCORRECT, MISSING, OK, REBUILD, target_status
from tidemark.operators.rules import spec_conflicts
from tidemark.spec import SourceSpec, SpecError, SpecFlags, SyncSpec

SOURCE = SourceSpec("alias", "test_db")


def spec(**given):
    return SyncSpec(SOURCE, "source", "table", **given)


@pytest.mark.parametrize(
    "given",
    [
        {"full_refresh": True},
        {"index_column": "id"},
        {"index_sql": "SELECT 1 AS index_value"},
        {"index_column": "id", "append_only": True},
        {"index_sql": "SELECT 1 AS index_value", "append_only": True},
    ],
)
def test_valid(given):
    assert spec(**given).validate().conflict() is None


@pytest.mark.parametrize(
    ("given", "conflict"),
    [
        ({}, "incremental without index"),
        ({"append_only": True}, "append_only without index"),
        ({"full_refresh": True, "index_column": "id"}, "full_refresh with index_column"),
        ({"full_refresh": True, "index_sql": "x"}, "full_refresh with index_sql"),
        ({"full_refresh": True, "index_column": "id", "append_only": True}, "append_only with full_refresh"),
        ({"index_sql": "x", "index_column": "id"}, "index_sql with index_column"),
        ({"index_column": "id", "query_file": __file__}, "incremental query_file without primary_key"),
        ({"full_refresh": True, "query_file": "/nowhere"}, "missing query_file"),
        ({"full_refresh": True, "schema_file": "/nowhere"}, "missing schema_file"),
    ],
)
def test_invalid(given, conflict):
    assert spec(**given).conflict() == conflict
    with pytest.raises(SpecError):
        spec(**given).validate()


@pytest.mark.parametrize(
    ("given", "conflict"),
    [
        ({"rebuild": True, "full_refresh": True, "truncate_file": "x"}, "rebuild with truncate_file"),
        ({"rebuild": True, "full_refresh": True, "schema_file": "x"}, "rebuild with schema_file"),
        ({"rebuild": True}, "rebuild without full_refresh"),
        ({"rebuild": True, "full_refresh": True}, None),
    ],
)
def test_runtime_rules(given, conflict):
    assert spec(**given).runtime_conflict() == conflict


def test_frame_rules_agree_with_single_specs(spark):
    names = [f.name for f in fields(SpecFlags)]
    import itertools
    import random

    import numpy as np

    from tidemark.spec import RUNTIME_RULES, STATIC_RULES

    random.seed(5)
    combinations = random.sample(list(itertools.product([False, True], repeat=len(names))), 400)
    frame = spark.createDataFrame(combinations, ", ".join(f"{n} boolean" for n in names))
    for row in spec_conflicts(frame).collect():
        flags = SpecFlags(**{n: np.bool_(row[n]) for n in names})
        for rules, found in ((STATIC_RULES, row.conflict), (RUNTIME_RULES, row.runtime_conflict)):
            assert found == next((name for name, broken in rules if broken(flags)), None)


def test_forced_modes():
    base = spec(index_column="id")
    assert base.mode == "upsert"
    assert base.forced(full_refresh=True).mode == "full_refresh"
    assert base.forced(rebuild=True).mode == "rebuild"
    assert spec(index_column="id", append_only=True).mode == "append"


def test_state_key_override():
    assert spec(index_column="id").state_key == ("alias", "test_db", "source")
    assert spec(index_column="id", override_database="o").state_database == "o"
    source = SourceSpec("alias", "test_db", override_database="common")
    assert SyncSpec(source, "s", "t").state_database == "common"
    assert SyncSpec(source, "s", "t", override_database="own").state_database == "own"


@pytest.mark.parametrize(
    ("source", "target", "dropped", "rebuild", "status"),
    [
        ("abc", "abc", "", False, OK),
        ("abc", "ab", "c", False, OK),
        ("abc", "ab", "", False, OK),
        ("ab", "abc", "", False, INCORRECT),
        ("abc", "abc", "c", False, INCORRECT),
        ("abc", "", "", False, MISSING),
        ("abc", "", "", True, MISSING),
        ("ab", "abc", "", True, REBUILD),
    ],
)
def test_target_status(source, target, dropped, rebuild, status):
    assert target_status(set(source), set(target), set(dropped), rebuild) == status


def test_unknown_kind_of_source():
    with pytest.raises(SpecError):
        SourceSpec("a", "b", "oracle")
