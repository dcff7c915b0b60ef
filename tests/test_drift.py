from __future__ import annotations

import random

import pytest

import __spark_entry__ as entry
from shown import plan_text
from tidemark.operators import drift

SCHEMA = "k long, v string, w double"


def brute(target, source):
    def by_key(rows):
        found = {}
        for row in rows:
            if row[0] is not None:
                found.setdefault(row[0], []).append(row[1:])
        return {k: sorted(v, key=str) for k, v in found.items()}

    left, right = by_key(target), by_key(source)
    out = {k: "deleted" if k not in right else "added" if k not in left else "changed" for k in left.keys() | right.keys()}
    return sorted((k, c) for k, c in out.items() if left.get(k) != right.get(k))


def found(spark, target, source, **options):
    frames = (spark.createDataFrame(rows, SCHEMA) for rows in (target, source))
    return sorted(map(tuple, drift.source_drift(*frames, "k", **options).collect()))


@pytest.mark.parametrize("seed", range(5))
def test_drift_against_plain_python(spark, seed, monkeypatch):
    monkeypatch.setattr(drift, "MAX_RUNS", 3 if seed % 2 else 500)
    rng = random.Random(seed)
    target = [(rng.randrange(-3000, 3000) if rng.random() > 0.02 else None, rng.choice(["a", "b", None]), rng.choice([1.5, None])) for _ in range(500)]
    source = [r for r in target if rng.random() > 0.05]
    source = [(k, "changed", w) if rng.random() < 0.03 else (k, v, w) for k, v, w in source]
    source += [(rng.randrange(-4000, 4000), "new", 0.0) for _ in range(9)]
    assert found(spark, target, source, leaf=16, fanout=4) == brute(target, source)


def test_equal_sides_and_empty_sides(spark):
    rows = [(1, "a", 1.0), (2, None, None), (None, "x", 0.0)]
    assert found(spark, rows, rows[::-1]) == [] == found(spark, [], [])
    assert found(spark, rows, []) == [(1, "deleted"), (2, "deleted")]
    assert found(spark, [], rows) == [(1, "added"), (2, "added")]
    # A value that moves to another column is a change; so is a key that comes twice.
    assert found(spark, [(1, "a", None)], [(1, None, None)]) == [(1, "changed")]
    assert found(spark, rows[:1], rows[:1] * 2) == [(1, "changed")]


def test_sound_ranges_are_not_read_on_lower_levels(spark, tmp_path, monkeypatch):
    rows = spark.range(100_000).selectExpr("id AS k", "concat('v', id) AS v", "1.0D AS w").coalesce(1)
    rows.write.option("parquet.block.size", 64_000).parquet(str(tmp_path / "target"))
    target = spark.read.parquet(str(tmp_path / "target"))
    source = target.where("k <> 70001").selectExpr("k", "IF(k BETWEEN 70010 AND 70012, 'x', v) AS v", "w")
    seen = []
    digests = drift.range_digests

    def watching(df, key, columns, width):
        seen.append((width, df.count(), plan_text(df.select("k"))))
        return digests(df, key, columns, width)

    monkeypatch.setattr(drift, "range_digests", watching)
    got = sorted(map(tuple, drift.source_drift(target, source, "k", leaf=64, fanout=32).collect()))
    assert got == [(70001, "deleted"), (70010, "changed"), (70011, "changed"), (70012, "changed")]
    by_width = {width: n for width, n, _ in seen}
    widths = sorted(by_width, reverse=True)
    assert by_width[widths[0]] >= 99_999 and by_width[widths[-1]] <= 32 * 64 * 2
    lowest = next(plan for width, _, plan in seen if width == widths[-1])
    assert "GreaterThanOrEqual(k," in lowest and "LessThanOrEqual(k," in lowest


def test_many_differing_ranges_are_met_by_a_join(spark, monkeypatch):
    monkeypatch.setattr(drift, "MAX_RUNS", 2)
    target = [(k, "a", 1.0) for k in range(0, 4000, 10)]
    source = [(k, "b" if k % 400 == 0 else "a", 1.0) for k in range(0, 4000, 10)]
    assert found(spark, target, source, leaf=8, fanout=4) == brute(target, source)


def test_runs_join_neighbours():
    assert drift.runs_of([5, 3, 4, -1, 9], 10) == [(-10, -1), (30, 59), (90, 99)]


def test_the_query_finds_all_kinds(spark, sf_dir):
    kinds = {r[0] for r in entry.queries()["source_drift"](spark, sf_dir).select("change").distinct().collect()}
    assert kinds == {"deleted", "added", "changed"}
