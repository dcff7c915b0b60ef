from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import trie
from tidemark.llm.catalogue import CATALOGUE
from tidemark.session import written

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def in_order(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    return {c: [(role, text) for _, _, role, _, text in sorted(turns)] for c, turns in found.items()}


def rebuilt(rows):
    own = in_order(rows)
    out = {}
    for c in own:
        head = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:head] + own[c][head:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, mine in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(mine) - 1) * len(path[-1][1].encode()) if path else 0
    out = []
    for path, mine in members.items():
        ends = ",".join(str(c) for c in sorted(mine) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(mine), len(path), parent, len(mine), children.get(path, 0), leaves[path], saved[path],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows(frame):
    return sorted((tuple(r) for r in frame.select(COLUMNS).collect()), key=str)


def framed(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def made(seed, count=60, longest=12):
    rng = random.Random(seed)
    data = []
    for _ in range(count):
        conv = rng.randrange(count * 2)
        for turn in range(rng.randrange(1, longest)):
            data.append((conv, rng.choice([turn, turn, None]), rng.choice(["user", "assistant", None]), rng.choice(["hi", "héllo", "", None])))
    return data + data[:7] + [(None, 0, "user", "nobody's")]


def test_query_against_plain_python(spark, sf_dir):
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows(CATALOGUE["op13_conversation_prefix_trie"](spark, sf_dir)) == brute(rebuilt(data))


@pytest.mark.parametrize("seed", range(4))
def test_nulls_ties_repeated_rows_and_missing_sources(spark, seed):
    data = made(seed)
    assert any(not turns for turns in rebuilt(data).values()) or seed
    assert rows(trie.rebuilt_trie(framed(spark, data))) == brute(rebuilt(data))
    assert rows(trie.conversation_trie(framed(spark, data))) == brute(in_order(data))


@pytest.mark.parametrize("length", [1, 2, 3, 4, 7, 8, 9, 16, 33])
def test_every_depth(spark, length):
    rng = random.Random(length)
    data = [(c, t, "user", rng.choice("ab") if t > length // 2 else "a") for c in range(6) for t in range(length - (c == 3))]
    assert rows(trie.conversation_trie(framed(spark, data))) == brute(in_order(data))


def test_empty_table_clashing_columns_and_a_turnless_conversation(spark):
    frame = framed(spark, made(9)).withColumns({"depth": F.lit(1), "k1": F.lit("x"), "Part": F.lit(2), "place": F.lit(None)})
    assert rows(trie.rebuilt_trie(frame)) == brute(rebuilt(made(9)))
    assert rows(trie.rebuilt_trie(frame.limit(0))) == rows(trie.conversation_trie(frame.limit(0))) == []
    alone = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    assert rows(trie.rebuilt_trie(framed(spark, [(alone, 0, "user", "x")]))) == brute({alone: []})
    with pytest.raises(TypeError):
        trie.conversation_trie(frame.withColumn("conv_id", F.col("conv_id").cast("string")))


def test_one_conversation_with_a_third_of_all_turns(spark, monkeypatch):
    kept = {}

    def keeping(df, label):
        return kept.setdefault(label, written(df, label))

    monkeypatch.setattr(trie, "written", keeping)
    rng = random.Random(4)
    data = [(7, t, "user", rng.choice("abc")) for t in range(300)] + [(8, t, "user", "a") for t in range(300)]
    data += [(c, t, "user", rng.choice("abc")) for c in range(20, 120) for t in range(3)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        placed = trie.numbered(trie.named(framed(spark, data)), [F.col("turn")], "place")
        assert kept["numbered"].where("conv_id = 7").select("part").distinct().count() > 2
        assert placed.where("place <> turn + 1").count() == 0 and placed.count() == len(data)
        monkeypatch.undo()
        assert rows(trie.conversation_trie(framed(spark, data))) == brute(in_order(data))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_ids_of_a_hot_end_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(trie, "_JOINED", 100)
    data = [(c, 0, "user", "same" if c % 3 else str(c % 7)) for c in range(500)]
    assert rows(trie.conversation_trie(framed(spark, data))) == brute(in_order(data))
