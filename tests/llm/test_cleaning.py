from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, lines, quality, simhash
from tidemark.llm.catalogue import CATALOGUE
from tidemark.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def by_id(frame, *columns):
    return {r[0]: tuple(r[1:]) for r in frame.select("doc_id", *columns).collect()}


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lines_of(frame):
    kept = lines.dedup_lines(frame, counts=True)
    return by_id(kept, "n_lines", "n_dropped", F.sha2("text", 256))


def test_line_dedup_against_brute_force(spark, sf_dir, documents):
    got = by_id(CATALOGUE["op7_line_dedup"](spark, sf_dir), "n_lines", "n_dropped", "kept_sha256")
    assert got == brute.line_dedup(documents[0])
    assert sum(v[1] for v in got.values()) > 0


def test_line_dedup_of_odd_documents(odd_documents):
    assert lines_of(odd_documents[1]) == brute.line_dedup(odd_documents[0])
    kept = lines.dedup_lines(odd_documents[1])
    assert kept.columns == odd_documents[1].columns
    assert {r["k1"] for r in kept.collect()} == {"keep"}


def test_line_dedup_of_nothing_and_of_rows_without_id(spark):
    assert lines_of(empty(spark)) == {}
    line = "a line of twenty characters and more"
    rows = [(None, line, "", "", 0), (None, line + "\nx", "", "", 0), (1, line, "", "", 0), (2, line, "", "", 0)]
    out = lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "text").collect()
    assert sorted(out, key=str) == sorted([(None, ""), (None, "x"), (1, ""), (2, line)], key=str)


def quality_of(frame):
    return by_id(quality.judge(frame), *quality.BASE, "base_failed")


def test_quality_counts_against_brute_force(spark, sf_dir, documents):
    rows = by_id(CATALOGUE["op5_quality_cascade"](spark, sf_dir), *quality.BASE, "base_failed", "kept")
    assert {k: v[:-1] for k, v in rows.items()} == {k: brute.quality(t) for k, t in documents[0]}
    assert not any(v[-1] for v in rows.values() if v[-2])


def test_quality_of_odd_documents(spark, odd_documents):
    assert quality_of(odd_documents[1]) == {k: brute.quality(t) for k, t in odd_documents[0]}
    assert quality_of(empty(spark)) == {}
    kept = quality.keep_good(odd_documents[1])
    assert kept.columns == odd_documents[1].columns
    judged = quality.judge(odd_documents[1])
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in judged.where("kept").collect()}


def test_the_order_of_rules_does_not_change_verdicts(spark, documents):
    frame = documents[1]
    one, other = (
        quality.measured(frame.select("doc_id", "text")).select("doc_id", quality.verdict(rules).alias("kept"))
        for rules in (quality.RULES, quality.RULES[::-1])
    )
    assert by_id(one, "kept") == by_id(other, "kept")


def test_rules_run_by_rejections_for_their_cost(spark):
    words = " ".join(f"word{i}" for i in range(80))
    texts = spark.createDataFrame([(f"{words} {i}",) for i in range(40)], "text string")
    never = quality.Rule("never", lambda: F.col("n_words") >= 0)
    always = quality.Rule("always", lambda: F.col("n_words") < 0)
    assert [r.name for r in quality.ordered(texts, [never, always])] == ["always", "never"]


def test_quality_runs_no_python_on_rows(spark, sf_dir):
    plan = CATALOGUE["op5_quality_cascade"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def decontaminated(frame, items, **options):
    scanned = decontaminate.scan(frame, items, **options)
    columns = ["n_words", "n_hit", F.size("item_ids"), F.sha2(F.array_join("item_ids", ","), 256), F.col("n_hit") > 0]
    return by_id(scanned, *columns)


def test_decontamination_against_brute_force(spark, sf_dir, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    columns = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = by_id(CATALOGUE["op10_benchmark_decontamination"](spark, sf_dir), *columns)
    assert got == brute.decontaminate(documents[0], items)
    assert any(v[-1] for v in got.values())


@pytest.mark.parametrize("chars", [decontaminate.AUTOMATON_CHARS, 100])
def test_decontamination_of_odd_documents(spark, odd_documents, chars):
    texts = dict(odd_documents[0])
    items = [(1, "One"), (2, None), (3, " "), (4, "beta, ça!"), (5, texts[30]), (6, texts[30]), (7, "alpha " * 12), (8, "it s")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminated(odd_documents[1], benchmark, automaton_chars=chars) == brute.decontaminate(odd_documents[0], items)


def test_decontamination_of_nothing(spark, odd_documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminated(odd_documents[1], none) == brute.decontaminate(odd_documents[0], [])
    assert decontaminated(empty(spark), none) == {}
    assert decontaminate.decontaminate(odd_documents[1], none).columns == odd_documents[1].columns


def test_a_beginning_that_a_third_of_all_items_share(spark):
    """Only windows travel to the scan; the items of a window that very many share are joined to what was hit."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    start = "in the following question choose the best answer of all"
    items = [(i, (f"{start} " if i % 3 == 0 else "") + " ".join(rng.choices(words, k=9))) for i in range(6000)]
    texts = [f"so {start} or none", items[3][1], f"x {items[4][1]} y {start}", "nothing at all", None, f"{items[7][1]} {items[9][1]}"]
    docs = [(i, texts[i % len(texts)]) for i in range(60)]
    frame = spark.createDataFrame([(*d, "", "", 0) for d in docs], SCHEMA)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    held, patterns = decontaminate._patterns(benchmark, "item_id", "text", 10)
    shards = list(decontaminate._shards(patterns, 20_000))
    assert all(isinstance(n, int) and isinstance(w, bytes) for shard in shards for n, w in shard) and len(shards) > 10
    assert max(sum(len(w) + 2 for _, w in shard) for shard in shards) < 40_000
    assert sum(map(len, shards)) == patterns.count() < held.count()
    wanted = brute.decontaminate(docs, items)
    assert decontaminated(frame, benchmark) == wanted
    assert decontaminated(frame, benchmark, automaton_chars=100_000) == wanted
    assert wanted[0][2] == 2000


def test_spans_point_into_the_original_text(spark):
    text = "Vorab: “Ça VA, Bien!” – ça va bien?"
    docs = spark.createDataFrame([(1, text, "", "", 0)], SCHEMA)
    items = spark.createDataFrame([(9, "ça va bien")], "item_id long, text string")
    spans = decontaminate.scan(docs, items).first()["spans"]
    # The quotation marks are beyond ASCII, so they belong to words.
    assert [text[s["start"] : s["end"]] for s in spans] == ["ça va bien"]
    assert decontaminate.decontaminate(docs, items).count() == 0


def groups_of(frame, **options):
    rows = simhash.near_groups(frame).select("doc_id", simhash.hex_fingerprint(F.col("bits")), "component_id").collect()
    return {r[0]: (r[1], r[2]) for r in rows}


def wanted_groups(docs):
    prints = [(d, brute.fingerprint(t)) for d, t in docs]
    found = brute.groups(prints)
    return {d: (f"{p:016x}", found[d]) for d, p in prints}


def test_simhash_against_brute_force(spark, sf_dir, documents):
    got = by_id(CATALOGUE["op4_simhash_near_dedup"](spark, sf_dir), "fingerprint", "component_id")
    assert got == wanted_groups(documents[0])
    assert any(d != v[1] for d, v in got.items())


def test_simhash_of_odd_documents(spark, odd_documents):
    assert groups_of(odd_documents[1]) == wanted_groups(odd_documents[0])
    assert groups_of(empty(spark)) == {}


@pytest.mark.parametrize("direct", [3, 50, 2048])
def test_links_of_crowded_keys_lose_nothing(spark, direct):
    rng = random.Random(direct)
    centres = [rng.getrandbits(64) for _ in range(3)]
    prints = set(centres)
    for centre in centres:
        for _ in range(120):
            near = centre
            for _ in range(rng.randrange(1, 8)):
                near ^= 1 << rng.randrange(64)
            prints.add(near)
    prints |= {rng.getrandbits(64) for _ in range(50)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.near_links(spark.createDataFrame(signed, "bits long"), direct=direct)
    pairs = [(a & (2**64 - 1), b & (2**64 - 1)) for a, b in links.collect()]
    assert all(0 < (a ^ b).bit_count() <= 4 for a, b in pairs)
    numbered = [(i, p) for i, p in enumerate(sorted(prints))]
    place = {p: i for i, p in numbered}
    found = components(spark.createDataFrame([(place[a], place[b]) for a, b in pairs], "a long, b long"))
    got = dict(found.collect())
    assert {i: got.get(i, i) for i, _ in numbered} == brute.groups(numbered)


@pytest.mark.parametrize(("bits", "direct"), [(range(3, 19), 200), (range(10, 40), 300), (range(0, 64, 3), 1000)])
def test_very_many_fingerprints_under_one_key(spark, bits, direct):
    """Fingerprints that differ in few of their bits share most keys; each level cuts the bits in which they differ."""
    rng = np.random.default_rng(len(bits))
    places = np.array(list(bits), np.uint64)
    chosen = rng.integers(0, 2, (12_000, len(places)), dtype=np.uint64)
    prints = np.unique((chosen << places).sum(axis=1, dtype=np.uint64) ^ np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
    if len(bits) < 20:
        prints = rng.choice(prints, 4000, replace=False)
    links = simhash.near_links(spark.createDataFrame([(int(p),) for p in prints], "bits long"), direct=direct)
    pairs = np.array(links.collect(), np.int64).reshape(-1, 2)
    assert (np.bitwise_count((pairs[:, 0] ^ pairs[:, 1]).view(np.uint64)) <= 4).all()
    root = np.arange(len(prints))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    order = np.argsort(prints)
    for a, b in zip(*(order[np.searchsorted(prints[order], pairs[:, i])] for i in (0, 1))):
        root[find(a)] = find(b)
    found = np.array([find(i) for i in range(len(prints))])
    for i, one in enumerate(prints):
        near = np.bitwise_count((prints ^ one).view(np.uint64)) <= 4
        assert (found[near] == found[i]).all()


def test_a_group_with_a_third_of_all_fingerprints_is_split(spark):
    """The last join's key is the group's root; AQE deals the classes of a hot one to several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        classes = spark.range(30_000).select(F.col("id").alias("bits"), (F.col("id") + 1000).alias("first")).repartition(8)
        roots = spark.range(1, 10_000).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("root"))
        named = simhash._named(classes, roots)
        wrong = named.where(F.col("component_id") != F.when(F.col("bits") < 10_000, 1000).otherwise(F.col("bits") + 1000))
        assert named.count() == 30_000 and wrong.count() == 0
        named.collect()
        assert "SortMergeJoin(skew=true)" in named._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_one_document_of_each_group_stays(spark, odd_documents):
    kept = simhash.keep_first(odd_documents[1])
    assert kept.columns == odd_documents[1].columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({v[1] for v in wanted_groups(odd_documents[0]).values()})
    rows = [(None, "a b c d e", "", "", 0), (4, "a b c d e", "", "", 0), (4, "a b c d e", "", "", 0), (None, "q r s", "", "", 0)]
    kept = simhash.keep_first(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "text").collect()
    assert sorted(kept, key=str) == sorted([(4, "a b c d e"), (None, "q r s")], key=str)


def test_components_of_a_long_path_a_star_and_a_ring(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(9, 8), (8, 7), (7, 9), (3, 3)]
    got = dict(components(spark.createDataFrame([*links, (None, 4)], "a long, b long")).collect())
    assert got == {i: 100 for i in range(101, 161)} | {i: 500 for i in range(501, 560)} | {8: 7, 9: 7}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
