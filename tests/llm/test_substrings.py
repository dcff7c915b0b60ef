from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import substrings
from tidemark.llm.catalogue import CATALOGUE

_WORDS = re.compile("[^\x20\x09-\x0d]+")


def brute(docs, size=20):
    """(id, words, removed, kept text), one window after the other. Ids are distinct; those that are null come last."""
    seen, out = set(), []
    for doc, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        words = _WORDS.findall(text or "")
        gone = set()
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone.update(range(i, i + size))
            seen.add(window)
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def rows(frame, **options):
    return sorted(map(tuple, substrings.remove_repeats(frame, **options).collect()), key=str)


def framed(spark, docs, parts=3):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_WORDS", 400)


def test_query_against_window_after_window(spark, sf_dir, documents):
    got = sorted(map(tuple, CATALOGUE["op12_substring_dedup"](spark, sf_dir).collect()), key=str)
    assert got == [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(documents[0])]


def test_documents_in_many_blocks(spark, documents, small_blocks):
    assert rows(framed(spark, documents[0], 7)) == brute(documents[0])


def few_words(rng, count):
    """Texts of few different words, in runs and with passages from each other, so that windows repeat in all ways."""
    pool = [" ".join(rng.choices("ab", k=rng.randrange(1, 60))) for _ in range(6)]
    pool += [" ".join(["ha"] * rng.randrange(1, 50)) for _ in range(4)]
    pool += [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 70))) for _ in range(12)]
    return [(i, rng.choice([" ", "\n", "\t \r"]).join(rng.choices(pool, k=rng.randrange(1, 7)))) for i in range(count)]


@pytest.mark.parametrize("seed", range(6))
def test_texts_that_repeat_in_all_ways(spark, small_blocks, seed):
    rng = random.Random(seed)
    docs = few_words(rng, 120)
    rng.shuffle(docs)
    for size in (20, 5, 2) if seed < 2 else (20,):
        assert rows(framed(spark, docs, 5), window=size) == brute(docs, size)


def test_odd_documents(spark, odd_documents):
    docs, frame = odd_documents
    assert rows(frame) == brute(docs)
    assert rows(frame.limit(0)) == []
    clash = frame.withColumnsRenamed({"k1": "kind", "drop": "block"}).withColumn("Ids", F.lit(1))
    assert rows(clash.withColumn("doc_id", F.col("doc_id").cast("int"))) == brute(docs)
    with pytest.raises(TypeError):
        substrings.remove_repeats(frame.withColumn("doc_id", F.col("doc_id").cast("string")))


def test_repeated_rows_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = [(4, text), (4, text), (None, text), (None, None), (2, text[:40]), (7, f"x {text}")]
    got = rows(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    lost = {(4, 30, 0, text): 1, (4, 30, 30, ""): 1, (None, 30, 30, ""): 1, (7, 31, 30, "x"): 1}
    assert {r: got.count(r) for r in lost} == lost and len(got) == 6


def test_windows_are_judged_on_the_input(spark):
    words = [f"w{i}" for i in range(60)]
    docs = [(1, " ".join(words[:40])), (2, " ".join(words[20:])), (3, " ".join(words[30:50]))]
    assert rows(framed(spark, docs)) == brute(docs)


@pytest.mark.parametrize("seed", range(8))
def test_equal_windows_have_equal_symbols_inside(seed):
    """Wherever a passage stands, the same places of it are inside, and the symbols that start there are the same."""
    rng = random.Random(seed)
    kinds = rng.choice([2, 3, 30])
    passage = [rng.randrange(kinds) for _ in range(20)]
    texts = [[rng.randrange(kinds) for _ in range(rng.randrange(30))] for _ in range(200)]
    flat, docs, at = [], [], []
    for i, text in enumerate(texts):
        cut = rng.randrange(len(text) + 1)
        at.append(len(flat) + cut)
        flat += text[:cut] + passage + text[cut:]
        docs += [i] * (len(text) + 20)
    table = np.random.default_rng(3).integers(0, 2**63, (2, kinds), dtype=np.uint64)
    names, docs = [t[np.array(flat)] for t in table], np.array(docs)
    found = list(substrings.levels(names, docs, 3))
    for depth in (1, 2, 3):
        low, high = substrings.inner(np.array(at), 20, found[:depth], len(flat))
        own = set()
        for start, a, b in zip(at, low.tolist(), high.tolist()):
            level = found[depth - 1]
            some = (level.starts >= a) & (level.starts < b) if a < b else np.zeros(len(level.starts), bool)
            own.add((max(b - a, 0), *zip((level.starts[some] - start).tolist(), level.names[0][some].tolist())))
        assert len(own) == 1
        if kinds == 30 and depth < 3:
            assert own.pop()[0] > 0


def test_equal_names_mean_equal_words():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, 50_000)
    table = rng.integers(0, 2**63, (2, 3), dtype=np.uint64)
    docs = np.repeat(np.arange(500), 100)
    for level in substrings.levels([t[words] for t in table], docs, 6):
        ends = np.append(level.starts[1:], len(words))
        spelled = {}
        for a, b, x, y in zip(level.starts, ends, *level.names):
            assert spelled.setdefault((x, y), words[a:b].tobytes()) == words[a:b].tobytes()
            assert docs[a] == docs[b - 1]
