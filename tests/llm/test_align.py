from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm import align
from tidemark.llm.catalogue import CATALOGUE

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(texts):
    """For each text its digest columns, one token after the other."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    bytes_a, bytes_b = align.bytes_of_entries(A), align.bytes_of_pieces(B)
    found = []
    for text in texts:
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        wanted = (" " + (text or "")).encode()
        spelled = [b"".join(table[i] for i in ids) for table, ids in ((bytes_a, ids_a), (bytes_b, ids_b))]
        if not text or spelled != [wanted, wanted]:
            found.append(None)
            continue
        groups, i, j = [], 0, 0
        while i < len(ids_a):
            mine, size_a, size_b = ([], []), 0, 0
            while not size_a or size_a != size_b:
                if size_a <= size_b:
                    mine[0].append(ids_a[i])
                    size_a, i = size_a + len(bytes_a[ids_a[i]]), i + 1
                else:
                    mine[1].append(ids_b[j])
                    size_b, j = size_b + len(bytes_b[ids_b[j]]), j + 1
            groups.append(mine)
        found.append((len(ids_a), len(ids_b), groups))
    count = Counter((x[-1], y[-1]) for f in found if f for x, y in f[2])
    highest = Counter()
    for (_, y), n in count.items():
        highest[y] = max(highest[y], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x[-1], y[-1]) for x, y in f[2]]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[2])
        best = sum(count[p] == highest[p[1]] for p in links)
        out.append((f[0], f[1], len(links), len(links), best, sum(map(count.get, links)), hashlib.sha256(text.encode()).hexdigest()))
    return out


def rows(frame):
    return sorted((tuple(r) for r in frame.select(COLUMNS).collect()), key=str)


def wanted(docs):
    return sorted(((d, *x) for (d, _), x in zip(docs, brute([t for _, t in docs]))), key=str)


def test_query_against_one_token_after_the_other(spark, sf_dir, documents):
    assert rows(CATALOGUE["op11_cross_tokenizer_alignment"](spark, sf_dir)) == wanted(documents[0])


def test_odd_documents(spark, odd_documents):
    docs, frame = odd_documents
    more = ["a▁b", "<s> </s> <unk> <0x41>", "x\x00y", "\r\n\r\n  \t", "<|endoftext|><|endoftext|>", "é ﬁ 　"]
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(more)], "doc_id long, text string")
    got = rows(align.align(frame.unionByName(extra, allowMissingColumns=True), A, B))
    assert got == wanted(docs + [(1000 + i, t) for i, t in enumerate(more)])
    assert [r[1] for r in got if r[0] == 1000] == [0]  # its tokens spell a blank in place of U+2581
    assert rows(align.align(frame.limit(0), A, B)) == []


def test_repeated_rows_ids_and_clashing_columns(spark, odd_documents):
    docs, frame = odd_documents
    twice = frame.unionAll(frame).withColumn("doc_id", F.when(F.col("doc_id") > 9, F.col("doc_id") % 20))
    twice = twice.withColumns({"pair": F.lit("x"), "links": F.lit(1), "Times": F.lit(None)})
    again = [(d % 20 if d > 9 else None, t) for d, t in docs] * 2
    assert rows(align.align(twice, A, B)) == wanted(again)


def test_groups_are_told_as_text(spark):
    frame = spark.createDataFrame([("x", "hello wörld 123"), ("y", None)], "name string, body string")
    found = {r["doc_id"]: r for r in align.align(frame, A, B, "name", "body", with_groups=True).collect()}
    assert hashlib.sha256(found["x"]["groups"].encode()).hexdigest() == found["x"]["groups_sha256"]
    of_a, of_b = align.bytes_of_entries(A), align.bytes_of_pieces(B)
    for group in found["x"]["groups"].split(";"):
        a, b = ([int(i) for i in side.split(",")] for side in group.split("|"))
        assert b"".join(map(of_a.__getitem__, a)) == b"".join(map(of_b.__getitem__, b))
    assert found["y"]["groups"] == found["y"]["groups_sha256"] == ""


@pytest.mark.parametrize("lane", [1, 2, 7, 10_000])
def test_lockstep_finds_all_common_ends(lane):
    rng = random.Random(lane)
    ends, counts, at = ([], []), [], 0
    for _ in range(200):
        size = rng.randrange(1, 60)
        mine = [sorted({*rng.sample(range(1, size + 1), rng.randrange(size)), size}) for _ in range(2)]
        counts.append(len(mine[0]))
        for side, own in zip(ends, mine):
            side += [at + x for x in own]
        at += size
    cut_a, cut_b = align.lockstep(np.array(ends[0]), np.array(counts), np.array(ends[1]), lane)
    common = set(ends[0]) & set(ends[1])
    assert cut_a.tolist() == [x in common for x in ends[0]] and cut_b.tolist() == [x in common for x in ends[1]]


def test_pairs_are_bounded_by_the_vocabularies(spark, documents):
    of_a, of_b = align.bytes_of_entries(A), align.bytes_of_pieces(B)
    small = [b"a", b"ba", b"cba", b"x"], [b"a", b"cba", b"x", b"a"]
    by_hand = sum(a.endswith(b) or b.endswith(a) for a in small[0] for b in small[1])
    assert align.pair_bound(*small) == by_hand
    assert align.pair_bound(of_a, of_b) < 16 * (len(of_a) + len(of_b))
