from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import counting, huffman, packing, tokens
from tidemark.llm.catalogue import CATALOGUE

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def library(path, texts):
    found = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids for e in found]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_every_plain_character_splits_as_in_the_library(path):
    plain = [c for kind in tokens.plain_characters().values() for c in kind] + list("\t\n\r\x0b\x0c ")
    texts = [f"a{c}1{c}{c}. {c}b" for c in plain]
    assert [ids.tolist() for ids in tokens.Encoder(path).encode(texts)] == library(path, texts)


def clashing_texts():
    """Rulers whose signs are moved by 1,024 places, and two that no powers of one number modulo 2^64 tell apart."""
    moved = ["".join("+" if i == at else "-" for i in range(1500)) for at in (7, 1031)]
    odd = ["".join("-+"[(i.bit_count() + k) % 2] for i in range(4096)) for k in (0, 1)]
    return moved, odd


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pretokens_of_equal_hashes_have_the_ids_of_the_library(path):
    moved, odd = clashing_texts()
    split = tokens.Encoder(path).split(moved)
    assert len(split.hashes) == 2
    with pytest.raises(tokens.HashClash):
        tokens.Encoder(path).split(odd)
    encoder = tokens.Encoder(path)
    for texts in (moved, odd, [f"a {odd[0]} b"], [f"a {odd[1]} b"], ["a b"]):
        assert [ids.tolist() for ids in encoder.encode(texts)] == library(path, texts)


def test_pretokens_of_equal_hashes_are_counted(spark):
    moved, odd = clashing_texts()
    texts = [*moved, *odd, "one and two", f"{odd[0]} {odd[1]}"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = {r["doc_id"]: r["n_tokens"] for r in counting.count_tokens(frame, BYTES).collect()}
    assert rows == {i: len(ids) for i, ids in enumerate(library(BYTES, texts))}


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_texts_of_all_kinds_have_the_ids_of_the_library(path, odd_documents):
    rng = random.Random(11)
    small = list("ab1'- \n\tsrevmltdé²")
    texts = [t for _, t in odd_documents[0]]
    texts += ["".join(rng.choices(small, k=rng.randrange(25))) for _ in range(4000)]
    texts += ["<|endoftext|><|startoftext|> a", "é", "ẞ ẞ", "I'LL they'Re 'stand", "x'" * 30]
    got = [ids.tolist() for ids in tokens.Encoder(path).encode(texts)]
    assert got == library(path, texts)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_a_long_text_is_cut_where_pre_tokens_end(path, documents, monkeypatch):
    text = "  ".join(t for _, t in documents[0][:40])
    monkeypatch.setattr(tokens, "CHUNK", 500)
    assert "".join(tokens.cut(text, 500)) == text and len(list(tokens.cut(text, 500))) > 10
    assert [ids.tolist() for ids in tokens.Encoder(path).encode([text])] == library(path, [text])


def test_what_is_remembered_is_bounded(documents, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBER", 50)
    monkeypatch.setattr(tokens, "CHUNK", 2_000)
    texts = [t for _, t in documents[0][:60]]
    encoder = tokens.Encoder(BYTES)
    assert [ids.tolist() for ids in encoder.encode(texts)] == library(BYTES, texts)


def counted(frame):
    return sorted(map(tuple, counting.count_tokens(frame, BYTES).collect()), key=str)


def wanted_counts(docs):
    ids = library(BYTES, [t for _, t in docs])
    return sorted(((d, len((t or "").encode()), len(i)) for (d, t), i in zip(docs, ids)), key=str)


def test_token_counts_against_the_library(spark, sf_dir, documents):
    rows = CATALOGUE["op2_token_counts"](spark, sf_dir).collect()
    assert sorted((tuple(r)[:3] for r in rows), key=str) == wanted_counts(documents[0])
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in rows)


def test_token_counts_of_odd_documents(spark, odd_documents):
    assert counted(odd_documents[1]) == wanted_counts(odd_documents[0])
    assert counted(odd_documents[1].limit(0)) == []
    repeated = odd_documents[1].unionAll(odd_documents[1]).withColumn("doc_id", F.when(F.col("doc_id") > 5, F.col("doc_id")))
    rows = [(d if d > 5 else None, t) for d, t in odd_documents[0]] * 2
    assert counted(repeated) == wanted_counts(rows)


def test_any_number_of_short_texts_in_a_batch(spark):
    texts = ["", "xylograph", None, "a", "qwzxv qwzxv"]
    rows = [(i, texts[i % 5]) for i in range(150_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    lengths = [len(i) for i in library(BYTES, texts)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "0")
    try:
        got = counting.count_tokens(frame, BYTES).select("doc_id", "n_tokens").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(map(tuple, got)) == [(i, lengths[i % 5]) for i, _ in rows]


def test_large_counts_take_several_entries():
    entries, times = counting._entries(np.array([3, 5, 9]), np.array([700, 0, 255]), counting._ENTRY)
    assert times.tolist() == [3, 1, 1]
    assert [(e["place"], e["often"]) for e in entries] == [(3, 255), (3, 255), (3, 190), (5, 0), (9, 255)]


def check_packing(rows, ids):
    """``ids``: for each piece's doc_id, the ids of its document."""
    sequences, covered = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]]
        piece = own[r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(piece, "<u4")) and r["doc_tokens"] == len(own)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        covered[r["doc_id"]].append((r["start"], r["length"]))
    assert covered.keys() == ids.keys()
    for pieces, size in [(v, None) for v in sequences.values()] + [(covered[d], len(ids[d])) for d in ids]:
        end = 0
        for start, length in sorted(pieces):
            assert start == end and length > 0
            end += length
        assert end == size if size is not None else end <= 4096
    totals = [sum(n for _, n in v) for v in sequences.values()]
    return sum(4096 - n for n in totals if n & (n - 1)) / max(1, sum(totals))


def test_packing_against_the_library(spark, sf_dir, documents):
    ids = {d: i + [2] for (d, _), i in zip(documents[0], library(WORDS, [t for _, t in documents[0]]))}
    assert check_packing(CATALOGUE["op3_harmonic_packing"](spark, sf_dir).collect(), ids) < 0.01


def test_packing_of_odd_documents(spark, odd_documents):
    ids = {d: i + [2] for (d, _), i in zip(odd_documents[0], library(WORDS, [t for _, t in odd_documents[0]]))}
    rows = packing.pack(odd_documents[1].repartition(3), WORDS, with_ids=True).collect()
    check_packing(rows, ids)
    assert all(list(r["ids"]) == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]] for r in rows)
    assert packing.pack(odd_documents[1].limit(0), WORDS).count() == 0
    twice = packing.pack(odd_documents[1].unionAll(odd_documents[1]), WORDS).agg(F.sum("length")).first()[0]
    assert twice == 2 * sum(map(len, ids.values()))


def test_classes_fit_a_fixed_number_into_a_sequence():
    for length in range(1, 4097):
        pieces = packing.classed(length)
        assert sum(n for n, _ in pieces) == length
        assert all(n * k <= 4096 and 4096 - n * k <= max(0.02 * 4096, k) for n, k in pieces)


def test_bins_close_with_as_many_pieces_as_their_class_takes():
    bins = packing.Bins(0)
    closed = [bins.add(i, np.arange(1024, dtype=np.uint32)) for i in range(8)]
    assert [len(c) for c in closed] == [0, 0, 0, 4, 0, 0, 0, 4]
    assert bins.add(9, np.arange(100, dtype=np.uint32)) == [] and [len(p.ids) for p, _, _ in bins.end()]


def check_ids(rows, docs):
    """Rows in ascending order; of one id, in any."""
    wanted, start = {}, 0
    for d, ids in sorted(docs):
        wanted[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4")))
        start += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows} == wanted


def test_coded_ids_against_the_library(spark, sf_dir, documents):
    docs = [(d, i + [2]) for (d, _), i in zip(documents[0], library(BYTES, [t for _, t in documents[0]]))]
    check_ids(CATALOGUE["op6_huffman_ids"](spark, sf_dir).collect(), docs)


def test_coded_ids_of_odd_documents(spark, odd_documents, tmp_path):
    docs = [(d, i + [2]) for (d, _), i in zip(odd_documents[0], library(BYTES, [t for _, t in odd_documents[0]]))]
    huffman.write_ids(odd_documents[1].repartition(3), f"{tmp_path}/a", BYTES)
    rows = huffman.read_ids(spark, f"{tmp_path}/a", with_ids=True).collect()
    check_ids(rows, docs)
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == dict(docs)
    huffman.write_ids(odd_documents[1].limit(0), f"{tmp_path}/b", BYTES)
    assert huffman.read_ids(spark, f"{tmp_path}/b").count() == 0


def test_coded_ids_of_rows_that_share_an_id(spark, tmp_path):
    rows = [(None, "b"), (None, "a a"), (1, "x"), (1, "x"), (0, None)]
    huffman.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_path}/c", BYTES)
    got = sorted(huffman.read_ids(spark, f"{tmp_path}/c", with_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, None, 0, 1, 1]
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got[:-1]]).tolist()
    assert sorted(list(r["ids"]) for r in got) == sorted(i + [2] for i in library(BYTES, [t for _, t in rows]))


@pytest.mark.parametrize("counts", [[5], [0, 3, 0], [1, 1], [2**i for i in range(40)], [1] * 300 + [10**9], [0, 7, 7, 7, 1]])
def test_code_lengths_are_limited_and_shortest(counts):
    lengths = huffman.code_lengths(np.array(counts), 12)
    used = lengths[np.array(counts) > 0].astype(int)
    assert (lengths[np.array(counts) == 0] == 0).all() and used.min() >= 1 and used.max() <= 12
    assert len(used) == 1 or sum(2.0**-n for n in used) == 1
    free = huffman.code_lengths(np.array(counts), 60) if len(counts) < 50 else None
    if free is not None and free.max() <= 12:
        assert (np.array(counts) * free).sum() == (np.array(counts) * lengths).sum()


def test_codes_round_trip_over_many_checkpoints():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.3, 40_000), 5000).astype(np.uint32)
    counts = np.array([0, 1, 127, 128, 129, 0, 30_000, 40_000 - 30_385], np.int64)
    lengths = huffman.code_lengths(np.bincount(ids))
    codes = huffman.canonical(lengths)
    payload, sizes, checkpoints = huffman.encode(ids, counts, lengths, codes)
    table, longest = huffman.decoding_table(lengths)
    assert (huffman.decode(payload, counts, sizes, checkpoints, table, longest) == ids).all()
