"""Alignment of two tokenizers' tokens, by merging the ends of all documents of a batch in lockstep.

Both tokenizers cut the same bytes. One vector of pointers holds a place in the tokens of A, and one a place in the tokens of
B, for each document of a batch; a step compares where the two tokens of every document end, marks a link and a cut where they
end together, and advances the pointer whose token ends first. Documents that are through leave the vectors. A long document
takes several places in them, each beginning after a known token of A.

Linked tokens end together, so the bytes of one end with the bytes of the other: the distinct pairs are bounded by the two
vocabularies, whatever the corpus. Their counts are summed by Spark and broadcast to the written links.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import types
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import col
from tidemark.llm.tokens import Encoder, _byte_signs
from tidemark.session import written

#: Characters that are aligned at once; a longer document by itself.
CHUNK = 500_000
#: Tokens of A that one pointer goes through.
LANE = 128
#: Distinct pairs that a task holds before it passes their counts on.
_PAIRS_AT = 1_000_000

_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")


def bytes_of_entries(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizers file; an added token is its own text."""
    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    back = {chr(sign): byte for byte, sign in _byte_signs().items()}
    entries = {i: bytes(back[c] for c in entry) for entry, i in settings["model"]["vocab"].items()}
    entries |= {t["id"]: t["content"].encode() for t in settings["added_tokens"]}
    return [entries.get(i, b"") for i in range(max(entries) + 1)]


def bytes_of_pieces(path: str) -> list[bytes]:
    """The bytes of each id of a sentencepiece model."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    single = [_BYTE_PIECE.fullmatch(p) for p in pieces]
    return [bytes([int(s[1], 16)]) if s else p.replace("▁", " ").encode() for s, p in zip(single, pieces)]


def pair_bound(of_a: list[bytes], of_b: list[bytes]) -> int:
    """How many pairs of ids can be linked at all: those in which the bytes of one end with the bytes of the other."""
    times_a, times_b = Counter(of_a), Counter(of_b)
    whole = sum(times_b[a[i:]] for a in of_a for i in range(len(a)))
    return whole + sum(times_a[b[i:]] for b in of_b for i in range(1, len(b)))


class Pair:
    """Two tokenizers, and what is known of their ids."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.a, self.b = Encoder(path_a, special=False), SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = bytes_of_entries(path_a), bytes_of_pieces(path_b)
        self.size_a, self.size_b = (np.array([len(x) for x in y], np.int64) for y in (self.bytes_a, self.bytes_b))
        self.ids = max(len(self.bytes_a), len(self.bytes_b))
        # An id with the sign after it: within a side, after A's last of a group, after B's last of a group.
        self.signs = [b"%d%b" % (i, sign) for sign in (b",", b"|", b";") for i in range(self.ids)]

    def ids_of(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of A and B of each text; none where they do not spell a blank and the text."""
        spelled = [" " + t for t in texts]
        found_a = list(self.a.encode(spelled))
        found_b = self.b.encode(texts, num_threads=1)
        none = np.empty(0, np.uint32)
        out_a, out_b = [], []
        for text, a, b in zip(spelled, found_a, found_b):
            wanted = text.encode("utf-8", "surrogatepass")
            ok = (
                len(text) > 1
                and b"".join(map(self.bytes_b.__getitem__, b)) == wanted
                and b"".join(map(self.bytes_a.__getitem__, a.tolist())) == wanted
            )
            out_a.append(a if ok else none)
            out_b.append(np.array(b, np.uint32) if ok else none)
        return out_a, out_b


def pair_for(path_a: str, path_b: str) -> Pair:
    """The two tokenizers that this Python worker already has; workers outlive tasks."""
    kept = sys.modules.setdefault("tidemark_worker_pairs", types.ModuleType("tidemark_worker_pairs"))
    key = f"{path_a}\0{path_b}"
    if key not in kept.__dict__:
        kept.__dict__.clear()
        kept.__dict__[key] = Pair(path_a, path_b)
    return kept.__dict__[key]


def lockstep(ends_a: np.ndarray, counts_a: np.ndarray, ends_b: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of A and which of B are last in a group. Ends ascend over all documents, one after the other;
    ``counts_a``: the tokens of A of each document that has any."""
    cut_a, cut_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    lanes = -(-counts_a // lane)
    within = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    a = np.repeat(np.cumsum(counts_a) - counts_a, lanes) + within * lane
    # A pointer into B begins after what ends no later than the token of A before it.
    b = np.searchsorted(ends_b, ends_a[a - 1], side="right")
    b[:1] = 0
    stop_a, stop_b = np.append(a[1:], len(ends_a)), np.append(b[1:], len(ends_b))
    keep = b < stop_b
    while len(a):
        if not keep.all():
            a, b, stop_a, stop_b = a[keep], b[keep], stop_a[keep], stop_b[keep]
        at_a, at_b = ends_a[a], ends_b[b]
        next_a, next_b = at_a <= at_b, at_b <= at_a
        together = next_a & next_b
        cut_a[a[together]] = True
        cut_b[b[together]] = True
        a, b = a + next_a, b + next_b
        keep = (a < stop_a) & (b < stop_b)
    return cut_a, cut_b


def grouped(ids_a: np.ndarray, cut_a: np.ndarray, ids_b: np.ndarray, cut_b: np.ndarray, ids: int) -> np.ndarray:
    """The tokens of both sides, group by group, A before B, as places in ``Pair.signs``."""
    last_a, last_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
    out = np.empty(len(ids_a) + len(ids_b), np.int64)
    before_b = np.concatenate(([0], last_b))[np.cumsum(cut_a) - cut_a]
    before_a = last_a[np.cumsum(cut_b) - cut_b] if len(last_a) else last_a
    out[np.arange(len(ids_a)) + before_b] = ids_a + cut_a * ids
    out[np.arange(len(ids_b)) + before_a] = ids_b + cut_b * (2 * ids)
    return out


class _Counts:
    """How often a task has linked each pair."""

    def __init__(self):
        self.keys, self.times, self.size = [], [], 0

    def add(self, keys: np.ndarray) -> None:
        distinct, times = np.unique(keys, return_counts=True)
        self.keys.append(distinct)
        self.times.append(times)
        self.size += len(distinct)
        if self.size > _PAIRS_AT and len(self.keys) > 1:
            self.keys, self.times = ([x] for x in self.sums())
            self.size = len(self.keys[0])

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        return keys.astype(np.int64), np.bincount(at, np.concatenate(self.times)).astype(np.int64)


def _key_type(n_a: int, n_b: int) -> str:
    return "<u4" if n_a * n_b <= 1 << 32 else "<u8"


def _aligned(batches, paths: tuple[str, str], schema: pa.Schema, with_groups: bool) -> Iterator[pa.RecordBatch]:
    """A row for each document, and at last a row for each pair with its count."""
    pair = pair_for(*paths)
    n_b = len(pair.bytes_b)
    kind = _key_type(len(pair.bytes_a), n_b)
    counts = _Counts()

    def filled(columns: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    def rows(names: list, texts: list[str]) -> pa.RecordBatch:
        lists_a, lists_b = pair.ids_of(texts)
        ids_a, ids_b = np.concatenate(lists_a), np.concatenate(lists_b)
        n_tokens_a, n_tokens_b = (np.array([len(x) for x in y], np.int64) for y in (lists_a, lists_b))
        del lists_a, lists_b
        ends_a, ends_b = np.cumsum(pair.size_a[ids_a]), np.cumsum(pair.size_b[ids_b])
        cut_a, cut_b = lockstep(ends_a, n_tokens_a[n_tokens_a > 0], ends_b)
        keys = (ids_a[cut_a].astype(np.uint64) * np.uint64(n_b) + ids_b[cut_b]).astype(kind)
        counts.add(keys)
        linked = np.concatenate(([0], np.cumsum(cut_a)))[np.concatenate(([0], np.cumsum(n_tokens_a)))]
        sequence = grouped(ids_a, cut_a, ids_b, cut_b, pair.ids)
        bounds = np.concatenate(([0], np.cumsum(n_tokens_a + n_tokens_b))).tolist()
        spelled = [b"".join(map(pair.signs.__getitem__, sequence[a:b].tolist()))[:-1] for a, b in zip(bounds, bounds[1:])]
        columns = {
            "doc_id": pa.array(names, schema.field("doc_id").type),
            "n_a": pa.array(n_tokens_a),
            "n_b": pa.array(n_tokens_b),
            "n_groups": pa.array(np.diff(linked)),
            "groups_sha256": pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in spelled]),
            "links": pa.array([keys[a:b].tobytes() for a, b in zip(linked, linked[1:])], pa.binary()),
        }
        if with_groups:
            columns["groups"] = pa.array([x.decode() for x in spelled], pa.string())
        return filled(columns, len(names))

    for batch in batches:
        names, held, size = [], [], 0
        for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = text.as_py() or ""
            if held and size + len(text) > CHUNK:
                yield rows(names, held)
                names, held, size = [], [], 0
            names.append(name)
            held.append(text)
            size += len(text)
        if held:
            yield rows(names, held)
    keys, times = counts.sums()
    for at in range(0, len(keys), 100_000):
        mine = keys[at : at + 100_000]
        yield filled({"pair": pa.array(mine), "times": pa.array(times[at : at + 100_000])}, len(mine))


def _weighed(batches, shared, kind: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Documents' rows with what the counts of all pairs say of their links."""
    pairs, times, best = shared.value
    for batch in batches:
        links = batch.column("links").to_pylist()
        flat = np.frombuffer(b"".join(links), kind).astype(np.int64)
        at = np.searchsorted(pairs, flat)
        bounds = np.concatenate(([0], np.cumsum([len(x) // np.dtype(kind).itemsize for x in links])))
        n_best, count_sum = (np.diff(np.concatenate(([0], np.cumsum(x[at], dtype=np.int64)))[bounds]) for x in (best, times))
        own = {"n_links": pa.array(np.diff(bounds)), "n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
        yield pa.RecordBatch.from_arrays([own[f.name] if f.name in own else batch.column(f.name) for f in schema], schema=schema)


def align(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum (long), groups_sha256; with
    ``with_groups`` also groups, as text ``a1,a2|b1;a3|b2,b3`` of ids.

    A: a byte-level tokenizers file, B: a sentencepiece model that puts a blank before a text, both where every executor finds
    them. Special strings in a text are plain text. Both encode a blank and the text; a link is a token of A and one of B that
    end at the same byte, and the tokens up to a link and after the last one are a group. A pair's count is how many links of
    all documents hold it; ``n_best`` counts the links whose pair is its B id's most frequent, ties included, and
    ``count_sum`` adds up the counts of a document's links. Null and empty texts, and those whose tokens do not spell them
    (such as a text that holds U+2581), have no tokens: zeros, and an empty text for a hash. Rows that repeat an id, or all of
    a row, count each. Other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    bytes_a, bytes_b = bytes_of_entries(path_a), bytes_of_pieces(path_b)
    n_b, kind = len(bytes_b), _key_type(len(bytes_a), len(bytes_b))
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    made = T.StructType().add("doc_id", id_type).add("n_a", "long").add("n_b", "long").add("n_groups", "long")
    made.add("groups_sha256", "string")
    last = T.StructType([*made]).add("n_links", "long").add("n_best", "long").add("count_sum", "long")
    if with_groups:
        made.add("groups", "string")
        last.add("groups", "string")
    made.add("links", "binary").add("pair", "long").add("times", "long")
    first_schema, last_schema = to_arrow_schema(made), to_arrow_schema(last)
    paths = path_a, path_b
    aligned = written(rows.mapInArrow(lambda batches: _aligned(batches, paths, first_schema, with_groups), made), "aligned")
    counted = aligned.where(F.col("pair").isNotNull()).groupBy("pair").agg(F.sum("times").alias("times"))
    counted, bound = written(counted, "pairs"), pair_bound(bytes_a, bytes_b)
    # The vocabularies alone decide how many rows there can be.
    if (distinct := counted.count()) > bound:
        raise ArithmeticError(f"{distinct} pairs of tokens end together, where the vocabularies allow {bound}")
    found = counted.toArrow()
    pairs = found.column("pair").to_numpy()
    order = np.argsort(pairs)
    pairs, times = pairs[order], found.column("times").to_numpy()[order]
    highest = np.zeros(n_b, np.int64)
    np.maximum.at(highest, pairs % n_b, times)
    shared = spark.sparkContext.broadcast((pairs, times, times == highest[pairs % n_b]))
    documents = aligned.where(F.col("pair").isNull()).drop("pair", "times")
    return documents.mapInArrow(lambda batches: _weighed(batches, shared, kind, last_schema), last)
