"""Harmonic packing of documents into sequences of a fixed number of tokens.

What is left of a document after its whole sequences belongs to a reciprocal-capacity class: class k holds the lengths in
(capacity / (k + 1), capacity / k], and each bin of class k takes k pieces. A length far below its class's largest is cut at
the next class's largest, which fills a bin exactly, and the rest is classed anew. Each task fills the bins of each class by
itself, so nothing is shuffled; the pieces of the bins that a task could not fill are laid end to end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import col
from tidemark.llm.tokens import encoder_for

CAPACITY, END = 4096, 2
#: Bytes of pre-tokens that a task remembers; it holds pieces of open bins and rows of ids besides.
REMEMBER = 32_000_000
#: A piece is not cut where a bin of its like would be padded by at most this share.
PADDING = 0.02


@dataclass
class Piece:
    doc: int
    start: int
    total: int
    ids: np.ndarray


def classed(length: int, capacity: int = CAPACITY, padding: float = PADDING) -> list[tuple[int, int]]:
    """(length, class) of the pieces into which the end of a document is cut; class k fits k times into a sequence."""
    out = []
    while length:
        k = capacity // length
        if capacity - k * length <= padding * capacity:
            out.append((length, k))
            break
        out.append((capacity // (k + 1), k + 1))
        length -= capacity // (k + 1)
    return out


class Bins:
    """The open bins of one task. ``sequence`` numbers sequences, and no other task uses its numbers."""

    def __init__(self, sequence: int, capacity: int = CAPACITY, padding: float = PADDING):
        self.sequence, self.capacity, self.padding = sequence, capacity, padding
        self.open: dict[int, list[Piece]] = {}
        self.classes: dict[int, list[tuple[int, int]]] = {}

    def _closed(self, pieces: list[Piece]) -> list[tuple[Piece, int, int]]:
        out, offset = [], 0
        for piece in pieces:
            out.append((piece, self.sequence, offset))
            offset += len(piece.ids)
        self.sequence += 1
        return out

    def add(self, doc: int, ids: np.ndarray) -> list[tuple[Piece, int, int]]:
        """Pieces of the bins that this document fills, with their sequence and offset."""
        whole = len(ids) // self.capacity * self.capacity
        out = []
        for at in range(0, whole, self.capacity):
            out += self._closed([Piece(doc, at, len(ids), ids[at : at + self.capacity])])
        rest, at = len(ids) - whole, whole
        if rest not in self.classes:
            self.classes[rest] = classed(rest, self.capacity, self.padding)
        for length, k in self.classes[rest]:
            mine = self.open.setdefault(k, [])
            mine.append(Piece(doc, at, len(ids), ids[at : at + length].copy()))
            at += length
            if len(mine) == k:
                out += self._closed(self.open.pop(k))
        return out

    def end(self) -> list[tuple[Piece, int, int]]:
        """The pieces of open bins end to end in full sequences, cut where one ends. What remains is less than a sequence:
        it fills sequences of powers of two, which need no padding."""
        pieces = [p for k in sorted(self.open) for p in self.open[k]]
        total = sum(len(p.ids) for p in pieces)
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in reversed(range(self.capacity.bit_length())) if total % self.capacity >> b & 1]
        out, at = [], 0
        for size in sizes:
            mine, room = [], size
            while room:
                piece = pieces[at]
                mine.append(Piece(piece.doc, piece.start, piece.total, piece.ids[:room]))
                if len(piece.ids) > room:
                    pieces[at] = Piece(piece.doc, piece.start + room, piece.total, piece.ids[room:])
                else:
                    at += 1
                room -= len(mine[-1].ids)
            out += self._closed(mine)
        self.open = {}
        return out


def _pack(batches, path: str, schema: pa.Schema, end: int, capacity: int, padding: float) -> Iterator[pa.RecordBatch]:
    encoder = encoder_for(path, REMEMBER)
    bins = Bins(TaskContext.get().partitionId() << 36, capacity, padding)
    docs: dict[int, object] = {}  # the ids of documents with pieces in open bins, by their number in this task
    number = 0

    def made(placed: list[tuple[Piece, int, int]]) -> pa.RecordBatch:
        lengths = [len(p.ids) for p, _, _ in placed]
        columns = [
            pa.array([docs[p.doc] for p, _, _ in placed], schema.field("doc_id").type),
            pa.array([p.start for p, _, _ in placed], pa.int64()),
            pa.array(lengths, pa.int64()),
            pa.array([zlib.crc32(p.ids) for p, _, _ in placed], pa.int64()),
            pa.array([p.total for p, _, _ in placed], pa.int64()),
            pa.array([s for _, s, _ in placed], pa.int64()),
            pa.array([o for _, _, o in placed], pa.int64()),
        ]
        if len(schema) > len(columns):
            flat = np.concatenate([p.ids for p, _, _ in placed]).astype(np.int32)
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for batch in batches:
        names, placed, size = batch.column("doc_id").to_pylist(), [], 0
        for name, ids in zip(names, encoder.encode(t.as_py() for t in batch.column("text"))):
            docs[number] = name
            placed += bins.add(number, np.append(ids, np.uint32(end)).astype("<u4"))
            number += 1
            size += len(ids)
            if size > 1_000_000:
                if placed:
                    yield made(placed)
                placed, size = [], 0
        if placed:
            yield made(placed)
        docs = {p.doc: docs[p.doc] for mine in bins.open.values() for p in mine}
    if placed := bins.end():
        yield made(placed)


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END,
    capacity: int = CAPACITY, padding: float = PADDING, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start (in its document's ids), length, ids_crc32 (of little-endian unsigned 32-bit ids),
    doc_tokens, sequence_id, offset (in its sequence); with ``with_ids`` also ids.

    A document is the ids of its text by the tokenizer in ``path``, which every executor has, without added special tokens,
    then ``end``; null and empty texts are the end alone. Repeated rows are packed each. Sequences hold ``capacity`` ids, a
    power of two, less a padding of ``padding`` of it at most, or, at a task's end, a smaller power of two.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if capacity & (capacity - 1):
        raise ValueError("the capacity has to be a power of two")
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    made = T.StructType().add("doc_id", rows.schema["doc_id"].dataType)
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"):
        made.add(name, "long")
    if with_ids:
        made.add("ids", T.ArrayType(T.IntegerType()))
    arrow = to_arrow_schema(made)
    return rows.mapInArrow(lambda batches: _pack(batches, path, arrow, end, capacity, padding), made)
