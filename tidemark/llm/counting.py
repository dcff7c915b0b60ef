"""Token counts without token ids.

Each document's pre-tokens are counted; each distinct pre-token is cut into pieces once, where its frequencies in documents
are joined to the number of its pieces, and the products are summed by document. Pre-tokens that are entries of the vocabulary
need no join: they are one piece each, and the vocabulary's size is fixed. What is shuffled is one row per pre-token and block
of documents, and then one row per block of the sums that a task has.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import col
from tidemark.llm.tokens import Encoder, HashClash, chunks, encoder_for

#: Documents and characters of a block.
BLOCK_DOCS, BLOCK_CHARS = 60_000, 32_000_000
#: A pre-token in more than this share of a block's documents is frequent: its rows are dealt to so many tasks, each of which
#: counts its pieces.
FREQUENT, SALTS = 0.1, 256
#: Entries of postings whose products a task sums before it passes them on.
_SUM_AT = 4_000_000

#: An entry of postings: a document's place in its block, and how often; over 255 times takes several entries.
_ENTRY = np.dtype([("place", "<u2"), ("often", "u1")])
#: An entry of sums: a document's place, and its tokens; large sums take several entries.
_SUM = np.dtype([("place", "<u2"), ("n", "<u2")])


def _entries(places: np.ndarray, amounts: np.ndarray, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Places with amounts as entries, and how many entries each takes."""
    field = dtype.names[1]
    most = np.iinfo(dtype[field]).max
    times = np.maximum(1, -(-amounts // most))
    out = np.empty(int(times.sum()), dtype)
    out["place"] = np.repeat(places, times)
    out[field] = most
    out[field][np.cumsum(times) - 1] = amounts - most * (times - 1)
    return out, times


def _binary(entries: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Runs of entries as binary values, without a copy of each."""
    offsets = np.append(starts, len(entries)).astype(np.int64) * entries.dtype.itemsize
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(entries.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(starts), buffers)


def _salt(block: int) -> int:
    return ((block >> 32) + block) % SALTS


class _Block:
    """The pre-tokens of some documents, and which documents hold each how often."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.slots: dict[str, int] = {}
        self.which: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.often: list[np.ndarray] = []
        self.ready: list[np.ndarray] = []
        self.docs = self.chars = 0

    def add(self, plain: bool, texts: list[str]) -> None:
        encoder, n = self.encoder, len(texts)
        try:
            split = encoder.split(texts) if plain else None
        except HashClash:
            split = None
        if split is not None:
            distinct = split.strings()
            pairs, often = np.unique(split.which * n + np.repeat(np.arange(n), split.per_text), return_counts=True)
        else:
            found: dict[int, int] = {}
            own: dict[str, int] = {}
            for i, text in enumerate(texts):
                for piece, times in Counter(encoder.pretokens(text)).items():
                    found[own.setdefault(piece, len(own)) * n + i] = times
            pairs = np.array(sorted(found), dtype=np.int64)
            often = np.array([found[p] for p in pairs.tolist()], dtype=np.int64)
            distinct = list(own)
        which, places = pairs // n, pairs % n
        single = encoder.single
        known = np.fromiter((p in single for p in distinct), bool, len(distinct))[which]
        self.ready.append(np.bincount(places[known], often[known], n).astype(np.int64))
        slots = self.slots
        at = np.fromiter((-1 if p in single else slots.setdefault(p, len(slots)) for p in distinct), np.int64, len(distinct))
        self.which.append(at[which[~known]])
        self.places.append(places[~known] + self.docs)
        self.often.append(often[~known])
        self.docs += n
        self.chars += sum(map(len, texts))

    def rows(self, block: int) -> pa.Table:
        """pretoken, salt, block, postings."""
        which = np.concatenate(self.which)
        order = np.argsort(which, kind="stable")
        which = which[order]
        starts = np.flatnonzero(np.diff(which, prepend=-1))
        holders = np.diff(np.append(starts, len(which)))
        entries, times = _entries(np.concatenate(self.places)[order], np.concatenate(self.often)[order], _ENTRY)
        firsts = np.concatenate(([0], np.cumsum(times)))[starts]
        salts = np.where(holders > FREQUENT * self.docs, _salt(block), 0)
        names = pa.array(list(self.slots), pa.string()).take(pa.array(which[starts]))
        n = len(starts)
        columns = [names, pa.array(salts, pa.int32()), pa.array(np.full(n, block, np.int64)), _binary(entries, firsts)]
        return pa.RecordBatch.from_arrays(columns, ["pretoken", "salt", "block", "payload"])


def _frequencies(batches: Iterator[pa.RecordBatch], path: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of pre-tokens with postings, and, without pre-token, of documents: doc_id, n_bytes, and n of what is known."""
    encoder = encoder_for(path)
    number, block = TaskContext.get().partitionId() << 32, _Block(encoder)

    def filled(columns: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    def rows() -> Iterator[pa.RecordBatch]:
        made = block.rows(number)
        yield filled(dict(zip(made.schema.names, made.columns)), len(made))

    for batch in batches:
        texts = batch.column("text").to_pylist()
        sizes = pa.array([len((t or "").encode("utf-8")) for t in texts], pa.int64())
        start = 0
        for plain, group in chunks(encoder, texts):
            n = len(group)
            if block.docs and (block.docs + n > BLOCK_DOCS or block.chars > BLOCK_CHARS):
                yield from rows()
                number, block = number + 1, _Block(encoder)
            first = block.docs
            block.add(plain, group)
            columns = {
                "salt": pa.array(np.full(n, _salt(number), np.int32)),
                "block": pa.array(np.full(n, number, np.int64)),
                "place": pa.array(np.arange(first, first + n, dtype=np.int32)),
                "doc_id": batch.column("doc_id").slice(start, n),
                "n_bytes": sizes.slice(start, n),
                "n": pa.array(block.ready[-1]),
            }
            yield filled(columns, n)
            start += n
    if block.docs:
        yield from rows()


def _products(batches: Iterator[pa.RecordBatch], path: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows sorted by pre-token become rows of sums by block. Documents' own rows pass through."""
    encoder = encoder_for(path)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size, last, pieces_of_last = 0, None, 0

    def sums() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        blocks, places, counts = (np.concatenate(x) for x in zip(*held))
        own, which = np.unique(blocks, return_inverse=True)
        keys, at = np.unique(which << 16 | places, return_inverse=True)
        entries, times = _entries(keys & 0xFFFF, np.bincount(at, counts).astype(np.int64), _SUM)
        starts = np.flatnonzero(np.diff(keys >> 16, prepend=-1))
        firsts = np.concatenate(([0], np.cumsum(times)))[starts]
        columns = {"block": pa.array(own[keys[starts] >> 16]), "payload": _binary(entries, firsts)}
        yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(starts), f.type)) for f in schema], schema=schema)

    for batch in batches:
        documents = batch.column("payload").is_null()
        yield batch.filter(documents).select(schema.names).cast(schema)
        rest = batch.filter(pa.compute.invert(documents))
        if not len(rest):
            continue
        names = rest.column("pretoken").dictionary_encode()
        distinct = names.dictionary.to_pylist()
        new = [p for p in distinct if p != last]
        count = dict(zip(new, encoder.lengths_of(new)))
        if last is not None:
            count[last] = pieces_of_last
        pieces = np.array([count[p] for p in distinct], np.int64)[names.indices.to_numpy()]
        last = distinct[int(names.indices[-1].as_py())]
        pieces_of_last = count[last]
        payload = rest.column("payload")
        offsets = np.frombuffer(payload.buffers()[1], np.int32, len(payload) + 1, payload.offset * 4)
        entries = np.frombuffer(payload.buffers()[2], _ENTRY, (offsets[-1] - offsets[0]) // 3, int(offsets[0]))
        times = np.diff(offsets) // 3
        blocks = np.repeat(rest.column("block").to_numpy(), times)
        held.append((blocks, entries["place"].astype(np.int64), entries["often"] * np.repeat(pieces, times)))
        size += len(entries)
        if size >= _SUM_AT:
            yield from sums()
            held, size = [], 0
    yield from sums()


def _totals(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, documents' own rows first, become documents. Holds one block."""
    block, docs, total = None, [], np.zeros(0, np.int64)

    def done() -> Iterator[pa.RecordBatch]:
        if docs:
            own = pa.Table.from_batches(docs)
            tokens = pa.array(own.column("n").to_numpy() + total[own.column("place").to_numpy()])
            for piece in pa.table([own.column("doc_id"), own.column("n_bytes"), tokens], schema=schema).to_batches():
                yield piece

    for batch in batches:
        numbers = batch.column("block").to_numpy()
        starts = np.flatnonzero(np.diff(numbers, prepend=numbers[0] - 1)) if len(numbers) else []
        for a, b in zip(starts, np.append(starts[1:], len(numbers)) if len(numbers) else []):
            if numbers[a] != block:
                yield from done()
                block, docs, total = numbers[a], [], np.zeros(1 << 16, np.int64)
            mine = batch.slice(a, b - a)
            whole = mine.column("payload").is_null()
            own = mine.filter(whole)
            if len(own):
                docs.append(own)
            for payload in mine.filter(pa.compute.invert(whole)).column("payload"):
                entries = np.frombuffer(payload.as_buffer(), _SUM)
                np.add.at(total, entries["place"], entries["n"].astype(np.int64))
    yield from done()


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (of UTF-8), n_tokens (long) for every row, for a byte-level vocabulary that keeps white space.

    ``path``: a tokenizer file that every executor has. Null and empty texts have no tokens. Rows that repeat an id are each
    counted with their own text. Special strings inside a text are their own id, as is the library's default.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    own = T.StructType.fromDDL("block long, payload binary, place int").add("doc_id", id_type)
    own.add("n_bytes", "long").add("n", "long")
    dealt = T.StructType([*T.StructType.fromDDL("pretoken string, salt int"), *own])
    counted = T.StructType().add("doc_id", id_type).add("n_bytes", "long").add("n_tokens", "long")
    one, two, three = map(to_arrow_schema, (dealt, own, counted))
    frequencies = rows.mapInArrow(lambda batches: _frequencies(batches, path, one), dealt)
    by_pretoken = frequencies.repartition("pretoken", "salt").sortWithinPartitions("pretoken")
    products = by_pretoken.mapInArrow(lambda batches: _products(batches, path, two), own)
    by_block = products.repartition("block").sortWithinPartitions("block")
    return by_block.mapInArrow(lambda batches: _totals(batches, three), counted)
