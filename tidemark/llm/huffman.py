"""Token ids in files, as a canonical length-limited Huffman code.

The counts of all ids give one code for the whole corpus. A file's rows are blocks of documents; a document's codes begin at a
byte, and the bit offset of every ``STEP``-th id is kept, so that a block is decoded in many places at once, with a table
that is looked up by the next bits. Blocks stand in the order of ids and need nothing of each other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import col
from tidemark.llm.tokens import encoder_for
from tidemark.session import scratch_dir
from tidemark.sources import files

END = 2
#: The longest code, in bits; the decoding table has two to this many entries. At most 24.
LONGEST = 18
#: Ids between two checkpoints, and ids in a block; a longer document is a block by itself.
STEP, BLOCK = 128, 65_536
#: Bytes of pre-tokens that a task remembers; it holds little else.
REMEMBER = 200_000_000


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """The length of each id's code, 0 for ids that do not occur: the shortest code with no length above ``longest``.

    Package-merge: on each level the cheapest symbols and pairs of the level below are merged; how many of the cheapest are
    taken on a level, from the last to the first, tells how often each symbol is. One symbol alone has a code of one bit.
    """
    symbols = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(symbols) < 2:
        lengths[symbols] = 1
        return lengths
    if len(symbols) > 1 << longest:
        raise ValueError(f"{len(symbols)} ids have no code of {longest} bits")
    symbols = symbols[np.argsort(counts[symbols], kind="stable")]
    weights = counts[symbols].astype(np.float64)
    level, leaves = weights, [np.ones(len(weights), bool)]
    for _ in range(longest - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate((weights, pairs))
        order = np.argsort(merged, kind="stable")
        level = merged[order]
        leaves.append(order < len(weights))
    taken = 2 * len(symbols) - 2
    own = np.zeros(len(symbols), np.int64)
    for is_leaf in reversed(leaves):
        chosen = int(is_leaf[:taken].sum())
        own[:chosen] += 1
        taken = 2 * (taken - chosen)
    lengths[symbols] = own
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The codes that follow from their lengths alone: ascending by length, then by id."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        bits = lengths[order].astype(np.uint64)
        longest = np.uint64(int(bits[-1]))
        shares = np.uint64(1) << (longest - bits)
        codes[order] = (np.cumsum(shares) - shares) >> (longest - bits)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """id * 32 + length for each value of the next bits; and how many bits those are."""
    longest = int(lengths.max(initial=0))
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    own = lengths[order].astype(np.int64)
    table = np.repeat(order.astype(np.int64) * 32 + own, 1 << (longest - own))
    return np.concatenate((table, np.ones((1 << longest) - len(table), np.int64))), longest


def encode(ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Documents' ids, one after the other, as bytes; the bytes of each; the bits between checkpoints, of each in order."""
    bits = lengths[ids].astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(bits)))
    bounds = np.concatenate(([0], np.cumsum(counts)))
    document_bits = ends[bounds[1:]] - ends[bounds[:-1]]
    document_bytes = (document_bits + 7) // 8
    first = (np.cumsum(document_bytes) - document_bytes) * 8
    at = ends[:-1] + np.repeat(first - ends[bounds[:-1]], counts)
    total = int(document_bytes.sum())
    words = np.zeros(total // 8 + 2, np.uint64)
    if len(ids):
        word, shift = at >> 6, at & 63
        room = 64 - shift - bits  # negative where a code goes on in the next word
        values = codes[ids]
        here = np.where(room >= 0, values << np.maximum(room, 0).astype(np.uint64), values >> np.maximum(-room, 0).astype(np.uint64))
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[starts]] = np.add.reduceat(here, starts)
        over = np.flatnonzero(room < 0)
        words[word[over] + 1] |= values[over] << (64 + room[over]).astype(np.uint64)
    payload = words.astype(">u8").tobytes()[:total]
    steps = -(-counts // STEP)
    places = np.arange(int(steps.sum())) - np.repeat(np.cumsum(steps) - steps, steps)
    starts = np.repeat(bounds[:-1], steps) + places * STEP
    stops = np.minimum(starts + STEP, np.repeat(bounds[1:], steps))
    return payload, document_bytes, (ends[stops] - ends[starts]).astype("<u2")


def decode(payload: bytes, counts: np.ndarray, document_bytes: np.ndarray, checkpoints: np.ndarray, table: np.ndarray, longest: int) -> np.ndarray:
    """The ids of all documents of a block, decoded from all checkpoints at once."""
    steps = -(-counts // STEP)
    lanes = int(steps.sum())
    if not lanes:
        return np.empty(0, np.uint32)
    within = np.concatenate(([0], np.cumsum(checkpoints.astype(np.int64))))[:-1]
    firsts = np.cumsum(steps) - steps
    has = steps > 0
    base = np.zeros(len(steps), np.int64)
    base[has] = within[firsts[has]]
    at = within - np.repeat(base, steps) + np.repeat((np.cumsum(document_bytes) - document_bytes) * 8, steps)
    places = np.arange(lanes) - np.repeat(firsts, steps)
    sizes = np.minimum(STEP, np.repeat(counts, steps) - places * STEP)
    order = np.argsort(-sizes, kind="stable")
    at, active = at[order], np.searchsorted(-sizes[order], -np.arange(STEP), side="left")
    raw = np.frombuffer(payload + bytes(4), np.uint8).astype(np.uint32)
    ahead = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    out = np.zeros((STEP, lanes), np.uint32)
    mask = (1 << longest) - 1
    for step in range(STEP):
        n = int(active[step])
        if not n:
            break
        mine = at[:n]
        entry = table[(ahead[mine >> 3].astype(np.int64) >> (32 - longest - (mine & 7))) & mask]
        out[step, :n] = entry >> 5
        mine += entry & 31
    back = np.empty(lanes, np.int64)
    back[order] = np.arange(lanes)
    return out.T[back][np.arange(STEP) < sizes[:, None]]


_BLOCK = "part long, block long, {id} n_ids array<int>, n_bytes array<int>, checkpoints binary, payload binary"


def _tokens(batches: Iterator[pa.RecordBatch], path: str, end: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The ids of each text; and at last, in a row of its own, how often the task has had each id."""
    encoder = encoder_for(path, REMEMBER)
    total, held, size = np.zeros(0, np.int64), [], 0
    for batch in batches:
        packed = []
        for ids in encoder.encode(t.as_py() for t in batch.column("text")):
            ids = np.append(ids, np.uint32(end))
            packed.append(_narrow(ids))
            held.append(ids)
            size += len(ids)
            if size >= 1_000_000:
                total, held, size = _added(total, np.bincount(np.concatenate(held))), [], 0
        columns = [batch.column("doc_id"), pa.array(packed, pa.binary()), pa.nulls(len(batch), pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)
    if held:
        total = _added(total, np.bincount(np.concatenate(held)))
    last = [pa.nulls(1, schema.field("doc_id").type), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())]
    yield pa.RecordBatch.from_arrays(last, schema=schema)


def _added(total: np.ndarray, more: np.ndarray) -> np.ndarray:
    if len(more) > len(total):
        total, more = more, total
    total[: len(more)] += more
    return total


def _narrow(ids: np.ndarray) -> bytes:
    """Two bytes for each id, or, if one needs more, four and a last byte."""
    return ids.astype("<u2").tobytes() if int(ids.max()) < 1 << 16 else ids.astype("<u4").tobytes() + b"\0"


def _wide(packed: memoryview) -> np.ndarray:
    if len(packed) % 2:
        return np.frombuffer(packed[:-1], "<u4")
    return np.frombuffer(packed, "<u2").astype(np.uint32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n) from the counts of tasks."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for counts in batch.column("counts"):
            total = _added(total, np.frombuffer(counts.as_buffer(), np.int64).copy())
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "n"])


def _groups(counts: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of documents with at most ``most`` ids together; a longer one by itself."""
    start = held = 0
    for i, n in enumerate(counts):
        if i > start and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(counts):
        yield start, len(counts)


def _encode(batches: Iterator[pa.RecordBatch], lengths: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per document: its codes and checkpoints."""
    for batch in batches:
        lists = [_wide(p.as_buffer()) for p in batch.column("ids")]
        payloads, marks, counts = [], [], np.array([len(x) for x in lists], np.int64)
        for a, b in _groups(counts.tolist(), BLOCK):
            payload, sizes, checkpoints = encode(np.concatenate(lists[a:b]), counts[a:b], lengths, codes)
            at, mark = 0, 0
            for n, size in zip(counts[a:b].tolist(), sizes.tolist()):
                payloads.append(payload[at : at + size])
                marks.append(checkpoints[mark : mark - (-n // STEP)].tobytes())
                at, mark = at + size, mark - (-n // STEP)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int32()), pa.array(payloads, pa.binary()), pa.array(marks, pa.binary())],
            ["doc_id", "n_ids", "payload", "checkpoints"],
        )


def _blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Documents in their order as blocks; ``part`` and ``block`` say where a block stands."""
    part, block = TaskContext.get().partitionId(), 0
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        names, counts, payloads, marks = zip(*held)
        columns = [[part], [block], [list(names)], [list(counts)], [[len(p) for p in payloads]], [b"".join(marks)], [b"".join(payloads)]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    size = 0
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "n_ids", "payload", "checkpoints"))):
            if held and size + row[1] > BLOCK:
                yield made()
                held, size, block = [], 0, block + 1
            held.append(row)
            size += row[1]
    if held:
        yield made()


def write_ids(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> None:
    """Write the ids of each text, then ``end``, in ascending order of ``id_col``: ``folder``/blocks and ``folder``/code.

    ``path``: a tokenizer file that every executor has. Null and empty texts are the end alone. Null ids come first, and rows
    that share an id stand in the order of their token ids' hash. The ids are written once as they are, with their counts by
    task, and then coded, so a lost executor never has texts tokenized anew; that copy is removed in the end. More than 2^18
    different ids have no code of ``LONGEST`` bits and are refused.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    plain = scratch_dir(spark, "ids")
    made = T.StructType.fromDDL(f"doc_id {kind}, ids binary, counts binary")
    arrow_made = to_arrow_schema(made)
    tokens = rows.mapInArrow(lambda batches: _tokens(batches, path, end, arrow_made), made)
    tokens.write.option("compression", "zstd").parquet(plain)
    back = spark.read.schema(made).parquet(plain)
    tokens = back.where(F.col("ids").isNotNull()).select("doc_id", "ids")
    by_task = back.where(F.col("counts").isNotNull()).select("counts")
    counted = by_task.mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # one row per entry of the vocabulary at most
    counts = np.zeros(int(found["id"].max()) + 1 if len(found) else 1, np.int64)
    counts[found["id"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    lengths = code_lengths(counts)
    code = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(code, "id int, bits int").coalesce(1).write.parquet(f"{folder}/code")
    codes = canonical(lengths)
    # Dealt by range before they are coded: the sample that finds the ranges costs no coding.
    tied = tokens.withColumn("tie", F.xxhash64("ids"))
    placed = tied.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    schema = T.StructType.fromDDL(_BLOCK.format(id=f"doc_id array<{kind}>,"))
    arrow = to_arrow_schema(schema)
    blocks = placed.mapInArrow(lambda batches: _blocks(_encode(batches, lengths, codes), arrow), schema)
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")
    files.delete_folder(spark, plain)


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of little-endian unsigned 32-bit ids) for each
    document of a folder that :func:`write_ids` made; with ``with_ids`` also ids."""
    from pyspark.sql.pandas.types import to_arrow_schema

    code = spark.read.parquet(f"{folder}/code").toPandas()
    lengths = np.zeros(int(code["id"].max()) + 1 if len(code) else 1, np.uint8)
    lengths[code["id"].to_numpy(np.int64)] = code["bits"].to_numpy(np.uint8)
    blocks = spark.read.parquet(f"{folder}/blocks")
    sizes = blocks.select("part", "block", F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    # Offsets first of parts, one row each, then of the blocks in a part.
    parts = sizes.groupBy("part").agg(F.sum("n").alias("total"))
    parts = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("block")) - F.col("n")
    starts = sizes.select("part", "block", inside.alias("inside")).join(parts, "part")
    starts = starts.select("part", "block", (F.col("inside") + F.col("before")).alias("first"))
    element = blocks.schema["doc_id"].dataType.elementType
    made = T.StructType().add("part", "long").add("block", "long").add("doc_id", element).add("inside", "long")
    made.add("n_tokens", "long").add("ids_crc32", "long")
    if with_ids:
        made.add("ids", T.ArrayType(T.LongType()))
    arrow = to_arrow_schema(made)
    decoded = blocks.mapInArrow(lambda batches: _decode(batches, lengths, arrow), made)
    joined = decoded.join(starts, ["part", "block"])
    return joined.select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])
    )


def _decode(batches: Iterator[pa.RecordBatch], lengths: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    table, longest = decoding_table(lengths)
    for batch in batches:
        for row in range(len(batch)):
            one = {n: batch.column(n)[row] for n in batch.schema.names}
            counts = np.array(one["n_ids"].as_py(), np.int64)
            sizes = np.array(one["n_bytes"].as_py(), np.int64)
            checkpoints = np.frombuffer(one["checkpoints"].as_buffer(), "<u2")
            ids = decode(one["payload"].as_py(), counts, sizes, checkpoints, table, longest)
            lists = np.split(ids.astype("<u4"), np.cumsum(counts)[:-1])
            n = len(lists)
            values = [
                [one["part"].as_py()] * n, [one["block"].as_py()] * n, one["doc_id"].as_py(),
                np.cumsum(counts) - counts, counts, [zlib.crc32(x) for x in lists], lists,
            ]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)
