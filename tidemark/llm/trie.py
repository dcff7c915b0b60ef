"""The trie of all conversations' beginnings, by van Emde Boas recursion.

Conversations are cut at half their depth, the halves again, and so on. The name of a beginning that ends at a cut is a hash of
the name of the beginning up to the segment's start and of the segment's own name; so first the names of segments are
built from those of their halves, and then, from the deepest cut to the shallowest, the names of beginnings. A round handles
the cuts of one size in all conversations at once, and rounds halve or double the size: the rows of all rounds together
are about twice the turns, however long a conversation is.

Distinct names are nodes. Totals of subtrees are built in the upper trie and the lower forests of all cuts of one size at
once, and then each lower tree's total is grafted onto its ancestors in the upper trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import col
from tidemark.session import written

#: Turns of the conversation that another one may begin with, and how many neighbours share one beginning.
HEADS, FAMILY = 9, 5
#: Characters of ids that are joined at once.
_JOINED = 1 << 20

_NAME = ["k1", "k2"]


def named(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, turn, role, digest (MD5 of the text), n_bytes (UTF-8). Null roles and texts are empty; rows without a
    conversation are left out."""
    kind = conversations.schema[conv_col].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError("ids of conversations have to be whole numbers")
    text = F.coalesce(col(text_col), F.lit(""))
    return conversations.where(col(conv_col).isNotNull()).select(
        col(conv_col).cast("long").alias("conv_id"),
        col(turn_col).alias("turn"),
        F.coalesce(col(role_col), F.lit("")).alias("role"),
        F.md5(text.cast("binary")).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, with the task's number and their place among the conversation's rows in this task."""
    part, last, carried = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        key = batch.column("conv_id").to_numpy()
        starts = np.flatnonzero(np.diff(key, prepend=key[0])) if n > 1 else np.empty(0, np.int64)
        starts = np.concatenate(([0], starts))
        counts = np.diff(np.append(starts, n))
        at = np.arange(n) - np.repeat(starts, counts) + 1
        if key[0] == last:
            at[: counts[0]] += carried
        last, carried = key[-1], int(at[-1])
        added = [pa.array(np.full(n, part, np.int32)), pa.array(at)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "part", "at"])


def numbered(turns: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The turns with their place, from 1, among their conversation's, also when that fills many tasks.

    Rows are sorted over all tasks by ranges of conversation and order; a task counts those it has, and begins where the
    task before it ended. Equal rows are interchangeable, and may be in different tasks.
    """
    tie = F.col("tie")
    rows = turns.withColumn("tie", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange("conv_id", *order, tie).sortWithinPartitions("conv_id", *order, tie).drop("tie")
    made = T.StructType([*turns.schema, *T.StructType.fromDDL("part int, at long")])
    counted = written(ranged.mapInArrow(_counted, made), "numbered")
    # One row for each task; a conversation that goes on in the next one is the task's last, and the next one's first.
    ends = counted.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "at")).alias("last"))
    by_last = Window.partitionBy("last.conv_id").orderBy("part")
    ends = ends.withColumn("upto", F.sum("last.at").over(by_last))
    before = F.lag(F.struct(F.col("last.conv_id").alias("conv_id"), "upto")).over(Window.orderBy("part"))
    goes_on = ends.withColumn("before", before).where(F.col("before.conv_id") == F.col("first"))
    shifts = goes_on.select("part", F.col("first").alias("conv_id"), F.col("before.upto").alias("shift"))
    joined = counted.join(F.broadcast(shifts), ["part", "conv_id"], "left")
    place = F.col("at") + F.coalesce("shift", F.lit(0))
    return joined.select(*turns.columns, place.alias(name))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations that share beginnings: conv_id, step, place, role, digest, n_bytes, in the order of step and place.

    Conversation c begins with the first h turns of conversation c - c % 5, h being crc32(c as text) % 9, and goes on with its
    own turns after its first h. ``turns``: what :func:`named` gives. A conversation's turns are in the order of ``turn``,
    null first; those of equal turn by role, then by digest.
    """
    placed = numbered(turns, [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")], "place")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    kept = ["place", "role", "digest", "n_bytes"]
    own = placed.where(F.col("place") > head).select("conv_id", F.lit(1).alias("step"), *kept)
    family = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    ids = turns.select("conv_id").distinct().select("conv_id", family.alias("source"), head.alias("head"))
    heads = placed.where((F.col("place") < HEADS) & (F.pmod("conv_id", F.lit(FAMILY)) == 0))
    heads = heads.withColumnRenamed("conv_id", "source")
    begun = ids.join(heads, "source").where(F.col("place") <= F.col("head"))
    return begun.select("conv_id", F.lit(0).alias("step"), *kept).unionAll(own)


def _hash(*parts: Column) -> list[Column]:
    """Two numbers that name what the parts name."""
    return [F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit(1), *parts).alias("k2")]


def _root() -> list[Column]:
    return [F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2")]


def _segments(turns: DataFrame, sizes: list[int]) -> dict[int, DataFrame]:
    """For each size, the whole segments of so many turns: conv_id, depth (of the last turn), k1, k2, n_bytes (of it)."""
    found = {1: turns}
    for size in sizes[:-1]:
        halves = found[size].groupBy("conv_id", F.expr(f"(depth - 1) div {2 * size}").alias("block")).agg(
            F.count(F.lit(1)).alias("n"),
            F.min_by(F.struct(*_NAME), "depth").alias("a"),
            F.max_by(F.struct(*_NAME, "depth", "n_bytes"), "depth").alias("b"),
        )
        names = _hash(F.col("a.k1"), F.col("a.k2"), F.col("b.k1"), F.col("b.k2"))
        # The last segment may lack its second half.
        whole = halves.where(F.col("n") == 2).select("conv_id", "b.depth", *names, "b.n_bytes")
        found[2 * size] = written(whole, "segments")
    return found


def _prefixes(ids: DataFrame, turns: DataFrame, sizes: list[int]) -> DataFrame:
    """conv_id, depth, k1, k2 (the name of the first ``depth`` turns), n_bytes (of the last), for each depth from 0 on."""
    segments = _segments(turns, sizes)
    columns = ["conv_id", "depth", *_NAME, "n_bytes"]
    known = ids.select("conv_id", F.lit(0).cast("long").alias("depth"), *_root(), F.lit(0).cast("long").alias("n_bytes"))
    for size in reversed(sizes):
        # The cuts of this size are the odd multiples; what is before each of them is known.
        mine = segments[size].where(F.expr(f"depth div {size} % 2 = 1"))
        before = known.select(
            "conv_id", (F.col("depth") + size).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2")
        )
        cut = mine.join(before, ["conv_id", "depth"])
        name = _hash(F.col("p1"), F.col("p2"), F.col("k1"), F.col("k2"))
        known = known.unionAll(written(cut.select("conv_id", "depth", *name, "n_bytes"), "prefixes").select(columns))
    return known


def _grafted(totals: DataFrame, prefixes: DataFrame, sizes: list[int]) -> DataFrame:
    """Totals of single nodes become totals of subtrees. A round adds each total at a cut to its ancestors between the cut
    and the one before it, which lie on the way of the node's own conversation."""
    for size in sizes:
        block = F.expr(f"depth div {2 * size}").alias("block")
        cuts = totals.where(F.expr(f"depth % {2 * size} = {size}")).select("conv_id", block, "n_leaves", "saved_tokens")
        upper = prefixes.where(F.expr(f"depth % {2 * size} < {size}")).select("conv_id", block, *_NAME)
        added = cuts.join(upper, ["conv_id", "block"]).groupBy(*_NAME).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
        )
        more = {"n_leaves": "more_leaves", "saved_tokens": "more_saved"}
        sums = {k: F.col(k) + F.coalesce(v, F.lit(0)) for k, v in more.items()}
        totals = written(totals.join(added, _NAME, "left").withColumns(sums).drop(*more.values()), "totals")
    return totals


def _joined(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows sorted by name and conversation: the ids of each name joined by commas, in rows of bounded length."""
    held, size, key = [], 0, None

    def row() -> Iterator[pa.RecordBatch]:
        if held:
            columns = [[key[0]], [key[1]], [held[0]], [",".join(map(str, held))]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        for k1, k2, conv in zip(*(batch.column(n).to_pylist() for n in (*_NAME, "conv_id"))):
            if (k1, k2) != key or size > _JOINED:
                yield from row()
                held, size, key = [], 0, (k1, k2)
            held.append(conv)
            size += 20
    yield from row()


def _digested(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows sorted by name and first id: one digest for each name, over its rows in order."""
    key, digest, done = None, None, []

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    for batch in batches:
        for k1, k2, text in zip(*(batch.column(n).to_pylist() for n in (*_NAME, "ids"))):
            if (k1, k2) != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (k1, k2), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
        if len(done) > 10_000:
            yield rows()
            done = []
    if key is not None:
        done.append((*key, digest.hexdigest()))
        yield rows()


def _ends(prefixes: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256 for each node at which any conversation ends."""
    from pyspark.sql.pandas.types import to_arrow_schema

    lengths = prefixes.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    ends = prefixes.join(lengths, ["conv_id", "depth"]).select(*_NAME, "conv_id")
    joined = T.StructType.fromDDL("k1 long, k2 long, conv_id long, ids string")
    made = T.StructType.fromDDL("k1 long, k2 long, ends_sha256 string")
    joined_arrow, made_arrow = to_arrow_schema(joined), to_arrow_schema(made)
    # A name with very many ids fills several tasks, and comes together again as a few long texts.
    ranged = ends.repartitionByRange(*_NAME, "conv_id").sortWithinPartitions(*_NAME, "conv_id")
    texts = ranged.mapInArrow(lambda batches: _joined(batches, joined_arrow), joined)
    by_name = texts.repartition(*_NAME).sortWithinPartitions(*_NAME, "conv_id")
    return by_name.mapInArrow(lambda batches: _digested(batches, made_arrow), made)


def prefix_trie(turns: DataFrame, order: list[Column], ids: DataFrame | None = None) -> DataFrame:
    """One row per node, that is per distinct beginning of conversations, the empty one included.

    ``turns``: conv_id (long), role, digest and n_bytes of the text, and what ``order`` sorts by. ``ids`` (conv_id): all
    conversations, for those without turns; each id once. Equal turns have equal role and digest. Returns conv_id (the
    smallest that begins so), depth, parent_conv_id, n_convs, n_children, n_leaves (nodes without children in the subtree),
    saved_tokens (over the subtree, all but one of a node's conversations times the bytes of its last text), all long, and
    ends_sha256 (of the ids of conversations that end here, ascending, joined by commas). Without conversations: no rows.
    """
    name = _hash(F.col("role"), F.col("digest"))
    placed = numbered(turns, order, "depth").select("conv_id", "depth", *name, "n_bytes")
    placed = written(placed, "turns")
    ids = placed.select("conv_id").distinct() if ids is None else ids
    deepest = placed.agg(F.max("depth")).first()[0] or 0
    sizes = [1 << i for i in range(max(1, deepest.bit_length()))]
    prefixes = _prefixes(ids, placed, sizes)
    nodes = prefixes.groupBy(*_NAME, "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes")
    )
    nodes = written(nodes, "nodes")
    above = prefixes.select(
        "conv_id", (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2")
    )
    nodes = written(nodes.join(above, ["conv_id", "depth"], "left"), "parents")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    single = nodes.join(children, _NAME, "left").select(
        *_NAME, "p1", "p2", "conv_id", "depth", "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    totals = _grafted(written(single, "single"), prefixes, sizes)
    # The root has by far the most children; its smallest conversation is one number.
    first = totals.where("depth = 0").agg(F.min("conv_id")).first()[0]
    parents = totals.where("depth > 0").select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    deep = totals.where("depth > 1").join(parents, ["p1", "p2"])
    shallow = totals.where("depth < 2").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(first).cast("long")))
    found = deep.unionByName(shallow).join(_ends(prefixes), _NAME, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The trie of conversations as they stand, see :func:`prefix_trie`; turns in the order of :func:`rebuilt`.

    Rows without a conversation are left out, null roles and texts are empty, repeated rows are turns of their own, and other
    columns are not read.
    """
    turns = written(named(conversations, conv_col, turn_col, role_col, text_col), "named")
    return prefix_trie(turns, [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")])


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations after :func:`rebuilt`, those that have no turn left included."""
    turns = written(named(conversations), "named")
    ids = written(turns.select("conv_id").distinct(), "ids")
    return prefix_trie(written(rebuilt(turns), "rebuilt"), [F.col("step"), F.col("place")], ids)
