"""SimHash near-dedup by deletion variants.

A text's fingerprint has 64 bits, each the majority of that bit over the hashes of its word shingles. Fingerprints within
four bits of each other are links, and links make groups.

The bits are cut into three segments: of four differing bits, one segment has one at most. So two linked fingerprints agree
on some segment with some one bit left out, and each fingerprint is indexed under its 64 such variants. Fingerprints with an
equal key are compared. A key with very many fingerprints is cut further in the same way, by the bits in which its fingerprints
differ at all, and again, until it is small or so few bits differ that it cannot hold many.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col, free_name
from tidemark.llm.components import components
from tidemark.session import written

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Fingerprints under one key that are compared at once; more are cut further, by the bits that their key leaves open.
DIRECT = 32_768
#: A key whose fingerprints differ in at most so many bits holds two to this many at most; those are compared as they are.
FEW_BITS = 14

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Null and blank texts have the fingerprint 0; a text shorter than a shingle is one shingle."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - width] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]
    return majority(np.array(hashes, dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], dtype=np.uint64)
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(prints.view(np.int64))], [*names, "bits"])


def _row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits of hash over a row's id and text, in two columns."""
    return [F.xxhash64(col(id_col), col(text_col)), F.xxhash64(F.lit(1), col(id_col), col(text_col))]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, k1 and k2 (a hash of id and text), bits (the fingerprint as a signed long) for every row."""
    k1, k2 = _row_key(id_col, text_col)
    rows = docs.select(col(id_col).alias("doc_id"), k1.alias("k1"), k2.alias("k2"), col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        lambda batches: _fingerprints(batches, shingle), f"doc_id {kind}, k1 long, k2 long, bits long"
    )


def _segments(bits: list[int]) -> list[list[int]]:
    """The places cut into three runs of nearly equal length."""
    third, more = divmod(len(bits), 3)
    ends = [0]
    for i in range(3):
        ends.append(ends[-1] + third + (i < more))
    return [bits[a:b] for a, b in zip(ends, ends[1:])]


def _variants(bits: list[int]) -> list[tuple[int, list[int]]]:
    """(wildcard's place, the places that the key holds) for each variant of these places."""
    return [(wild, [b for b in segment if b != wild]) for segment in _segments(bits) for wild in segment]


def _mask(places: list[int]) -> int:
    value = sum(1 << p for p in places)
    return value - (1 << 64) if value >= 1 << 63 else value


def _keyed(prints: DataFrame) -> DataFrame:
    """One row per fingerprint and variant: variant (a number for its wildcard), held (the bits that the key holds), bits."""
    keys = [
        F.struct(
            F.lit(wild).cast("long").alias("variant"), F.col("bits").bitwiseAND(F.lit(_mask(held))).alias("held")
        )
        for wild, held in _variants(list(range(64)))
    ]
    return prints.select("bits", F.explode(F.array(*keys)).alias("k")).select("k.variant", "k.held", "bits")


def _near(some: np.ndarray, others: np.ndarray, max_bits: int) -> np.ndarray:
    """Which fingerprints, given as signed numbers, differ in few bits."""
    # Signed numbers would have the bits of their absolute values counted.
    return np.bitwise_count((some ^ others).view(np.uint64)) <= max_bits


def _forest(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join what is linked: a fingerprint is reached once, from the first that finds it."""
    left, found = prints[1:], []
    queue = [prints[0]] if len(prints) else []
    while queue or len(left):
        if not queue:
            queue, left = [left[0]], left[1:]
        one = queue.pop()
        near = _near(left, one, max_bits)
        if near.any():
            reached = left[near]
            found += [(int(one), int(x)) for x in reached]
            queue += list(reached)
            left = left[~near]
    return found


#: What :func:`_compare` returns: links (a, b), and rows under crowded keys (variant, held, a).
_COMPARED = "variant long, held long, a long, b long"
_NAMES = ["variant", "held", "a", "b"]


def _links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([none, none, pa.array(a, pa.int64()), pa.array(b, pa.int64())], _NAMES)


def _crowded(key: tuple[int, int], prints: np.ndarray) -> pa.RecordBatch:
    n = len(prints)
    columns = [pa.array(np.full(n, k, np.int64)) for k in key]
    return pa.RecordBatch.from_arrays([*columns, pa.array(prints, pa.int64()), pa.nulls(n, pa.int64())], _NAMES)


class _Run:
    """The fingerprints of one key, over as many batches as they fill; over ``direct`` of them pass through."""

    def __init__(self, key: tuple[int, int], max_bits: int, direct: int | None):
        self.key, self.max_bits, self.direct = key, max_bits, direct
        self.kept: list[np.ndarray] = []
        self.count = 0

    def add(self, prints: np.ndarray) -> list[pa.RecordBatch]:
        self.count += len(prints)
        self.kept.append(prints)
        if self.direct is None or self.count <= self.direct:
            return []
        out, self.kept = [_crowded(self.key, np.concatenate(self.kept))], []
        return out

    def end(self) -> list[pa.RecordBatch]:
        if not self.kept or self.count < 2:
            return []
        pairs = np.array(_forest(np.unique(np.concatenate(self.kept)), self.max_bits), dtype=np.int64).reshape(-1, 2)
        return [_links(pairs[:, 0], pairs[:, 1])] if len(pairs) else []


def _compare(batches: Iterator[pa.RecordBatch], max_bits: int, direct: int | None) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key become links, or, where a key has over ``direct`` fingerprints, rows to be cut further.

    Holds the fingerprints of one key, ``direct`` at most, and one batch.
    """
    run = None
    for batch in batches:
        if not len(batch):
            continue
        variant, held, bits = (batch.column(n).to_numpy() for n in ("variant", "held", "bits"))
        change = np.flatnonzero((held[1:] != held[:-1]) | (variant[1:] != variant[:-1])) + 1
        starts, ends = np.r_[0, change], np.r_[change, len(bits)]
        inner = np.ones(len(starts), bool)
        inner[[0, -1]] = False  # the first and the last key may go on in other batches
        two = starts[inner & (ends - starts == 2)]
        near = two[_near(bits[two], bits[two + 1], max_bits)]
        if len(near):
            yield _links(bits[near], bits[near + 1])
        for i in np.flatnonzero(~inner | (ends - starts > 2)).tolist():
            a, b = int(starts[i]), int(ends[i])
            key = int(variant[a]), int(held[a])
            if run is None or run.key != key:
                yield from run.end() if run else []
                run = _Run(key, max_bits, direct)
            yield from run.add(bits[a:b])
    yield from run.end() if run else []


def _recut(crowded: DataFrame) -> DataFrame:
    """The variants of the places in which a key's fingerprints differ. ``crowded``: variant, held, a, differ (a mask)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            variant, held, bits, differ = (batch.column(n).to_numpy() for n in ("variant", "held", "a", "differ"))
            for mask in np.unique(differ).tolist():
                mine = differ == mask
                for wild, places in _variants([p for p in range(64) if mask >> p & 1]):
                    # A number for the key that was cut and the wildcard; those that are equal by chance are compared in vain.
                    own = (variant[mine] * 0x2545F491 + held[mine]) * 0x5851F42D + wild + 1
                    kept = bits[mine] & np.int64(_mask(places))
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(kept), pa.array(bits[mine])], ["variant", "held", "bits"])

    return crowded.mapInArrow(cut, "variant long, held long, bits long")


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, direct: int = DIRECT) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``bits``): all pairs within ``max_bits`` bits are connected by
    them, though not each has a link of its own.

    Exact for ``max_bits`` up to 5. A key that holds more than ``direct`` fingerprints is cut by the bits in which they differ,
    which takes a third of these bits away on each level, until it holds no more or differs in ``FEW_BITS`` at most.
    """
    if not 0 <= max_bits <= 5:
        raise ValueError("three segments with one wildcard find up to 5 differing bits")

    def compared(keyed: DataFrame, limit: int | None) -> DataFrame:
        by_key = keyed.repartition("variant", "held").sortWithinPartitions("variant", "held")
        return written(by_key.mapInArrow(lambda batches: _compare(batches, max_bits, limit), _COMPARED), "simhash")

    keyed, links = _keyed(prints), []
    while keyed is not None:
        found = compared(keyed, direct)
        links.append(found.where(F.col("b").isNotNull()).select("a", "b"))
        crowded, keyed = found.where(F.col("b").isNull()).drop("b"), None
        if crowded.isEmpty():
            break
        differ = F.bit_or("a").bitwiseXOR(F.bit_and("a")).alias("differ")
        crowded = written(crowded.join(crowded.groupBy("variant", "held").agg(differ), ["variant", "held"]), "crowded")
        few = crowded.where(F.bit_count("differ") <= FEW_BITS)
        if not few.isEmpty():
            links.append(compared(few.select("variant", "held", F.col("a").alias("bits")), None).select("a", "b"))
        many = crowded.where(F.bit_count("differ") > FEW_BITS)
        keyed = None if many.isEmpty() else _recut(many)
    return reduce(DataFrame.unionAll, links).distinct()


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """doc_id, k1, k2, bits, component_id for every row; component_id is the smallest doc_id that links lead to.

    Rows without text are linked like any others, by the fingerprint 0. Rows that share an id count each with its own text.
    A null id is a component_id only where a group has no other.
    """
    prints = written(fingerprints(docs, id_col, text_col, shingle), "prints")
    classes = prints.groupBy("bits").agg(F.min("doc_id").alias("first"))
    roots = components(near_links(classes.select("bits"), max_bits))
    return prints.join(_named(classes, roots), "bits")


def _named(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """bits, component_id, root of each class of equal fingerprints (bits, first). A root that very many classes share is a hot
    key of the last join, whose sides AQE splits."""
    rooted = classes.join(roots, F.col("bits") == F.col("node"), "left").select(
        "bits", "first", F.coalesce("root", "bits").alias("root")
    )
    # Grouped by a hash besides the root, so that the join reads both sides from exchanges of its own: only such are split.
    groups = rooted.groupBy("root", F.xxhash64("root").alias("h")).agg(F.min("first").alias("component_id")).drop("h")
    return rooted.join(groups, "root").select("bits", "component_id", "root")


def hex_fingerprint(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group, with its own columns: the one with the smallest id.

    Of several such rows with different texts any one stays, the same on each run; of rows with equal id and text one stays.
    A row without an id stays only where its group has no other.
    """
    groups = near_groups(docs, id_col, text_col, **options)
    smallest = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2"))
    keepers = groups.groupBy("root").agg(smallest.alias("row"))
    k1, k2 = free_name(docs, "simhash_k1"), free_name(docs, "simhash_k2")
    keepers = keepers.select(F.col("row.k1").alias(k1), F.col("row.k2").alias(k2))
    # Equal rows are dropped before the shuffle, which the join then uses too.
    single = docs.withColumns(dict(zip((k1, k2), _row_key(id_col, text_col)))).dropDuplicates([k1, k2])
    return single.join(keepers, [k1, k2], "left_semi").select(*[col(c) for c in docs.columns])
