"""Substring dedup by recompression.

Words are symbols. A level of recompression replaces each run of a symbol by one, and then each pair of a left and a right
symbol by one; which symbols are left ones, and the name of a run or pair, are hashes of what it stands for, so every task of
every round gives equal words equal names without a common dictionary. Equal passages have the same symbols inside, whatever
stands around them: from a window, each level takes away only what the window's ends may have changed.

What is compared across all documents, in rounds of Spark:

1. High symbols, each with the words that windows beginning in it reach beyond it. All windows of one that occurs earlier too
   occur earlier; that is most of what is repeated. The low symbols of what is left are counted in the same round.
2. Windows of what is left whose inner low symbols all occur elsewhere too. No other window can be repeated.

A block of documents sends each name, or key of a window, once, so a passage that very many documents share has no more rows
than there are blocks. Names that are compared to tell equal words have 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import col
from tidemark.session import written

WINDOW = 20
#: Levels of the high and of the low symbols; three levels have symbols of some 2.4 words, twelve of some 30.
HIGH, LOW = 12, 2
#: Words of a block, and texts; a longer text is a block by itself. A task holds some 200 bytes for each word.
BLOCK_WORDS, BLOCK_TEXTS = 200_000, 60_000
#: Words in the documents for each part into which names and keys are dealt, and the least number of parts.
PART_WORDS, LEAST_PARTS = 2_000_000, 64

_K1, _K2, _K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))
_RUN, _SIDE = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
#: Rounds' kinds of rows; the last kind is what a block knows of itself and passes on to the next round.
_UNITS, _SYMBOLS, _WINDOWS, _OWN = range(4)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two numbers in order."""
    x = a * _K1
    x ^= x >> np.uint64(32)
    x += b
    x *= _K2
    x ^= x >> np.uint64(29)
    x *= _K3
    x ^= x >> np.uint64(32)
    return x


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate((x[by:], np.zeros(min(by, len(x)), x.dtype)))


def spans(names: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` names that begin at each place."""
    out, at, power, width = np.zeros(len(names), np.uint64), 0, names, 1
    while width <= size:
        if size & width:
            out, at = mix(out, _shifted(power, at)), at + width
        width *= 2
        if width <= size:
            power = mix(power, _shifted(power, width // 2))
    return out


def names_of(words: bytes) -> list[np.ndarray]:
    """Two numbers for each of the words, which line feeds part: sums of its bytes, each times its place's own number."""
    spelled = np.frombuffer(words + b"\n", np.uint8)
    ends = np.flatnonzero(spelled == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    places = np.arange(len(spelled)) - np.repeat(starts, ends - starts + 1)
    out = []
    for lane in (1, 2):
        weights = mix(np.arange(int(places.max()) + 1, dtype=np.uint64), np.full(1, lane, np.uint64)) | np.uint64(1)
        out.append(mix(np.add.reduceat(weights[places] * spelled, starts), np.full(1, lane, np.uint64)))
    return out


@dataclass
class Level:
    """One level over all words of a block. Starts are places of words and ascend."""

    runs: np.ndarray  # where runs of the level below start
    left: np.ndarray  # which of them are left symbols
    starts: np.ndarray  # where this level's symbols start
    names: list[np.ndarray]  # two numbers for each

    def places(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each word, which run and which symbol it is in."""
        out = []
        for starts in (self.runs, self.starts):
            marks = np.zeros(n, np.int64)
            marks[starts] = 1
            out.append(np.cumsum(marks) - 1)
        return out[0], out[1]


def levels(names: list[np.ndarray], docs: np.ndarray, count: int) -> Iterator[Level]:
    """Recompress words with two numbers each, ``docs`` being the document of each word."""
    starts = np.arange(len(docs))
    for level in range(count):
        first = np.ones(len(starts), bool)
        first[1:] = (names[0][1:] != names[0][:-1]) | (names[1][1:] != names[1][:-1]) | (docs[1:] != docs[:-1])
        at = np.flatnonzero(first)
        length = np.diff(np.append(at, len(starts)))
        long = np.flatnonzero(length > 1)
        names, starts, docs = [x[at] for x in names], starts[at], docs[at]
        for x in names:
            x[long] = mix(x[long] ^ _RUN, length[long].astype(np.uint64))
        left = mix(names[0], np.full(1, level, np.uint64) + _SIDE) >> np.uint64(63) == 0
        pair = np.zeros(len(starts), bool)
        pair[:-1] = left[:-1] & ~left[1:] & (docs[1:] == docs[:-1])
        keep = np.ones(len(starts), bool)
        keep[1:] = ~pair[:-1]
        both = np.flatnonzero(pair)
        merged = [x.copy() for x in names]
        for x, y in zip(merged, names):
            x[both] = mix(y[both], y[both + 1])
        runs, names, starts, docs = starts, [x[keep] for x in merged], starts[keep], docs[keep]
        yield Level(runs, left, starts, names)


def inner(windows: np.ndarray, size: int, steps: list[Level], n: int) -> tuple[np.ndarray, np.ndarray]:
    """What of each window, as places from and to, holds symbols of the last level that any equal window has too; nothing
    where from is not below to."""
    low, high = windows.copy(), windows + size
    for level in steps:
        run_of, _ = level.places(n)
        ends = np.append(level.runs[1:], n)
        # The first and the last run may go on outside.
        low = np.where(low < high, ends[run_of[np.minimum(low, n - 1)]], high)
        high = np.where(low < high, level.runs[run_of[np.maximum(high, 1) - 1]], low)
        # A right symbol at the beginning may belong to what stands before it, a left one at the end to what comes next.
        some = low < high
        first, last = run_of[np.minimum(low, n - 1)], run_of[np.maximum(high, 1) - 1]
        low = np.where(some & ~level.left[first], ends[first], low)
        high = np.where(some & level.left[last], level.runs[last], high)
    return low, high


class Keys:
    """Distinct keys of places, ascending, and which of the places is the first with its key."""

    def __init__(self, numbers: list[np.ndarray]):
        order = np.lexsort((numbers[1], numbers[0]))
        a, b = numbers[0][order], numbers[1][order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.numbers = [a[new], b[new]]
        self.first = order[new]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.times = np.diff(np.append(np.flatnonzero(new), len(order)))

    def __len__(self) -> int:
        return len(self.first)

    def bounds(self, parts: int) -> np.ndarray:
        """Where each part's keys begin, and at last where they end. Parts are equal ranges of the first number."""
        limits = [-(-(part << 64) // parts) for part in range(1, parts)]
        return np.concatenate(([0], np.searchsorted(self.numbers[0], np.array(limits, np.uint64)), [len(self)]))


class Block:
    """Some documents, in the order of their ids, and what the rounds know of them."""

    def __init__(self, row: dict, window: int):
        self.block, self.ids, self.window = row["block"], row["ids"], window
        unpack = zstandard.ZstdDecompressor().decompress
        spelled = unpack(row["words"])
        self.words = spelled.split()
        self.slots = np.frombuffer(unpack(row["slots"]), "<i4")
        self.counts = np.array(row["counts"], np.int64)
        self.n = len(self.slots)
        self.docs = np.repeat(np.arange(len(self.counts)), self.counts)
        self.ends = np.cumsum(self.counts)
        # Places in an array in which each document is followed by as many blanks as a window has words.
        self.padded = np.arange(self.n) + self.docs * window
        self.names = [x[self.slots] for x in names_of(spelled)]

    @cached_property
    def order(self) -> np.ndarray:
        """The ids of documents as numbers; those without one come last."""
        return np.array([np.iinfo(np.int64).max if i is None else i for i in self.ids], np.int64)

    def _spans(self, size: int) -> list[np.ndarray]:
        out = []
        for names in self.names:
            wide = np.zeros(self.n + len(self.counts) * self.window, np.uint64)
            wide[self.padded] = names
            out.append(spans(wide, size))
        return out

    @cached_property
    def has_window(self) -> np.ndarray:
        return np.arange(self.n) + self.window <= self.ends[self.docs]

    @cached_property
    def levels(self) -> list[Level]:
        """The low levels, and the high one."""
        return [x for i, x in enumerate(levels(self.names, self.docs, HIGH)) if i < LOW or i == HIGH - 1]

    @cached_property
    def units(self) -> tuple[Keys, np.ndarray, np.ndarray]:
        """Keys of the high symbols with a window, where they start, and where the next one starts."""
        top = self.levels[-1]
        starts, ends = top.starts, np.append(top.starts[1:], self.n)
        some = self.has_window[starts] if self.n else np.empty(0, bool)
        after = ends[some] + self.docs[starts[some]] * self.window
        keys = [mix(x[some], y[after]) for x, y in zip(top.names, self._spans(self.window - 1))]
        return Keys(keys), starts[some], ends[some]

    def _opened(self, chosen: np.ndarray) -> np.ndarray:
        """Which windows begin in the chosen units."""
        _, starts, ends = self.units
        change = np.zeros(self.n + 1, np.int64)
        change[starts[chosen]] += 1
        change[ends[chosen]] -= 1
        return (np.cumsum(change[:-1]) > 0) & self.has_window

    @cached_property
    def own(self) -> np.ndarray:
        """Which units are the first of their kind in this block."""
        keys = self.units[0]
        out = np.zeros(len(keys.which), bool)
        out[keys.first] = True
        return out

    @cached_property
    def symbols(self) -> tuple[Keys, np.ndarray]:
        """Keys of the low symbols in windows that begin in the block's own units; the places of these symbols."""
        low, windows = self.levels[LOW - 1], self._opened(self.own)
        change = np.zeros(self.n + self.window + 1, np.int64)
        change[: self.n] += windows
        change[self.window : self.window + self.n] -= windows
        at = np.flatnonzero((np.cumsum(change) > 0)[low.starts])
        first = low.names[0][at]
        return Keys([first, np.zeros(len(at), np.uint64)]), at

    def candidates(self, units_seen: np.ndarray, symbols_seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows of what no earlier unit holds, of which all inner symbols occur elsewhere too; and which windows begin in
        units that occur earlier. ``units_seen``: which of the distinct units do, in other blocks."""
        keys, _, _ = self.units
        first = self.own & ~units_seen[keys.which]
        windows = np.flatnonzero(self._opened(first))
        closed = self.has_window & ~self._opened(first)
        low = self.levels[LOW - 1]
        symbols, at = self.symbols
        shared = symbols_seen | (symbols.times > 1)
        alone = np.zeros(len(low.starts), np.int64)
        alone[at] = ~shared[symbols.which]
        before = np.concatenate(([0], np.cumsum(alone)))
        start, end = inner(windows, self.window, self.levels[:LOW], self.n)
        symbol_of = np.append(low.places(self.n)[1], len(low.starts))
        some = start < end
        start, end = np.where(some, start, 0), np.where(some, end, 0)
        return windows[before[symbol_of[end]] == before[symbol_of[start]]], closed

    def keys_of(self, windows: np.ndarray) -> Keys:
        return Keys([x[self.padded[windows]] for x in self._spans(self.window)])

    def kept(self, repeated: np.ndarray) -> np.ndarray:
        """Which words are in no repeated window."""
        sums = np.concatenate(([0], np.cumsum(repeated)))
        begin = np.maximum(np.arange(self.n) - self.window + 1, 0)
        return sums[1:] == sums[begin]


class _Slots(dict):
    """Words by their number; new ones get the next."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


_BLOCKS = "block long, ids array<long>, counts array<int>, slots binary, words binary"
_SENT = "part long, kind int, block long, numbers binary, owners binary"
_FLAGS = "block long, kind int, part long, bits binary"


def _blocked(batches, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Documents as blocks, each with its distinct words, and its texts as numbers of words."""
    number = TaskContext.get().partitionId() << 33
    rows: list[tuple] = []
    slots, size = _Slots(), 0

    def block() -> pa.RecordBatch:
        nonlocal rows, slots, size, number
        order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0]))
        pack = zstandard.ZstdCompressor(level=3).compress
        texts = np.concatenate([rows[i][1] for i in order])
        columns = [
            pa.array([number], pa.int64()),
            pa.array([[rows[i][0] for i in order]], pa.list_(pa.int64())),
            pa.array([[len(rows[i][1]) for i in order]], pa.list_(pa.int32())),
            pa.array([pack(texts.astype("<i4").tobytes())], pa.binary()),
            pa.array([pack(b"\n".join(slots))], pa.binary()),
        ]
        rows, slots, size, number = [], _Slots(), 0, number + 1
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for batch in batches:
        for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
            if rows and (size + len(words) > BLOCK_WORDS or len(rows) == BLOCK_TEXTS):
                yield block()
            rows.append((name, np.fromiter(map(slots.__getitem__, words), np.int32, len(words))))
            size += len(words)
    if rows:
        yield block()


def _sent(kind: int, block: Block, keys: Keys, owners: np.ndarray | None, parts: int) -> pa.RecordBatch:
    """A row for each part that any key is dealt to. ``owners``: the id of the first document with each key."""
    bounds = keys.bounds(parts)
    some = np.flatnonzero(np.diff(bounds))
    starts, ends = bounds[some], bounds[some + 1]
    numbers = keys.numbers[0] if owners is None else np.column_stack(keys.numbers)
    columns = [
        pa.array(some, pa.int64()),
        pa.array(np.full(len(some), kind, np.int32)),
        pa.array(np.full(len(some), block.block, np.int64)),
        pa.array([numbers[a:b].astype("<u8").tobytes() for a, b in zip(starts, ends)], pa.binary()),
        pa.array([b"" if owners is None else owners[a:b].astype("<i8").tobytes() for a, b in zip(starts, ends)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "kind", "block", "numbers", "owners"])


def _first_round(batches, window: int, parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row, window)
            units, starts, _ = block.units
            yield _sent(_UNITS, block, units, block.order[block.docs[starts[units.first]]], parts)
            yield _sent(_SYMBOLS, block, block.symbols[0], None, parts)
            del block, units, starts


def earlier(numbers: list[np.ndarray], owners: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Which keys an earlier owner has too; of the same owner's, those of the first block are earliest."""
    order = np.argsort(numbers[0], kind="stable")
    first = numbers[0][order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = first[1:] == first[:-1]
    some = order[same[1:] | same[:-1]]
    some = some[np.lexsort((blocks[some], owners[some], numbers[1][some], numbers[0][some]))]
    a, b = (x[some] for x in numbers)
    out = np.zeros(len(order), bool)
    out[some[1:]] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    return out


def elsewhere(numbers: np.ndarray) -> np.ndarray:
    """Which numbers are there more than once."""
    order = np.argsort(numbers, kind="stable")
    ordered = numbers[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    out = np.empty(len(order), bool)
    out[order] = same[1:] | same[:-1]
    return out


def _judged(batches, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part and kind become flags of their keys. Holds one kind of one part."""
    current, held = None, []

    def flags() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        if held[0]["kind"] == _OWN:
            rows = [{"block": r["block"], "kind": _OWN, "part": r["part"], "bits": r["numbers"]} for r in held]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
            return
        kind, part = held[0]["kind"], held[0]["part"]
        flat = np.frombuffer(b"".join(r["numbers"] for r in held), "<u8")
        blocks = np.array([r["block"] for r in held], np.int64)
        if kind == _SYMBOLS:
            sizes = np.array([len(r["numbers"]) // 8 for r in held])
            seen = elsewhere(flat)
        else:
            sizes = np.array([len(r["numbers"]) // 16 for r in held])
            owners = np.frombuffer(b"".join(r["owners"] for r in held), "<i8")
            seen = earlier([flat[::2], flat[1::2]], owners, np.repeat(blocks, sizes))
        ends = np.cumsum(sizes)
        sums = np.concatenate(([0], np.cumsum(seen)))
        some = np.flatnonzero(sums[ends] > sums[ends - sizes])
        columns = [
            pa.array(blocks[some]),
            pa.array(np.full(len(some), kind, np.int32)),
            pa.array(np.full(len(some), part, np.int64)),
            pa.array([np.packbits(seen[ends[i] - sizes[i] : ends[i]]).tobytes() for i in some], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    for batch in batches:
        for row in batch.to_pylist():
            if (row["part"], row["kind"]) != current:
                yield from flags()
                current, held = (row["part"], row["kind"]), []
            held.append(row)
    yield from flags()


def _with_flags(batches) -> Iterator[tuple[dict, dict[int, list[tuple[int, bytes]]]]]:
    """From rows sorted by block, a block's own row first: it, and the flags of its keys by kind."""
    row, flags = None, {}
    for batch in batches:
        for one in batch.to_pylist():
            if one["kind"] is None:
                if row is not None:
                    yield row, flags
                row, flags = one, {}
            else:
                flags.setdefault(one["kind"], []).append((one["part"], one["bits"]))
    if row is not None:
        yield row, flags


def _seen(keys: Keys, flags: list[tuple[int, bytes]], parts: int) -> np.ndarray:
    out, bounds = np.zeros(len(keys), bool), keys.bounds(parts)
    for part, bits in flags:
        a, b = bounds[part], bounds[part + 1]
        out[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
    return out


def _second_round(batches, window: int, parts: int) -> Iterator[pa.RecordBatch]:
    for row, flags in _with_flags(batches):
        block = Block(row, window)
        units = _seen(block.units[0], flags.get(_UNITS, []), parts)
        windows, closed = block.candidates(units, _seen(block.symbols[0], flags.get(_SYMBOLS, []), parts))
        keys = block.keys_of(windows)
        yield _sent(_WINDOWS, block, keys, block.order[block.docs[windows[keys.first]]], parts)
        some = np.zeros(block.n, bool)
        some[windows] = True
        own = zstandard.ZstdCompressor(level=3).compress(np.packbits(np.concatenate((some, closed))).tobytes())
        columns = [[block.block % parts], [_OWN], [block.block], [own], [b""]]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(columns, kinds)], ["part", "kind", "block", "numbers", "owners"]
        )
        del block, units, keys


def _cleaned(batches, window: int, parts: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for row, flags in _with_flags(batches):
        block = Block(row, window)
        own = np.frombuffer(zstandard.ZstdDecompressor().decompress(flags[_OWN][0][1]), np.uint8)
        some, repeated = np.unpackbits(own, count=2 * block.n).astype(bool).reshape(2, block.n)
        windows = np.flatnonzero(some)
        keys = block.keys_of(windows)
        again = np.ones(len(windows), bool)
        again[keys.first] = False
        repeated[windows] = again | _seen(keys, flags.get(_WINDOWS, []), parts)[keys.which]
        kept = block.kept(repeated)
        bounds = np.concatenate(([0], block.ends))
        counts = np.diff(np.concatenate(([0], np.cumsum(kept)))[bounds])
        left, at = block.slots[kept].tolist(), 0
        texts, size, first = [], 0, 0
        for i, n in enumerate(counts.tolist()):
            texts.append(b" ".join(map(block.words.__getitem__, left[at : at + n])))
            at, size = at + n, size + len(texts[-1])
            if size > 4_000_000 or i + 1 == len(counts):
                some = slice(first, i + 1)
                columns = [
                    pa.array(block.ids[some], pa.int64()),
                    pa.array(block.counts[some]),
                    pa.array(block.counts[some] - counts[some]),
                    pa.array(texts, pa.binary()).view(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                texts, size, first = [], 0, i + 1


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed (long) and text (the kept words, joined by one blank) for every row.

    A word goes if it is in a window of ``window`` words of one document that also begins earlier: in a document with a
    smaller id, or earlier in its own. Windows are those of the input, not of what is left. Words are runs of anything but
    ASCII white space and stay as they are. Null and empty texts have no words. Ids are whole numbers; rows without one come
    after all others, and rows that share one are documents of their own, of which those of the first block (by place in the
    input) come first. Other columns are not read. Documents of fewer words than a window lose nothing.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if window < 2:
        raise ValueError("a window has two words at least")
    id_type = docs.schema[id_col].dataType
    if not isinstance(id_type, T.IntegralType):
        raise TypeError("ids have to be whole numbers")
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    blocks_type, sent_type, flags_type = map(T.StructType.fromDDL, (_BLOCKS, _SENT, _FLAGS))
    flags_arrow = to_arrow_schema(flags_type)
    blocks_arrow = to_arrow_schema(blocks_type)
    blocks = written(rows.mapInArrow(lambda batches: _blocked(batches, blocks_arrow), blocks_type), "blocks")
    total = blocks.agg(F.sum(F.expr("aggregate(counts, 0L, (n, x) -> n + x)"))).first()[0] or 0
    parts = max(LEAST_PARTS, -(-total // PART_WORDS))

    def judged(sent: DataFrame, label: str) -> DataFrame:
        by_part = sent.repartition("part").sortWithinPartitions("part", "kind")
        return written(by_part.mapInArrow(lambda batches: _judged(batches, flags_arrow), flags_type), label)

    def with_flags(flags: DataFrame) -> DataFrame:
        both = blocks.unionByName(flags, allowMissingColumns=True)
        return both.repartition("block").sortWithinPartitions("block", F.col("kind").asc_nulls_first())

    first = judged(blocks.mapInArrow(lambda batches: _first_round(batches, window, parts), sent_type), "units")
    sent = with_flags(first).mapInArrow(lambda batches: _second_round(batches, window, parts), sent_type)
    second = judged(sent, "windows")
    made = T.StructType.fromDDL("doc_id long, n_words long, n_removed long, text string")
    made_arrow = to_arrow_schema(made)
    cleaned = with_flags(second).mapInArrow(lambda batches: _cleaned(batches, window, parts, made_arrow), made)
    return cleaned.withColumn("doc_id", F.col("doc_id").cast(id_type))
