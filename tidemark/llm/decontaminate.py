"""Benchmark decontamination with one Aho-Corasick automaton over the windows of all test items.

Words are runs of digits, letters and everything beyond ASCII, A-Z in lower case. The windows of an item, joined by single
blanks and fenced by blanks, are the patterns; a document in the same form is scanned once. Offsets of hits lead back to
words, and words to places in the original text.

Only windows and their numbers travel to the scan, so many at a time as an automaton may hold. Which items hold a window is a
table of its own, joined to the sets of windows that documents hit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import col, free_name
from tidemark.session import written

WINDOW = 10
#: Characters of patterns in one automaton; about a hundred times as many bytes in memory. Larger benchmarks are dealt to
#: several automata, and each document is scanned by all of them.
AUTOMATON_CHARS = 2_000_000

#: Every byte below 128 that is no digit and no letter becomes a blank, A-Z become a-z.
_FOLD = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else b if b >= 128 else 32 for b in range(256)
)
_WORDS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def normalise(text: str) -> list[bytes]:
    """The words of a text, as bytes."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows(text: str | None, size: int = WINDOW) -> set[bytes]:
    """The windows of an item; one that is shorter, but not empty, is one window. None for null."""
    words = normalise(text) if text else []
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def _patterns(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """Which items hold which windows (item, as text, and window), and the distinct windows (window, number), both written."""

    @F.arrow_udf("array<binary>")
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(windows(t.as_py(), size)) for t in texts], pa.list_(pa.binary()))

    rows = benchmark.select(col(item_col).cast("string").alias("item"), F.explode(cut(col(text_col))).alias("window"))
    held = written(rows, "held")
    return held, written(held.select("window").distinct().withColumn("number", F.monotonically_increasing_id()), "windows")


def _items(held: DataFrame, patterns: DataFrame) -> DataFrame:
    """The numbers of windows with the items that hold them. A window that very many items share is a hot key of this join only,
    which AQE splits."""
    return held.where(F.col("item").isNotNull()).join(patterns, "window").select("number", "item").distinct()


def _shards(patterns: DataFrame, limit: int) -> Iterator[list[tuple[int, bytes]]]:
    """Windows with their numbers, in parts of about ``limit`` characters at most; one empty part when there are none."""
    total = patterns.agg(F.sum(F.length("window") + 2)).first()[0] or 0
    parts = max(1, -(-int(total) // limit))
    for part in range(parts):
        mine = patterns if parts == 1 else patterns.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == part)
        yield [(r["number"], bytes(r["window"])) for r in mine.collect()]


def _automaton(patterns: list[tuple[int, bytes]]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for number, window in patterns:
        made.add_word(f" {window.decode('latin-1')} ", (number, window.count(b" ") + 1))
    made.make_automaton()
    return made


def _scan(automaton, folded: bytes) -> tuple[np.ndarray, set[int]]:
    """Places of the words in hits, sorted, and the numbers of the windows that hit. ``folded`` is fenced by blanks."""
    ends = list(automaton.iter(folded.decode("latin-1")))
    if not ends:
        return np.empty(0, np.int64), set()
    blanks = np.flatnonzero(np.frombuffer(folded, np.uint8) == 32)
    # The blank after a window's last word is the blank number (that word's place + 1).
    last = np.searchsorted(blanks, np.fromiter((e for e, _ in ends), np.int64, len(ends)))
    covered = np.zeros(len(blanks), np.int64)
    np.add.at(covered, last - np.fromiter((v[1] for _, v in ends), np.int64, len(ends)), 1)
    np.add.at(covered, last, -1)
    return np.flatnonzero(np.cumsum(covered)[:-1] > 0), {v[0] for _, v in ends}


def _spans(text: str, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as code point offsets in the original text."""
    if not len(hit):
        return []
    places = [m.span() for m in _WORDS.finditer(text)]
    first = np.r_[True, np.diff(hit) > 1]
    last = np.r_[first[1:], True]
    return [{"start": places[a][0], "end": places[b][1]} for a, b in zip(hit[first], hit[last])]


_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.IntegerType())),
        T.StructField("numbers", T.ArrayType(T.LongType())),
    ]
)
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _scanner(shared):
    @F.arrow_udf(_FOUND)
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = _automaton(shared.value) if shared.value else None
        for batch in batches:
            counts, hits, numbers = [], [], []
            for text in batch:
                words = normalise(text.as_py() or "")
                hit, which = _scan(automaton, b" " + b" ".join(words) + b" ") if words and automaton else ((), ())
                counts.append(len(words))
                hits.append(hit)
                numbers.append(sorted(which))
            arrays = [pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(numbers, pa.list_(pa.int64()))]
            yield pa.StructArray.from_arrays(arrays, names=["n_words", "hits", "numbers"])

    return scanned


@F.arrow_udf(T.LongType())
def _count_words(texts: pa.Array) -> pa.Array:
    return pa.array([len(normalise(t.as_py() or "")) for t in texts], pa.int64())


@F.arrow_udf(_SPANS)
def _place(texts: pa.Array, hits: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    found = [
        _spans(text.as_py(), np.array(hit.as_py(), np.int64)) if text.is_valid and hit.is_valid else []
        for text, hit in zip(texts, hits)
    ]
    return pa.array(found, kind)


def _found(frame: DataFrame, shards, text, found: str) -> DataFrame:
    """The frame with a column of words, hits and the numbers of windows."""
    spark, first = frame.sparkSession, next(shards)
    second = next(shards, None)
    if second is None:
        return frame.withColumn(found, _scanner(spark.sparkContext.broadcast(first))(text))
    # One automaton in memory at a time: each pass leaves its hits by the text's hash, and few texts have any.
    keys = [F.xxhash64(text), F.xxhash64(F.lit(1), text)]
    parts = []
    for patterns in chain([first, second], shards):
        shared = spark.sparkContext.broadcast(patterns)
        rows = frame.select(keys[0].alias("k1"), keys[1].alias("k2"), _scanner(shared)(text).alias("f"))
        parts.append(written(rows.where(F.size("f.hits") > 0).distinct(), "scan"))
        shared.unpersist()
    merged = reduce(DataFrame.unionAll, parts).groupBy("k1", "k2").agg(
        F.array_distinct(F.flatten(F.collect_list("f.hits"))).alias("hits"),
        F.array_distinct(F.flatten(F.collect_list("f.numbers"))).alias("numbers"),
    )
    k1, k2 = free_name(frame, "scan_k1"), free_name(frame, "scan_k2")
    merged = merged.select(F.col("k1").alias(k1), F.col("k2").alias(k2), "hits", "numbers")
    joined = frame.withColumns({k1: keys[0], k2: keys[1]}).join(merged, [k1, k2], "left")
    none = F.array().cast("array<int>"), F.array().cast("array<bigint>")
    one = F.struct(
        _count_words(text).alias("n_words"),
        F.coalesce("hits", none[0]).alias("hits"),
        F.coalesce("numbers", none[1]).alias("numbers"),
    )
    return joined.withColumn(found, one).drop(k1, k2, "hits", "numbers")


def _inner(docs: DataFrame) -> DataFrame:
    """The frame with names that nothing here uses."""
    return docs.select(*[col(c).alias(f"in_{i}") for i, c in enumerate(docs.columns)])


def scan(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", size: int = WINDOW, automaton_chars: int = AUTOMATON_CHARS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The documents with n_words, n_hit (words inside any occurrence of a window), item_ids (array of text, sorted), and
    spans (array of start and end in the text's code points).

    Null or empty text has no words and hits nothing; the same holds for every document when the benchmark is empty. Items
    without words have no window. Equal items all count; an item without an id hits under no name. Repeated rows all stay.
    Columns of ``docs`` with these four names are replaced. ``keep``: the columns of ``docs`` that are wanted, all unless
    given. What the scan finds is written before items are joined.
    """
    added = ("n_words", "n_hit", "item_ids", "spans")
    wanted = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    place = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    held, patterns = _patterns(benchmark, item_col, item_text_col, size)
    text = F.col(place[text_col])
    frame = _found(_inner(docs), _shards(patterns, automaton_chars), text, "found")
    some = F.size("found.hits") > 0
    # Only texts with hits are read a second time, for the places of their words.
    spans = _place(F.when(some, text), F.when(some, F.sort_array("found.hits")))
    scanned = frame.select(
        *[place[c] for c in wanted], "found.n_words", F.size("found.hits").cast("long").alias("n_hit"),
        F.sort_array("found.numbers").alias("numbers"), spans.alias("spans"),
    )
    scanned = written(scanned, "scanned")
    hit = scanned.where(F.size("numbers") > 0)
    # Documents that hit the same windows share one list of items.
    sets = hit.select("numbers").distinct().withColumn("number", F.explode("numbers"))
    listed = sets.join(_items(held, patterns), "number").groupBy("numbers").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    none = F.array().cast("array<string>")
    with_items = hit.join(listed, "numbers", "left").withColumn("item_ids", F.coalesce("item_ids", none))
    rest = scanned.where(F.size("numbers") == 0).withColumn("item_ids", none)
    return with_items.unionByName(rest).select(*[F.col(place[c]).alias(c) for c in wanted], *added)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    size: int = WINDOW, automaton_chars: int = AUTOMATON_CHARS,
) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their own columns."""
    _, patterns = _patterns(benchmark, item_col, item_text_col, size)
    frame = _inner(docs)
    frame = _found(frame, _shards(patterns, automaton_chars), F.col(f"in_{docs.columns.index(text_col)}"), "found")
    return frame.where(F.size("found.hits") == 0).select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)])
