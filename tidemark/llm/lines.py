"""Line dedup: lines that many documents hold are dropped from all of them but one.

Lines are exploded and normalised, only their hashes are shuffled, and the documents holding a hash are counted. What
comes back to a document is the positions to drop, so its text is moved once at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import BLANKS, ascii_lower, col, free_name
from tidemark.session import written

MIN_DOCS, MIN_CHARS = 3, 20


def _hashes(value: Column, first: str, second: str) -> list[Column]:
    """128 bits of hash in two columns."""
    return [F.xxhash64(value).alias(first), F.xxhash64(F.lit(1), value).alias(second)]


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line whose key has at least ``min_chars`` code points: doc_id, hash of the text, position, key hash.

    The key is the line without blanks at both ends, A-Z in lower case.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    lines = docs.select(
        col(id_col).alias("doc_id"), *_hashes(text, "t1", "t2"), F.posexplode(F.split(text, "\n")).alias("pos", "line")
    )
    keyed = lines.select("doc_id", "t1", "t2", "pos", ascii_lower(F.btrim("line", F.lit(BLANKS))).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        "doc_id", "t1", "t2", "pos", *_hashes(F.col("key"), "k1", "k2")
    )


def shared_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Key hashes held by at least ``min_docs`` documents: k1, k2, n_docs, keeper (the largest doc_id).

    Distinct (hash, document) pairs come first and both steps combine before the shuffle, so a line in a third of all
    documents costs no task more than another. Rows without an id count as one document.
    """
    holders = lines.select("k1", "k2", "doc_id").distinct()
    counted = holders.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
    return counted.where(F.col("n_docs") >= min_docs)


def _without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for texts, drops in batches:
        out = []
        for text, drop in zip(texts, drops):
            if text is None or drop is None:
                out.append(None)
                continue
            gone = set(drop)
            out.append("\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone))
        yield pd.Series(out, dtype=object)


_without_lines = F.pandas_udf(_without, T.StringType())


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
    counts: bool = False,
) -> DataFrame:
    """All documents with the text that is left; with ``counts`` also n_lines and n_dropped (long).

    Null text is one empty line and becomes an empty text. Rows that share an id are one document; a null id is one
    document, below all others. A text whose lines all go becomes empty, and stays as a row. Other columns are kept.
    """
    lines = written(line_hashes(docs, id_col, text_col, min_chars), "lines")
    # Written, the few shared lines have a known size, and a line in very many documents is a join key that AQE splits.
    shared = written(shared_lines(lines, min_docs), "shared-lines")
    dropped = (
        lines.join(shared, ["k1", "k2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "t1", "t2")
        .agg(F.collect_set("pos").alias("drop"))
    )
    own = {name: free_name(docs, f"line_{name}") for name in ("t1", "t2", "drop")}
    text = F.coalesce(col(text_col), F.lit(""))
    hashed = docs.withColumns(dict(zip((own["t1"], own["t2"]), _hashes(text, "t1", "t2"))))
    right = dropped.select(F.col("doc_id").alias(free_name(docs, "line_doc")), *[F.col(n).alias(own[n]) for n in own])
    left, right = hashed.alias("l"), right.alias("r")
    same = F.col(f"l.`{id_col}`").eqNullSafe(right[free_name(docs, "line_doc")])
    for n in ("t1", "t2"):
        same &= F.col(f"l.{own[n]}") == F.col(f"r.{own[n]}")
    joined = left.join(right.hint("shuffle_hash"), same, "left")
    drop = F.col(f"r.{own['drop']}")
    original = F.coalesce(F.col(f"l.`{text_col}`"), F.lit(""))
    # Only texts that lose lines are sent to Python.
    cut = _without_lines(F.when(drop.isNotNull(), original), drop)
    kept = F.when(drop.isNull(), original).otherwise(cut)
    out = joined.select(
        *[kept.alias(c) if c == text_col else F.col(f"l.`{c}`") for c in docs.columns],
        *(
            [
                F.size(F.split(original, "\n")).cast("long").alias("n_lines"),
                F.coalesce(F.size(drop), F.lit(0)).cast("long").alias("n_dropped"),
            ]
            if counts
            else []
        ),
    )
    return out
