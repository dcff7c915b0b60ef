"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule is an expression over a document's words, lines and counts. A small sample tells what a rule costs and how often it
rejects; the rules then run in the order of rejection per cost, and a document that one rule rejects is not looked at by the
next. The order changes the time, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, col

#: The sample on which rules are timed: so many documents, none longer than so many code points, each so many times.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_TIMES = 300, 20_000, 8
#: Seconds below which a rule's cost is not told from none.
CLOCK = 0.002

MIN_WORDS = 50
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``passes``: an expression over the columns that :func:`measured` makes; it is never null."""

    name: str
    passes: Callable[[], Column]


def _share(array: str, holds: Callable[[Column], Column]) -> Column:
    """How many members an expression holds for, out of all; 0 of none."""
    return F.coalesce(F.size(F.filter(F.col(array), holds)) / F.nullif(F.size(array), F.lit(0)), F.lit(0.0))


RULES = (
    Rule("word_length", lambda: F.col("word_chars").between(2 * F.col("n_words"), 12 * F.col("n_words"))),
    Rule("symbols", lambda: 10 * F.col("n_symbols") <= F.col("n_words")),
    Rule("repeated_lines", lambda: 2 * F.col("n_dup_lines") <= F.size("lines")),
    Rule("bullets", lambda: _share("lines", lambda x: F.btrim(x, F.lit(BLANKS)).rlike("^[-*•]")) <= 0.9),
    Rule("ellipses", lambda: _share("lines", lambda x: F.btrim(x, F.lit(BLANKS)).rlike(r"(\.\.\.|…)$")) <= 0.3),
    Rule("letters", lambda: _share("words", lambda x: x.rlike(r"\p{L}")) >= 0.8),
    Rule("capitals", lambda: _share("words", lambda x: (x == F.upper(x)) & (x != F.lower(x))) <= 0.5),
)


def _twins(array: str, field: str) -> Column:
    """Members of a sorted array of structs whose field equals a neighbour's."""

    def twin(x: Column, i: Column) -> Column:
        same = [F.get(F.col(array), i + step)[field] == x[field] for step in (-1, 1)]
        return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

    return F.filter(F.col(array), twin)


def measured(text: DataFrame) -> DataFrame:
    """Adds words, lines (those with a word) and the five counts (long) to a frame that has a column ``text``.

    Null text has no words. Words are runs of anything but blanks. Each step is one pass over a document's own arrays: the
    hashes of its 3-word windows show whether any repeats; only then are windows sorted, and those with equal hashes compared
    by their words.
    """
    blank = r"[\x20\x09-\x0D]+"
    trimmed = F.btrim(F.coalesce(F.col("text"), F.lit("")), F.lit(BLANKS))
    none = F.array().cast("array<string>")
    split = text.withColumns({
        "words": F.when(trimmed == "", none).otherwise(F.split(trimmed, blank)),
        "lines": F.when(trimmed == "", none).otherwise(
            F.filter(F.split(F.col("text"), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
        ),
    })
    starts = F.slice(F.col("words"), F.lit(1), F.greatest(F.size("words") - 2, F.lit(0)))
    counted = split.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.char_length(F.array_join("words", "")).cast("long"),
        "n_symbols": F.coalesce(F.regexp_count(F.col("text"), F.lit("[#*$%&|<>]")), F.lit(0)).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "windows": F.transform(
            starts, lambda w, i: F.xxhash64(w, F.get(F.col("words"), i + 1), F.get(F.col("words"), i + 2))
        ),
    })
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    staged = counted.withColumn("placed", F.when(repeats, placed))
    spelled = F.transform(
        _twins("placed", "h"),
        lambda x: F.struct(
            F.concat_ws(" ", *[F.get(F.col("words"), x["i"] + step) for step in (0, 1, 2)]).alias("s"), x["i"].alias("i")
        ),
    )
    staged = staged.withColumn("spelled", F.sort_array(spelled))
    staged = staged.withColumn("at", F.sort_array(F.transform(_twins("spelled", "s"), lambda x: x["i"])))
    covered = F.transform("at", lambda p, i: F.least(F.lit(3), F.coalesce(F.get(F.col("at"), i + 1) - p, F.lit(3))))
    total = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0))
    counts = F.struct(*BASE[:-1], total.cast("long").alias(BASE[-1]))
    # As output of a generator the counts are opaque: a filter on them is not rewritten into the steps above, where it would
    # compute a step anew for every member of an array.
    return staged.select(*[col(c) for c in (*text.columns, "words", "lines")], F.inline(F.array(counts)))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _seconds(df: DataFrame) -> float:
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def ordered(texts: DataFrame, rules: Sequence[Rule] = RULES) -> list[Rule]:
    """The rules by rejections per second on a sample of ``texts``; as given where there is nothing to time.

    The sample is what the first partitions hold: ``SAMPLE_DOCS`` documents of at most ``SAMPLE_CHARS`` code points.
    """
    spark = texts.sparkSession
    taken = texts.where(F.char_length("text") <= SAMPLE_CHARS).take(SAMPLE_DOCS)
    if not taken or len(rules) < 2:
        return list(rules)
    sample = spark.createDataFrame([(r["text"],) for r in taken], "text string").coalesce(1)
    copies = F.explode(F.sequence(F.lit(1), F.lit(SAMPLE_TIMES)))
    sample = measured(sample).where(~base_failed()).select("*", copies.alias("copy")).cache()
    try:
        rejected = sample.agg(*[F.avg((~r.passes()).cast("int")).alias(f"r{i}") for i, r in enumerate(rules)]).first()
        idle = min(_seconds(sample.select("copy")) for _ in range(3))
        cost = [max(CLOCK, min(_seconds(sample.select(r.passes())) for _ in range(2)) - idle) for r in rules]
    finally:
        sample.unpersist()
    gain = [(rejected[i] or 0.0) / cost[i] for i in range(len(rules))]
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: -gain[i])]


def verdict(rules: Sequence[Rule]) -> Column:
    """False at the first rule that rejects; later rules are not computed then."""
    kept = F.when(base_failed(), False)
    for rule in rules:
        kept = kept.when(~rule.passes(), False)
    return kept.otherwise(True)


def judge(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents with the five counts, base_failed and kept. Columns of these names are replaced.

    Null and empty texts have no words and fail. Repeated rows are judged alike; all rows stay. A repeated line counts from
    its second occurrence, and lines without a word are no lines.
    """
    keep = [c for c in docs.columns if c.lower() not in (*BASE, "base_failed", "kept")]
    inner = docs.select(*[col(c).alias(f"in_{i}") for i, c in enumerate(keep)], col(text_col).alias("text"))
    order = ordered(inner.select("text"), rules)
    judged = measured(inner).withColumns({"base_failed": base_failed(), "kept": verdict(order)})
    return judged.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(keep)], *BASE, "base_failed", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    inner = docs.select(*[col(c).alias(f"in_{i}") for i, c in enumerate(docs.columns)], col(text_col).alias("text"))
    kept = measured(inner).where(verdict(ordered(inner.select("text"), rules)))
    return kept.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)])
