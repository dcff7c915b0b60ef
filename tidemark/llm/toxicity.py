"""Toxicity by maximum-scoring segments.

Words and the beginnings of words get log-odds between toxic and clean texts, drawn towards the corpus's own counts by a
Dirichlet prior. Every other word costs a little. A linear scan over a text's scores finds all maximal segments, and extreme
values of such scans tell how significant each is for a text of that length. A document's score is its best segment's
significance, calibrated on the labelled rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col
from tidemark.session import written

#: Labelled rows that the classifier is fitted on: so many of each class at most, chosen by hash. In the calibration the
#: rows of a class weigh as many as it has in all.
MAX_LABELS = 25_000
#: Terms of the model: how significant they have to be, and their least log-odds. All such terms are kept; there are no
#: more than the words of the labelled toxic rows and their beginnings. These two and ``COST`` have the least log loss of 27
#: settings in a cross-validation over folds 1 to 4.
MIN_Z, MIN_ODDS = 3.0, 2.0
#: The prior weighs this share of the labelled words.
PRIOR = 0.1
#: Lengths of the beginnings of words that are terms too.
STEMS = (5, 4)
#: What a word that is no term costs at least; in a clean text, scores have to sink on the average.
COST = 0.02
#: Segments are reported as passages up to this expected number in a clean text of the same length.
MAX_EXPECTED = 0.05
#: Folds by crc32 of the id as text; fold 0 is held out.
FOLDS = 5

#: Words that a Python worker counts or remembers before it starts anew.
_REMEMBER = 400_000

_WORD = re.compile(r"[^\W\d_]+")


def fold(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode()) % FOLDS


@dataclass(frozen=True)
class Model:
    """Scores of terms (a beginning ends with ``*``), the scale of extreme values, and the calibration's line, which takes texts
    for clean until labels tell."""

    terms: Mapping[str, float]
    scale: float
    cost: float = COST
    slope: float = 1.0
    level: float = -2.0

    def score_of(self, word: str) -> float:
        """The score of the most special term that fits."""
        for term in (word, *(word[:n] + "*" for n in STEMS if len(word) > n)):
            if term in self.terms:
                return self.terms[term]
        return -self.cost

    def evidence(self, best: float, n_words: int) -> float:
        """How far, on the scale of extreme values, a best segment lies beyond what a clean text of this length holds."""
        return self.scale * best - math.log(n_words + 1)

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.slope * evidence + self.level))))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last + 1, score), left to right, in time linear in their number of positive scores.

    A segment is maximal if no part of it scores more and no longer one holds it and scores at least as much at every step:
    each new positive score is joined to the nearest earlier segment that starts lower, as long as the joint one ends higher.
    Each segment keeps which one that is, so that those between are passed over once.
    """
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    kept: list[tuple[int, int, float, float]] = []  # first, last + 1, sum before, sum at the end
    lower: list[int] = []  # the nearest earlier segment that starts lower, or -1
    for at in np.flatnonzero(scores > 0).tolist():
        new = (at, at + 1, float(sums[at]), float(sums[at + 1]))
        i = len(kept) - 1
        while i >= 0 and kept[i][2] >= new[2]:
            i = lower[i]
        while i >= 0 and kept[i][3] < new[3]:
            new, j = (kept[i][0], new[1], kept[i][2], new[3]), lower[i]
            del kept[i:], lower[i:]
            i = j
        kept.append(new)
        lower.append(i)
    return [(a, b, end - start) for a, b, start, end in kept]


def _counts(batches: Iterator[pa.RecordBatch], labels) -> Iterator[pa.RecordBatch]:
    """(word, n, toxic, clean): how many of all, toxic and clean labelled texts of a task hold a word. Texts count, since
    one that repeats a word a thousand times tells no more of it than one that uses it once."""
    known = labels.value
    found = {None: Counter(), 0: Counter(), 1: Counter()}

    def rows() -> pa.RecordBatch:
        words = list(set().union(*found.values()))
        columns = [[found[k][w] for w in words] for k in (None, 1, 0)]
        columns[0] = [sum(c) for c in zip(*columns)]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), *(pa.array(c, pa.int64()) for c in columns)], ["word", "n", "toxic", "clean"]
        )

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            found[known.get(doc)].update({w.lower() for w in set(_WORD.findall(text.as_py() or ""))})
            if sum(map(len, found.values())) > _REMEMBER:
                yield rows()
                for counter in found.values():
                    counter.clear()
    yield rows()


def _sample(labels: DataFrame, id_col: str, label_col: str) -> tuple[dict, dict[int, float]]:
    """doc_id -> 0 or 1 of the labelled rows that are not held out: the ``MAX_LABELS`` smallest hashes of each class; and how
    many labelled rows of its class one of the sample stands for.

    Of labels that differ for one id the larger counts; null ids and labels count nowhere.
    """
    one = labels.select(col(id_col).alias("doc_id"), col(label_col).alias("label")).dropna()
    one = one.where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0).groupBy("doc_id").agg(F.max("label").alias("label"))
    totals = {row["label"]: row["count"] for row in one.groupBy("label").count().collect()}
    found = {}
    for label in (0, 1):
        for row in one.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELS).collect():
            found[row["doc_id"]] = label
    taken = Counter(found.values())
    return found, {label: totals[label] / n for label, n in taken.items()}


def _terms(counts: DataFrame) -> Model:
    """Scores of the significant terms, what other words cost, and the scale of extreme values of clean texts."""
    sums = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "toxic", "clean")]).first()
    prior = PRIOR * (sums["toxic"] + sums["clean"])
    if not sums["toxic"] or not sums["clean"]:
        return Model({}, 1.0)
    stems = [
        counts.where(F.length("word") > n)
        .groupBy(F.concat(F.substring("word", 1, n), F.lit("*")).alias("word"))
        .agg(*[F.sum(c).alias(c) for c in ("n", "toxic", "clean")])
        for n in STEMS
    ]
    table = counts
    for stem in stems:
        table = table.unionByName(stem)
    share = prior * F.col("n") / sums["n"]
    toxic, clean = F.col("toxic") + share, F.col("clean") + share
    odds = F.log(toxic / (sums["toxic"] + prior - toxic)) - F.log(clean / (sums["clean"] + prior - clean))
    weighed = table.where("toxic > 0").select(
        "word", odds.alias("odds"), (odds / F.sqrt(1 / toxic + 1 / clean)).alias("z"),
        (clean / (sums["clean"] + prior)).alias("share"),
    )
    rows = weighed.where((F.col("z") >= MIN_Z) & (F.col("odds") >= MIN_ODDS)).orderBy(F.desc("z"), "word").collect()
    shares, odds = (np.array([r[c] for r in rows], float) for c in ("share", "odds"))
    # The scale at which exp(scale * score) has the mean one over clean words: there, best segments are extreme values.
    rest = max(1e-9, 1 - float(shares.sum()))
    cost = max(COST, 2 * float((shares * odds).sum()) / rest)
    low, high = 1e-3, 50.0
    for _ in range(100):
        scale = (low + high) / 2
        mean = rest * math.exp(-cost * scale) + float((shares * np.exp(np.minimum(700, scale * odds))).sum())
        low, high = (scale, high) if mean < 1 else (low, scale)
    return Model({r["word"]: float(r["odds"]) for r in rows}, low if rows else 1.0, cost)


def _calibrated(model: Model, evidence: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Model:
    """The logistic line from evidence to label, by Newton's steps with a little ridge.

    ``weights`` are in proportion to the labelled rows that a row stands for, so that the line has the mix of all labels and
    not of a sample that holds more of one class.
    """
    weights = weights / max(1e-9, float(weights.mean())) if len(weights) else weights
    x = np.stack([evidence, np.ones(len(evidence))], axis=1)
    # Prior probabilities as labelled, drawn towards the line through zero.
    w, ridge = np.array([0.1, 0.0]), np.array([1e-3, 1e-3]) * max(1, len(x))
    start = w.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weights * (labels - p)) - ridge * (w - start)
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient)
        w = w + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return replace(model, slope=max(float(w[0]), 1e-6), level=float(w[1]))


class _Scores(dict):
    """The scores of words as they are written. Words are found in texts before they are lowered, as lower case may be longer."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        score = self.model.score_of(word.lower())
        if len(self) < _REMEMBER:
            self[word] = score
        return score


def _scan(text: str, scores: _Scores) -> tuple[int, list[tuple[int, int, float]]]:
    words = _WORD.findall(text)
    return len(words), segments(np.fromiter(map(scores.__getitem__, words), np.float64, len(words)))


def _spans(text: str, found: list[tuple[int, int, float, float]]) -> list[dict]:
    """Passages by code points of the text."""
    if not found:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    return [{"start": places[a][0], "end": places[b - 1][1], "score": s, "expected": e} for a, b, s, e in found]


_PASSAGES = "array<struct<start:int,end:int,score:double,expected:double>>"


def _score(batches: Iterator[pa.RecordBatch], shared, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    model = Model(*shared.value)
    scores = _Scores(model)
    for batch in batches:
        evidence, probability, passages = [], [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            n, found = _scan(text, scores)
            best = max((s for _, _, s in found), default=0.0)
            evidence.append(model.evidence(best, n))
            probability.append(model.probability(evidence[-1]))
            expected = [(a, b, s, math.exp(-model.evidence(s, n))) for a, b, s in found]
            passages.append(_spans(text, [x for x in expected if x[3] <= MAX_EXPECTED]))
        values = {"doc_id": batch.column("doc_id"), "evidence": evidence, "score": probability, "passages": passages}
        yield pa.RecordBatch.from_arrays([pa.array(values[f.name], f.type) for f in schema], schema=schema)


def _scored(docs: DataFrame, model: Model, id_col: str, text_col: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((model.terms, model.scale, model.cost, model.slope, model.level))
    made = StructType().add("doc_id", rows.schema["doc_id"].dataType).add("evidence", "double").add("score", "double")
    made.add("passages", _passage_type())
    arrow = to_arrow_schema(made)
    return rows.mapInArrow(lambda batches: _score(batches, shared, arrow), made)


def _passage_type():
    from pyspark.sql.types import StructType

    return StructType.fromDDL(f"p {_PASSAGES}")["p"].dataType


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Model:
    """A model from the labelled rows outside the held-out fold and from the words of all documents.

    Words are counted over all documents in one pass; labels are a bounded sample, so they travel to the scan and texts are
    not shuffled. An id that several rows share counts once, by its row of most evidence. Without labels of both classes there
    are no terms, and every score is well below one half.
    """
    spark = docs.sparkSession
    sample, stands_for = _sample(labels, id_col, label_col)
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(sample)
    counted = rows.mapInArrow(lambda batches: _counts(batches, shared), "word string, n long, toxic long, clean long")
    counts = counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "toxic", "clean")])
    model = _terms(written(counts, "words"))
    if not model.terms:
        return model
    ids = spark.createDataFrame(list(sample.items()), f"id {rows.schema['doc_id'].dataType.simpleString()}, label int")
    labelled = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("id")).select("doc_id", "text")
    # One row for each id of the bounded sample, however many rows share one.
    found = _scored(labelled, model, "doc_id", "text").groupBy("doc_id").agg(F.max("evidence").alias("evidence")).toPandas()
    known = [sample[d] for d in found["doc_id"]]
    weights = np.array([stands_for[label] for label in known], float)
    return _calibrated(model, found["evidence"].to_numpy(float), np.array(known, float), weights)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from one half on), passages for every row.

    A passage is a significant segment: its code points in the text, its score, and how many such a clean text of that length
    would hold. Null and empty texts have no words and score as a text without toxic words. Rows that repeat an id are each
    scored by their own text.
    """
    scored = _scored(docs, model, id_col, text_col)
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select("doc_id", "score", predicted.alias("predicted"), "passages")
