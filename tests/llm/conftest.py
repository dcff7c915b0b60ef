from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    """A folder's documents as (doc_id, text), and as a frame."""
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()], frame


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, blanks, repeated rows, odd signs, one very long text, and columns that clash with an operator's own."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "ÇA", "delta", "<|endoftext|>", "x y", "snow☃man", "İstanbul", "ΣΑΣ", "ét",
             "1234", "it's", "あ漢", "a_b", "#*$", "\U0001f600"]
    line = "The same long line is found in many documents"
    texts = [None, "", " ", "\n\n", "one", "\t one \r two\x0b", line, f" {line.upper()} \n{line}", f"x\n{line}\ty", line + "\n",
             "\x1c\x85 a b", "  lead", "trail  \n"]
    texts += [" ".join(rng.choices(words, k=rng.randrange(1, 90))) + rng.choice(["", "\n", " \n " + line]) for _ in range(60)]
    texts += [" ".join(rng.choices(words, k=30_000)), "ab " * 5000, texts[20], texts[20]]
    rows = [(i, t, None if i % 3 else "en", None, None) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(
        [(*r, i, "keep", "w") for i, r in enumerate(rows)], SCHEMA + ", N_Words int, k1 string, drop string"
    )
    return [(r[0], r[1]) for r in rows], frame
