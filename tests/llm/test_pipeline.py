from __future__ import annotations

import re
import subprocess
import sys

import brute
import pytest
from test_tokens import WORDS, check_packing, library

import corpus_pipeline
from tidemark.llm.catalogue import CATALOGUE
from tidemark.llm.oracle import ORACLE

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_the_pipeline_against_brute_force(spark, sf_dir, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    docs = brute.without_lines([(d, t) for d, t in documents[0] if brute.kept(t)])
    groups = brute.groups([(d, brute.fingerprint(t)) for d, t in docs])
    docs = [(d, t) for d, t in docs if groups[d] == d]
    hit = brute.decontaminate(docs, items)
    docs = [(d, t) for d, t in docs if not hit[d][-1]]
    assert 0 < len(docs) < len(documents[0])
    ids = {d: i + [2] for (d, _), i in zip(docs, library(WORDS, [t for _, t in docs]))}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert check_packing(rows, ids) < 0.02
    assert all(list(r["ids"]) == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]] for r in rows)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_documents(spark, sf_dir, odd_documents, name):
    odd = odd_documents[1]
    out = stage(name)(spark, odd, sf_dir)
    if name != "packing":
        assert out.columns == odd.columns
        assert out.dtypes == odd.dtypes
    out.collect()
    assert stage(name)(spark, odd.limit(0), sf_dir).count() == 0


def test_stages_are_the_ones_that_were_asked_for():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "simhash near-dedup", "benchmark decontamination", "packing"]


def test_every_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in CATALOGUE)
    assert numbers == list(range(1, 14)) and ORACLE.keys() <= CATALOGUE.keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_and_their_sql_agree(spark, sf_dir, name):
    from compare import difference, oracle_connection

    assert difference(spark, oracle_connection(sf_dir), sf_dir, CATALOGUE[name], ORACLE[name]) is None


def test_nothing_else_needs_these_operators():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['tidemark.llm'] = None\n"
        "import __spark_entry__ as e; assert not any(n.startswith('op') and n[2].isdigit() for n in e.queries())\n"
    )
    root = corpus_pipeline.__file__.rsplit("/", 1)[0]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
