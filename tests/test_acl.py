from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators.acl import explode_acl, parse_acl

CASES = {
    "{ines=wd*/olaf,=t/olaf}": [
        ("ines", False, ["UPDATE", "DELETE"], "olaf"),
        ("PUBLIC", True, ["TRIGGER"], "olaf"),
    ],
    '{"group night shift=aZx/the owner"}': [("night shift", True, ["INSERT", "REFERENCES"], "the owner")],
    '{"group a,b=r/o",c=D/o}': [("a,b", True, ["SELECT"], "o"), ("c", False, ["DROP"], "o")],
    "{kim=/olaf}": [("kim", False, [], "olaf")],
    "": [],
    "{}": [],
    "ines=r/olaf": None,
    "{ines=arwd}": None,
    "{ines=r/olaf,kim}": None,
    "{ines}": None,
    "{=}": None,
}


@pytest.mark.parametrize("text", CASES)
def test_parse(spark, text):
    frame = spark.createDataFrame([(text,)], "acl string")
    entries = frame.select(parse_acl(F.col("acl"))).first()[0]
    assert (None if entries is None else [tuple(e) for e in entries]) == CASES[text]


def test_missing_text_has_no_entries(spark):
    assert spark.createDataFrame([(None,)], "acl string").select(parse_acl(F.col("acl"))).first()[0] == []


def test_explode(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "i int, acl string")
    wanted = sum(len(e[2]) for entries in CASES.values() for e in entries or [])
    assert explode_acl(frame, "acl", "i").count() == wanted
