from __future__ import annotations

import json
import unicodedata
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import functions as f
from tidemark.functions.text import _fold_table


def one_column(spark, values, column, schema="v string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    data_type = frame.schema["v"].dataType
    return [r[1] for r in frame.select("i", column(F.col("v"), data_type)).orderBy("i").collect()]


def folded(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")


def test_fold_of_every_code_point(spark):
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["a" + "b".join(chars[i : i + 500]) + "c" for i in range(0, len(chars), 500)]
    assert one_column(spark, texts, lambda c, _: f.ascii_fold(c)) == [folded(t) for t in texts]


def test_fold_of_each_special_character_alone(spark):
    singles, _, several = _fold_table()
    texts = [*singles, *several, "", "plain", None, "ﬁ½ßéǄ", "é", "…", "日本語"]
    wanted = [None if t is None else folded(t) for t in texts]
    assert one_column(spark, texts, lambda c, _: f.ascii_fold(c)) == wanted


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=40), min_size=1, max_size=60))
def test_fold_of_any_text(spark, texts):
    assert one_column(spark, texts, lambda c, _: f.ascii_fold(c)) == [folded(t) for t in texts]


def test_truncate_counts_characters(spark):
    texts = ["é" * 70000, "abc", None]
    assert one_column(spark, texts, lambda c, _: f.truncate_text(c)) == ["é" * 65535, "abc", None]


def test_fit_to_width_replaces_bad_bytes(spark):
    raw = [b"caf\xc3\xa9 x", b"a\xffb", None]
    assert one_column(spark, raw, lambda c, _: f.fit_to_width(c, 5), "v binary") == ["café ", "a�b", None]


def test_binary_text_is_strict(spark):
    assert one_column(spark, ["Zoë".encode(), None], lambda c, _: f.binary_text(c), "v binary") == ["Zoë", None]
    with pytest.raises(PySparkException):
        one_column(spark, [b"a\xff"], lambda c, _: f.binary_text(c), "v binary")


def test_uuid_text(spark):
    want = "0123abcd-0123-abcd-ef01-0123456789ab"
    texts = [want, want.upper(), want.replace("-", ""), "{" + want + "}", "urn:uuid:" + want, "no", None]
    assert one_column(spark, texts, lambda c, _: f.uuid_text(c)) == [want] * 5 + [None, None]


def test_timestamps(spark):
    values = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 500000), datetime(1, 1, 1, 0, 0, 0, 7), None]
    wanted = [None if v is None else v.isoformat(" ") for v in values]
    assert one_column(spark, values, lambda c, _: f.iso_timestamp(c), "v timestamp_ntz") == wanted
    logged = [None if v is None else v.strftime("%Y-%m-%d %H:%M:%S.%f").rjust(26, "0") for v in values]
    assert one_column(spark, values, f.index_text, "v timestamp_ntz") == logged


def test_zoned_timestamp_has_an_offset(spark):
    row = spark.sql("SELECT timestamp'2024-01-02 03:04:05.25+02:00' AS v").select(f.iso_timestamp(F.col("v"), zoned=True))
    assert row.first()[0] == "2024-01-02 01:04:05.250000+00:00"


def test_dates(spark):
    values = [date(2024, 1, 2), date(1, 1, 1), None]
    assert one_column(spark, values, lambda c, _: f.iso_date(c), "v date") == ["2024-01-02", "0001-01-01", None]


def test_intervals_are_times_of_day(spark):
    spans = [timedelta(hours=1, seconds=2), timedelta(days=3, hours=23, microseconds=50), timedelta(0), timedelta(seconds=-1), None]
    wanted = [None if s is None or s < timedelta(0) else (datetime.min + s).time().isoformat() for s in spans]
    got = one_column(spark, spans, lambda c, _: f.interval_time_of_day(c), "v interval day to second")
    assert got == wanted


def test_index_text_takes_integers_and_timestamps_only(spark):
    assert one_column(spark, [5, -7, None], f.index_text, "v bigint") == ["5", "-7", None]
    for kind in (T.StringType(), T.DoubleType(), T.DateType(), T.DecimalType(10, 0)):
        with pytest.raises(TypeError):
            f.index_text(F.col("v"), kind)


def test_zero_dates(spark):
    texts = ["2024-01-05 10:00:00", "0000-00-00 00:00:00", "", "2024-02-30", None]
    got = one_column(spark, texts, lambda c, _: f.zero_date_default(c))
    assert got == [datetime(2024, 1, 5, 10), datetime.min, datetime.min, datetime.min, None]
    got = one_column(spark, ["2024-01-05", "0000-00-00", None], lambda c, _: f.zero_date_default(c, "date"))
    assert got == [date(2024, 1, 5), date.min, None]


@pytest.mark.parametrize("scale", [0, 2, 6, 7, 18])
def test_decimal_text(spark, scale):
    unit = Decimal(1).scaleb(-scale)
    values = [unit * n for n in (0, 1, -1, 12, 123400, -99999, 1234567)] + [Decimal("3.5").quantize(unit)]
    values = [v.quantize(unit) for v in values] + [None]
    wanted = [None if v is None else str(v) for v in values]
    assert one_column(spark, values, lambda c, _: f.decimal_text(c, scale), f"v decimal(38,{scale})") == wanted


def test_json_of_nested_values(spark):
    schema = "v struct<a:int,b:string,c:array<double>,d:map<string,boolean>,e:struct<f:string>,g:array<struct<h:bigint>>>"
    values = [
        {"a": 1, "b": 'q"\\\n\té😀\x7f/', "c": [1.0, 0.1, 1e16, 1.5e-5, 123456789.25, 1e7, -2.5e20, 0.00012, None], "d": {"ü": True},
         "e": {"f": "x"}, "g": [{"h": 5}, {"h": None}]},
        {"a": None, "b": "", "c": [], "d": {}, "e": {"f": None}, "g": [None]},
        None,
    ]
    got = one_column(spark, values, f.json_text, schema)
    assert got[:2] == [json.dumps(v) for v in values[:2]]
    assert got[2] is None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=20), min_size=1, max_size=30))
def test_json_of_any_text(spark, texts):
    got = one_column(spark, [[t] for t in texts], f.json_text, "v array<string>")
    assert got == [json.dumps([t]) for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**6), 10**6), min_size=1, max_size=30), st.integers(-12, 20))
def test_json_of_floats(spark, units, power):
    values = [[float(f"{n}e{power}")] for n in units]
    assert one_column(spark, values, f.json_text, "v array<double>") == [json.dumps(v) for v in values]


def test_normalize_row_keeps_types_unless_staged(spark):
    schema = "s string, i int, d decimal(9,2), t timestamp_ntz, b binary, a array<int>, k boolean, f float, y date"
    row = ("Zoë", 1, Decimal("1.50"), datetime(2024, 1, 1), b"x", [1, None], True, 0.5, date(2024, 1, 1))
    frame = spark.createDataFrame([row], schema)
    assert tuple(f.normalize_row(frame).first()) == (
        "Zoe", 1, Decimal("1.50"), datetime(2024, 1, 1), "x", "[1, null]", True, 0.5, date(2024, 1, 1)
    )
    staged = f.normalize_row(frame, as_staged=True)
    assert tuple(staged.first()) == ("Zoe", 1, "1.50", "2024-01-01 00:00:00", "x", "[1, null]", True, 0.5, "2024-01-01")
    assert {x.dataType.simpleString() for x in staged.schema} == {"string", "bigint", "double", "boolean"}


@pytest.fixture
def time_type(spark):
    """TIME columns are off by default."""
    spark.conf.set("spark.sql.timeType.enabled", "true")
    yield
    spark.conf.unset("spark.sql.timeType.enabled")


def test_times(spark, time_type):
    row = spark.sql("SELECT time'10:11:12' AS a, time'10:11:12.5' AS b, CAST(NULL AS TIME) AS c")
    assert tuple(row.select(*[f.iso_time(F.col(x)) for x in "abc"]).first()) == ("10:11:12", "10:11:12.500000", None)
    assert tuple(f.normalize_row(row).first()) == ("10:11:12", "10:11:12.500000", None)


def test_intervals_of_any_fields_are_times_of_day(spark):
    kinds = ["DAY", "HOUR", "DAY TO HOUR", "HOUR TO MINUTE", "MINUTE TO SECOND", "SECOND"]
    texts = ["'1'", "'5'", "'1 5'", "'5:07'", "'7:09.5'", "'9.25'"]
    row = spark.sql("SELECT " + ", ".join(f"INTERVAL {t} {k} AS c{i}" for i, (t, k) in enumerate(zip(texts, kinds))))
    got = tuple(f.normalize_row(row).first())
    assert got == ("00:00:00", "05:00:00", "05:00:00", "05:07:00", "00:07:09.500000", "00:00:09.250000")
