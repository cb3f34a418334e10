from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import frame
from finfacts import functions as B
from finfacts.schema import FISCAL_PERIOD_SPELLINGS, UNIT_SPELLINGS


def apply(spark, function, *values):
    """Results of a one-column function on literal texts, in order."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_fiscal_period_spellings(spark):
    for period, spellings in FISCAL_PERIOD_SPELLINGS.items():
        messy = [f" {s.lower()} " for s in spellings]
        assert apply(spark, B.norm_fiscal_period, *messy) == [period] * len(messy)
    assert apply(spark, B.norm_fiscal_period, "H1", "", None, "\tQ1") == [None] * 4
    keep = lambda c: B.norm_fiscal_period(c, keep_unknown=True)
    assert apply(spark, keep, "H1", "1st", None) == ["H1", "Q1", None]


def test_unit_spellings(spark):
    for unit, spellings in UNIT_SPELLINGS.items():
        assert apply(spark, B.norm_unit, *[f" {s.lower()} " for s in spellings]) == [unit] * len(spellings)
    assert apply(spark, B.norm_unit, "EUR", "", None) == ["USD"] * 3


def test_safe_decimal(spark):
    assert apply(spark, B.safe_decimal, "1.23456", "-7", "n/a", "", None, "1e3") == [
        Decimal("1.2346"), Decimal("-7.0000"), None, None, None, Decimal("1000.0000")]


def test_dates(spark):
    assert apply(spark, B.parse_period, "20200229", "20200230", "2020-01-01", "2020010", "bad", None) == [
        date(2020, 2, 29), None, None, None, None, None]
    assert apply(spark, B.safe_date, "20200229", "2020-01-01", "18991231", "19000101", "21000101",
                 "21000102", "x", None) == [
        date(2020, 2, 29), date(2020, 1, 1), None, date(1900, 1, 1), date(2100, 1, 1), None, None, None]


def test_years(spark):
    assert apply(spark, B.safe_year, " 2020 ", "20x0", None) == [2020, None, None]
    assert apply(spark, B.doc_year, "2020", None, "20x0") == [2020, 0, None]
    assert apply(spark, B.doc_quarter, "\tq1 \n", "fy", None) == ["Q1", "FY", None]


@pytest.mark.parametrize("start, code, end", [
    ("2020-01-01", "FY", date(2020, 12, 31)), ("2020-01-01", "CY", date(2020, 12, 31)),
    ("2020-01-01", "H2", date(2020, 6, 30)), ("2020-01-01", "T3", date(2020, 4, 30)),
    ("2020-01-31", "Q1", date(2020, 4, 29)), ("2019-11-30", "Q4", date(2020, 2, 28)),
    ("2020-01-01", "SECOND", None), ("2020-01-01", None, None),
])
def test_period_end(spark, start, code, end):
    df = spark.createDataFrame([(start, code)], "s string, c string")
    assert df.select(B.period_end(F.to_date("s"), F.col("c"))).first()[0] == end


def test_period_key(spark):
    df = spark.createDataFrame(
        [(2020, "Q1"), (1999, "Q1"), (2020, "FY"), (2003, "Q4"), (None, "Q1")], "y int, q string")
    assert [r[0] for r in df.select(B.period_key(F.col("y"), F.col("q"))).collect()] == [
        "2020q1", None, None, "2003q4", None]
    assert df.select(B.period_key(F.col("y"), F.col("q"), 2006)).collect()[3][0] is None


def test_text(spark):
    assert apply(spark, B.norm_symbol, " \tabc\n", "x" * 19, "x" * 20, "  ", None) == [
        "ABC", "X" * 19, None, None, None]
    assert apply(spark, B.clean_text, 'a\r\nb"c') == ['a b"c']
    assert apply(spark, lambda c: B.clean_text(c, label=True), 'a\r\nb"c') == ["a b'c"]
    assert apply(spark, B.route_stmt, "BS", " CF ", "IC", "IS", "bs", None) == [
        "bs", "cf", "ic", None, None, None]
    assert apply(spark, lambda c: B.route_stmt(c, ("is",)), "IS", "BS") == ["is", None]
    assert apply(spark, B.last_path_segment, "/a/b.zip", "b", "/a/") == ["b.zip", "b", ""]


def test_document_value(spark):
    assert apply(spark, B.doc_value, "0.85", "-1.9", "2e2", "n/a", None, "1" + "0" * 20) == [
        0, -1, 200, None, None, None]
    assert apply(spark, lambda c: B.doc_value(c, exact=True), "0.85") == [Decimal("0.8500")]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (1, -4), (None, 4)], "n int, d int")
    assert [r[0] for r in df.select(B.safe_ratio(F.col("n"), F.col("d"))).collect()] == [
        0.25, None, None, None]


def test_doc_field(spark):
    doc = frame(spark, "j string, n int", ('{"a": {"b": "7"}, "c": null}', 1)).select(
        F.parse_json("j").alias("d"))
    got = doc.select(B.doc_field(F.col("d"), "a.b", "int"), B.doc_field(F.col("d"), "c", "string"),
                     B.doc_field(F.col("d"), "z", "string")).first()
    assert tuple(got) == (7, None, None)
