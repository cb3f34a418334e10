from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import frame, rows
from finfacts.operators.nested import (
    assemble_documents, document_metadata, flatten_documents,
)
from finfacts.plans import filings as P
from finfacts.schema import DOCUMENT_PARTS


def test_filing_status_names_the_first_reason(tiny):
    status = dict(rows(P.filing_status(tiny["sub"], tiny["sym"]).select("adsh", "status")))
    assert status == {
        "f1": "ok", "f2": "ok", "f3": "ok", "f4": "bad period", "f5": "bad year",
        "f6": "bad quarter", "f7": "bad symbol", "f8": "bad symbol", "f9": "no symbol"}
    counts = P.filing_status_counts(tiny["sub"], tiny["sym"])
    assert counts.agg(F.sum("filings")).first()[0] == tiny["sub"].count()


def test_document_of_a_filing(tiny):
    docs = P.filing_documents(tiny)
    assert docs.count() == 3
    doc = docs.filter("adsh = 'f1'").first()
    assert (doc["startDate"], doc["endDate"], doc["year"], doc["quarter"], doc["symbol"]) == (
        date(2020, 1, 1), date(2020, 12, 31), 2020, "FY", "ONE")
    assert [tuple(f) for f in doc["data"]["bs"]] == [
        (None, "StockholdersEquity", "Equity", "USD", 40),
        ("Debts doc", "Liabilities", "Debt", "EUR", -3),
        ("First doc", "Assets", "The 'assets'", " usd ", 100),
        ("First doc", "Assets", "The 'assets'", "USD", 80),
        ("First doc", "Assets", "The 'assets'", "USD", 100),
    ]
    assert [f["concept"] for f in doc["data"]["ic"]] == ["CostOfRevenue"]
    empty = docs.filter("adsh = 'f3'").first()
    assert (empty["year"], empty["country"]) == (0, None)
    assert all(empty["data"][p] == [] for p in DOCUMENT_PARTS)


def test_tables_with_and_without_documents_agree(tiny):
    meta, data = P.document_tables(P.filing_documents(tiny))
    assert rows(meta) == rows(P.financial_metadata(tiny))
    assert rows(data) == rows(P.financial_data(tiny))
    assert {"id"} <= set(P.financial_data(tiny, ids=True).columns)


def test_unknown_part_is_an_error(tiny):
    with pytest.raises(ValueError):
        P.filing_documents(tiny, parts=("is",))


def test_a_filing_is_one_document(spark):
    headers = spark.sql("""SELECT k AS adsh, date'2020-01-01' startDate, date'2020-12-31' endDate,
        2020 year, 'FY' quarter, k symbol, k name, 'US' country, 'X' city
        FROM VALUES ('big'), ('copies'), ('small'), ('none') t(k)""")
    varied = spark.range(60_000).select(
        F.lit("big").alias("adsh"), F.lit("bs").alias("stmt"), F.lit("l").alias("label"),
        F.lit("c").alias("concept"), F.lit("i").alias("info"), F.lit("u").alias("unit"),
        F.col("id").alias("value"), F.lit(1).cast("long").alias("copies"))
    same = varied.limit(1).withColumns({"adsh": F.lit("copies"), "copies": F.lit(777).cast("long")})
    small = varied.limit(1).withColumn("adsh", F.lit("small"))
    docs = assemble_documents(headers, varied.union(same).union(small))
    got = rows(docs.select("adsh", F.size("data.bs")))
    assert got == [("big", 60_000), ("copies", 777), ("none", 0), ("small", 1)]
    assert flatten_documents(docs).filter("adsh = 'big'").select("value").distinct().count() == 60_000
    assert document_metadata(docs).count() == 4


def test_flatten_skips_empty_and_missing_arrays(spark):
    item = "struct<label:string,concept:string,info:string,unit:string,value:bigint>"
    docs = spark.sql(f"""SELECT 'a' symbol, named_struct(
        'bs', cast(array() AS array<{item}>), 'cf', cast(NULL AS array<{item}>),
        'ic', array(named_struct('label', 'l', 'concept', 'c', 'info', 'i', 'unit', 'u', 'value', 1L))
        ) data""")
    assert flatten_documents(docs).isEmpty()
    assert rows(flatten_documents(docs, DOCUMENT_PARTS)) == [("a", "ic", "l", "c", "i", "u", 1)]
