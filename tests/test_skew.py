"""One filing, tag, company or group of copies holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from conftest import frame, rows
from finfacts.operators.nested import flatten_documents
from finfacts.plans import catalog as N, filings as P, statements as S
from finfacts.schema import DOCUMENT_PARTS

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture()
def skewed(spark, tiny):
    """The small tables with a filing of 30,000 values, a third of them copies."""
    i = F.col("id")
    value = F.when(i % 3 == 0, F.lit("7")).otherwise(i.cast("string"))
    num = spark.range(0, 30_000, 1, 12).select(
        F.lit("f1").alias("adsh"), F.lit("Assets").alias("tag"), F.lit("v1").alias("version"),
        F.lit("20191231").alias("ddate"), F.lit("0").alias("qtrs"), F.lit("USD").alias("uom"),
        value.alias("value"))
    others = spark.range(0, 3_000, 1, 4).select(
        F.concat(F.lit("g"), i).alias("adsh"), F.lit("Assets"), F.lit("v1"), F.lit("20191231"),
        F.lit("0"), F.lit("USD"), i.cast("string"))
    sub = spark.range(3_000).select(
        *[{"adsh": F.concat(F.lit("g"), i), "cik": F.lit("c9"), "name": F.lit("Nine"),
           "period": F.lit("20200101"), "fy": F.lit("2020"), "fp": F.lit("FY"),
           "filed": F.lit("20200201")}.get(c, F.lit("x")).alias(c) for c in tiny["sub"].columns])
    pre = sub.select(*[{"adsh": F.col("adsh"), "stmt": F.lit("BS"), "tag": F.lit("Assets"), "report": F.lit("1"),
                        "line": F.lit("1")}.get(c, F.lit("x")).alias(c) for c in tiny["pre"].columns])
    return tiny | {
        "num": tiny["num"].union(num).union(others), "sub": tiny["sub"].union(sub),
        "pre": tiny["pre"].union(pre),
        "sym": tiny["sym"].union(frame(spark, "symbol string, cik string, ord int", ("nine", "c9", 1)))}


@pytest.fixture()
def small_partitions(spark):
    for key, value in SKEW_CONF.items():
        spark.conf.set(key, value)
    yield
    for key in SKEW_CONF:
        spark.conf.unset(key)


def executed_plan(df):
    df._jdf.collectToPython()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_filing_is_split_in_the_join(spark, skewed, small_partitions):
    facts = S.fct_financial_statements(skewed)
    assert "SortMergeJoin(skew=true)" in executed_plan(facts)
    data = P.financial_data(skewed)
    assert "SortMergeJoin(skew=true)" in executed_plan(data)


def test_skew_leaves_the_results_whole(spark, skewed, small_partitions):
    hot = P.financial_data(skewed).filter("symbol = 'ONE' AND concept = 'Assets'")
    assert hot.count() == 30_000 + 3
    assert P.financial_data(skewed).filter("symbol = 'NINE'").count() == 3_000
    facts = S.fct_financial_statements(skewed).filter(
        "company_symbol = 'c1' AND metric_code = 'Assets' AND metric_name = 'All assets'")
    assert facts.count() == 20_000 + 1  # 7 and 80 are among the 20,000 values, 100.5 is not
    metrics = S.company_metrics(skewed).filter("company_symbol = 'c1' AND fiscal_period = 'FY'").first()
    assert metrics["total_assets"] == 29_999


def test_a_hot_filing_is_one_document(skewed):
    docs = P.filing_documents(skewed).filter("adsh = 'f1'")
    assert [r["n"] for r in docs.select(F.size("data.bs").alias("n")).collect()] == [30_000 + 5]
    assert flatten_documents(docs, DOCUMENT_PARTS).filter("concept = 'Assets' AND value = 7").count() == 10_000 + 1


def test_hot_companies_are_counted_without_pairs(skewed):
    points = {r["name"]: r["data_points"] for r in N.data_points(skewed).collect()}
    assert points["Nine"] == 3_000 * 3_000
    row = N.balance_sheet_analysis(skewed).filter("symbol = 'NINE' AND value = 5").first()
    assert row["row_count"] == 3_000
