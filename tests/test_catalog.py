import pytest
from pyspark.sql import functions as F

from conftest import rows
from finfacts.fixtures.tables import filing_tables
from finfacts.plans import catalog as N, filings as P, statements as S


@pytest.fixture(scope="module")
def tables(spark):
    return filing_tables(spark, "/root/testdata/sf0.001")


def test_expanded_rows_are_those_of_the_plain_join(tables):
    meta, data = P.financial_metadata(tables), P.financial_data(tables)
    plain = meta.join(data, "symbol")
    balance = plain.filter(F.col("data_type") == "bs").filter(F.col("concept").isin(*N.KEY_BALANCE_CONCEPTS))
    assert rows(N.balance_sheet_analysis(tables, expand=True)) == rows(
        balance.select("symbol", "name", "concept", "value"))
    cash = plain.filter("data_type = 'cf'").filter(F.col("concept").isin(*S.STATEMENT_TAGS["cash_flow"]))
    assert rows(N.cash_flow_metrics(tables, expand=True)) == rows(
        cash.select("symbol", "name", "concept", "value", "year", "quarter"))


def test_expanding_keeps_the_order(tables):
    keys = [(r["year"], r["quarter"]) for r in N.cash_flow_metrics(tables, expand=True).collect()]
    assert keys == sorted(keys, reverse=True)


def test_health_fan_out_equals_the_joined_sums(tables):
    b, c, i = (S.statement_table(tables, s) for s in ("balance_sheet", "cash_flow", "income_statement"))
    pick = lambda df, tag, name: df.select("symbol", F.when(F.col("concept") == tag, F.col("value")).otherwise(0.0).alias(name))
    joined = (
        b.select("symbol", *[F.when(F.col("concept") == t, F.col("value")).otherwise(0.0).alias(n)
                             for t, n in (("Assets", "total_assets"), ("Liabilities", "total_liabilities"))])
        .join(pick(c, N.OPERATING_CASH_FLOW, "operating_cash_flow"), "symbol", "left")
        .join(pick(i, N.REVENUE, "revenue"), "symbol", "left")
    )
    names = ("total_assets", "total_liabilities", "operating_cash_flow", "revenue")
    expected = joined.groupBy("symbol").agg(*[F.round(F.coalesce(F.sum(n), F.lit(0.0)), 2).alias(n) for n in names])
    got = N.health_indicators(tables, k=None).select("symbol", *[F.round(n, 2).alias(n) for n in names])
    assert rows(got) == rows(expected)


def test_totals_count_a_row_once_for_every_label(tables):
    again = tables["tag"].filter("tag = 'Assets'").withColumn("tlabel", F.lit("another label"))
    unnamed = tables["tag"].filter("tag = 'Liabilities'").withColumn("tlabel", F.lit(None).cast("string"))
    labelled = {**tables, "tag": tables["tag"].union(again).union(unnamed).union(unnamed)}
    wanted = {"balance_sheet": {"assets": "Assets", "liabilities": "Liabilities"}}
    value = lambda tag: F.sum(F.when(F.col("metric_code") == tag, F.col("metric_value")).otherwise(0))
    staged = S.staging(labelled, "balance_sheet").groupBy(F.col("company_symbol").alias("symbol")).agg(
        F.count("*").alias("n"), value("Assets").alias("assets"), value("Liabilities").alias("liabilities"))
    text = lambda df, *n: rows(df.select("symbol", *[F.col(c).cast("double") for c in (*n, "assets", "liabilities")]))
    assert text(N.statement_totals(labelled, wanted), "n_balance_sheet") == text(staged, "n")
    assert text(N.statement_totals(labelled, wanted), "n_balance_sheet") != text(
        N.statement_totals(tables, wanted), "n_balance_sheet")


def test_named_queries(tables):
    assert set(N.QUERIES) and N.named_query("top_companies")(tables, k=3).count() == 3
    with pytest.raises(KeyError):
        N.named_query("none")


def test_ad_hoc_sql(spark, tables):
    got = N.run_sql(spark, tables, "SELECT count(*) AS n FROM sub")
    assert got.columns == ["n"] and got.first()["n"] == tables["sub"].count()


def test_tag_usage_counts_before_joining(tables):
    plan = N.tag_usage(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate")
