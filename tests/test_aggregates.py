from decimal import Decimal

from pyspark.sql import functions as F

from conftest import frame, rows
from finfacts.operators import aggregates as D, quality as Q


def test_metric_stats(spark):
    df = frame(spark, "k string, value double", ("a", 1.5), ("a", None), ("a", -0.5), ("b", None))
    assert rows(D.metric_stats(df, ["k"])) == [("a", 0.5, 1.5, -0.5), ("b", None, None, None)]


def test_conditional_totals_default_to_zero(spark):
    df = frame(spark, "k string, t string, value double", ("a", "x", 1.25), ("a", "x", 2.0), ("b", "y", 7.0))
    assert rows(D.conditional_totals(df, ["k"], {"x": F.col("t") == "x"})) == [
        ("a", Decimal("3.2500")), ("b", Decimal("0.0000"))]


def test_invalid_periods_do_not_report_null(spark):
    df = frame(spark, "fiscal_period v", ("Q1", ""), ("H1", ""), ("H1", ""), (None, ""))
    assert rows(D.invalid_fiscal_periods(df)) == [("H1", 2)]


def test_load_counts(spark):
    meta = frame(spark, "symbol v", ("a", ""), ("a", ""), (None, ""))
    assert rows(D.load_counts(meta, meta.filter("false"))) == [
        ("Financial Data Count", 0, 0), ("Metadata Count", 3, 1)]


def test_table_counts(spark):
    one = frame(spark, "a b", ("1", "2"))
    assert rows(D.table_counts({"one": one, "none": one.filter("false")})) == [("none", 0), ("one", 1)]


def test_checks_share_one_pass(spark):
    df = frame(spark, "a string, n int", ("x", 1), ("", 5), (None, None), (" ", 9))
    report = Q.check_table(df, "t", [
        Q.not_null("a"), Q.not_null("a", F.col("n") > 1), Q.not_empty("a"),
        Q.accepted_values("a", ["x", ""]), Q.accepted_values("a", ["x"], F.col("a") != ""),
        Q.accepted_range("n", 1, 5), Q.expression_is_true("n", F.col("n") < 9, table="other")])
    assert [tuple(r) for r in report.collect()] == [
        ("not_null", "t", "a", 1), ("not_null", "t", "a", 0), ("not_empty", "t", "a", 2),
        ("accepted_values", "t", "a", 1), ("accepted_values", "t", "a", 1),
        ("accepted_range", "t", "n", 1), ("expression_is_true", "other", "n", 1)]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_checks_on_an_empty_table(spark):
    df = frame(spark, "a b", ("x", "y")).filter("false")
    assert Q.check_table(df, "t", [Q.not_null("a")]).first()["failures"] == 0
    assert Q.relationship(df, "a", df, "b", "t").first()["failures"] == 0
    assert Q.unique(df, "a", "t").first()["failures"] == 0


def test_relationship_and_unique(spark):
    child = frame(spark, "k v", ("a", ""), ("b", ""), ("b", ""), (None, ""))
    parent = frame(spark, "id v", ("a", ""), ("a", ""))
    assert Q.relationship(child, "k", parent, "id", "t").first()["failures"] == 2
    assert Q.unique(child, "k", "t").first()["failures"] == 1


def test_top_k_merges_sorted_heads(spark):
    df = spark.range(100)
    top = D.top_k(df, [F.col("id").desc()], 3)
    assert [r[0] for r in top.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
