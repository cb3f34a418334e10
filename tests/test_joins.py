from pyspark.sql import functions as F

from conftest import frame, rows
from finfacts.operators import joins as C


def hot(spark):
    """Facts of which a third share one key."""
    return spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("tag"),
        F.col("id").alias("v"))


def test_salted_join_equals_plain_join(spark):
    right = frame(spark, "tag label", ("hot", "a"), ("hot", "b"), ("k1", "c"), ("none", "d"))
    expected = rows(hot(spark).join(right, "tag"))
    assert rows(C.salted_join(hot(spark), right, "tag", salts=5)) == expected
    assert rows(C.join_dimension(hot(spark), right, "tag")) == expected
    assert rows(C.join_dimension(hot(spark), right, "tag", max_rows=2)) == expected


def test_salted_join_spreads_a_hot_key(spark):
    right = frame(spark, "tag label", ("hot", "a"))
    joined = C.salted_join(hot(spark).repartition(3), right, "tag", salts=8)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    copies = spark.range(0, 400, 1, 8).select(F.lit("hot").alias("tag"), F.lit(1).alias("v"))
    salt = F.pmod(F.xxhash64("tag", "v") + F.spark_partition_id(), F.lit(8))
    sizes = copies.groupBy(salt.alias("s")).count()
    assert sizes.count() == 8 and sizes.agg(F.max("count")).first()[0] == 50
    assert C.salted_join(copies, right, "tag", salts=8).count() == 400


def test_broadcast_check_measures_rows_and_bytes(spark):
    small = frame(spark, "tag label", ("a", "x" * 50), ("b", None))
    assert C.fits_broadcast(small)
    assert not C.fits_broadcast(small, max_rows=1)
    assert not C.fits_broadcast(small, max_bytes=60)
    assert C.fits_broadcast(small.filter("false"), max_rows=0)


def test_unused_rows_of_a_dictionary_do_not_count(spark):
    unused = spark.range(5_000).select(F.concat(F.lit("own"), "id").alias("tag"), F.lit("x").alias("label"))
    right = unused.union(frame(spark, "tag label", ("hot", "a"), ("hot", "b"), ("k1", "c"), (None, "d")))
    joined = C.join_dimension(hot(spark), right, "tag", max_rows=10)
    assert "_salt" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert rows(joined) == rows(hot(spark).join(right, "tag"))
    salted = C.join_dimension(hot(spark), right, "tag", max_rows=2)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert rows(salted) == rows(hot(spark).join(right, "tag"))


def test_join_tag_ignores_the_version(tiny):
    joined = C.join_tag(tiny["num"].select("adsh", "tag", "value"), tiny["tag"])
    assert joined.filter("adsh = 'f3'").count() == 3
    assert joined.filter("tag = 'Unknown'").isEmpty()


def test_first_match_lookups(tiny):
    docs = dict(rows(C.lookup_tag_doc(tiny["tag"])))
    assert docs["Assets"] == "First\r\ndoc" and docs["StockholdersEquity"] is None
    shown = C.lookup_presentation(tiny["pre"]).filter("adsh = 'f1' AND tag = 'Assets'").first()
    assert (shown["plabel"], shown["stmt"]) == ('The "assets"', "BS")
    assert dict(rows(C.lookup_symbol(tiny["sym"])))["c1"] == " one "


def test_first_by_orders_nulls_first(spark):
    df = frame(spark, "k o v", ("a", "2", "x"), ("a", None, "y"), ("b", "1", "q"), ("b", "1", "p"))
    assert rows(C.first_by(df, ["k"], [F.col("o")], ["v"])) == [("a", "y"), ("b", "p")]


def test_valid_companies(spark, tiny):
    facts = frame(spark, "company_symbol v", ("c1", "1"), ("c1", "1"), ("zz", "2"), (None, "3"))
    assert rows(C.valid_companies(facts, tiny["sub"])) == [("c1", "1"), ("c1", "1")]


def test_document_join_counts_what_the_plain_join_repeats(spark):
    meta = frame(spark, "symbol name year", ("a", "A", "1"), ("a", "A", "2"), ("a", "B", "2"), ("b", "C", "1"))
    data = frame(spark, "symbol concept", ("a", "x"), ("a", "x"), ("a", "y"), ("c", "z"))
    plain = meta.join(data, "symbol").select("symbol", "name", "concept")
    assert rows(C.join_doc_tables(meta, data, ["name"], ["concept"], expand=True)) == rows(plain)
    counted = C.join_doc_tables(meta, data, ["name"], ["concept"])
    assert rows(counted.select("symbol", "name", "concept", "row_count")) == rows(
        plain.groupBy("symbol", "name", "concept").count())


def test_orphans(spark):
    data = frame(spark, "symbol v", ("a", "1"), ("b", "2"), (None, "3"))
    meta = frame(spark, "symbol name", ("a", "A"), ("a", "A"))
    assert rows(C.orphans(data, meta)) == [("b", "2"), (None, "3")]
    assert rows(C.count_orphans(data, meta)) == [(2,)]
    assert rows(C.count_orphans(meta, meta)) == [(0,)]


def test_bucketed_tables_join_without_shuffle(spark, tiny, tmp_path):
    from finfacts.sources.sinks import save_bucketed

    for name in ("num", "sub"):
        save_bucketed(tiny[name], f"bucketed_{name}", ["adsh"], 4, str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = C.join_filing(spark.table("bucketed_num"), spark.table("bucketed_sub"))
        assert rows(joined.select("adsh", "value")) == rows(
            C.join_filing(tiny["num"], tiny["sub"]).select("adsh", "value"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("num", "sub"):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")
