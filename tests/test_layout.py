"""Tables laid out by two keys: ranks, interleaved bits, row groups that a filter leaves."""

import bisect
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from finfacts.fixtures.tables import filing_tables
from finfacts.sources.layout import files_hit, interleaved, key_bounds, range_rank, store_by_keys

SF = "/root/testdata/sf0.01"


def row_groups(path, column, value):
    """Row groups of all files, and those whose range of a column holds a value."""
    every = hit = 0
    for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            every += 1
            hit += stats.min <= value <= stats.max
    return every, hit


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_ranks_are_those_of_a_binary_search(spark):
    bounds = ["b", "d", "d", "f", "é"]
    values = ["", "a", "b", "c", "d", "e", "f", "z", "é", "ö", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r["v"]: r["n"] for r in df.select("v", range_rank(F.col("v"), bounds, 3).alias("n")).collect()}
    assert got == {v: 0 if v is None else bisect.bisect_right(bounds, v) for v in values}
    assert df.select(range_rank(F.col("v"), [], 3).alias("n")).distinct().collect() == [(0,)]


def test_interleaved_bits(spark):
    df = spark.range(64).select((F.col("id") % 8).cast("int").alias("a"), (F.col("id") / 8).cast("int").alias("b"))
    for a, b, z in df.select("a", "b", interleaved([F.col("a"), F.col("b")], 3)).collect():
        assert z == int("".join(x + y for x, y in zip(f"{a:03b}", f"{b:03b}")), 2)
    with pytest.raises(ValueError):
        interleaved([F.lit(1)] * 8, 8)


def test_bounds_are_bounded_and_a_hot_value_is_one_of_them(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    bounds, = key_bounds(df, ["k"], 4)
    assert bounds == sorted(bounds) and len(bounds) == 15 and 9 <= bounds.count("hot") <= 11
    assert key_bounds(df.filter("false"), ["k"], 4) == [[]]


def test_filters_on_either_key_skip_row_groups(spark, tmp_path):
    num = filing_tables(spark, SF)["num"]
    two, one = str(tmp_path / "two"), str(tmp_path / "one")
    filings = sorted(r[0] for r in num.select("adsh").distinct().collect())
    filing = filings[len(filings) // 2]
    store_by_keys(num, two, files=16)
    num.repartitionByRange(16, "tag", "adsh").sortWithinPartitions("tag", "adsh").write.parquet(one)
    assert same(spark.read.parquet(two), num)
    every, by_tag = row_groups(two, "tag", "Assets")
    _, by_filing = row_groups(two, "adsh", filing)
    assert every == 16 and max(by_tag, by_filing) <= every // 2
    # Sorted by tag alone every tag begins anew with the first filing.
    assert row_groups(one, "adsh", filing)[1] > by_filing
    assert tuple(files_hit(spark, two, "tag = 'Assets'").first()) <= (16, by_tag)


def test_periods_nulls_hot_keys_and_clashing_names(spark, tmp_path):
    rows = [("t" if i % 3 else None, f"f{i % 50:02d}" if i % 7 else None, i, f"q{i % 2}") for i in range(600)]
    df = spark.createDataFrame(rows * 2, "tag string, adsh string, row int, z string")
    path = str(tmp_path / "t")
    store_by_keys(df, path, files=4, partition_by=["z"])
    assert same(spark.read.parquet(path).select(*df.columns), df)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/z=*/*.parquet")]
    assert max(sizes) <= 500
    # Another period leaves the stored ones as they are.
    store_by_keys(df.limit(5).withColumn("z", F.lit("q9")), path, files=1, partition_by=["z"])
    assert spark.read.parquet(path).count() == 1205
    store_by_keys(df.filter("false"), str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
