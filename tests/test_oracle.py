"""Every registered query with check SQL against the check engine."""

import re

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def check():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n in entry.queries() if n in entry.oracle_sql()])
def test_query_equals_its_check(spark, check, name):
    got = entry.queries()[name](spark, SF_DIR)
    expected = check.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(expected.columns)
    order = [expected.columns.index(c) for c in sorted(expected.columns)]
    ours = sorted((repr(tuple(r)) for r in got.select(*[f"`{c}`" for c in sorted(got.columns)]).collect()))
    theirs = sorted(repr(tuple(r[i] for i in order)) for r in expected.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", [n for n in entry.queries() if n[:2] != "op" and n != "pipeline"])
def test_query_reads_given_files(spark, name):
    files = entry.queries()[name](spark, SF_DIR).inputFiles()
    assert files


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()


def test_names():
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names
    assert all(re.fullmatch(r"([abcdfghimnq]|op)\d+_[a-z_]+|pipeline", n) for n in names)
