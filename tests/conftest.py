import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "4000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


ARROW = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}


def frame(spark, schema, *values):
    """Small DataFrame; the schema is 'a b c' for text columns or 'a string, b int'."""
    fields = schema.split(", ") if "," in schema else [f"{c} string" for c in schema.split()]
    names, kinds = zip(*(f.split() for f in fields))
    columns = zip(*values) if values else [[] for _ in names]
    table = pa.table({
        n: pa.array(list(c), ARROW[k]) for n, k, c in zip(names, kinds, columns)
    })
    return spark.createDataFrame(table)


def rows(df):
    """Rows in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def tiny(spark):
    """Raw tables small enough to check by hand."""
    sub = frame(
        spark, "adsh cik name countryma cityma form period fy fp filed",
        ("f1", "c1", "One", "US", "Rome", "10-K", "20200101", "2020", "FY", "20200201"),
        ("f2", "c1", "One", "US", "Rome", "10-Q", "20200401", "2020", " q2 ", "20200501"),
        ("f3", "c2", "Two", None, "Oslo", "10-Q", "20200131", None, "Q1", "20200301"),
        ("f4", "c3", "Three", "SE", "Lund", "8-K", "bad", "2020", "Q1", "20200601"),
        ("f5", "c4", "Four", "SE", "Lund", "8-K", "20200101", "20x0", "Q1", "20200602"),
        ("f6", "c5", "Five", "SE", "Lund", "8-K", "20200101", "2020", "second", "20200603"),
        ("f7", "c6", "Six", "SE", "Lund", "8-K", "20200101", "2020", "H1", "20200604"),
        ("f8", "c7", "Seven", "SE", "Lund", "8-K", "20200101", "2020", "T2", "20200605"),
        ("f9", None, "None", "SE", "Lund", "8-K", "20200101", "2020", "FY", "20200606"),
    )
    num = frame(
        spark, "adsh tag version ddate qtrs uom value",
        ("f1", "Assets", "v1", "20191231", "0", "USD", "100.5"),
        ("f1", "Assets", "v1", "20181231", "0", " usd ", "100.50"),
        ("f1", "Assets", "v1", "20181231", "0", "USD", "80"),
        ("f1", "Liabilities", "v1", "20191231", "0", "EUR", "-3.9"),
        ("f1", "StockholdersEquity", "v1", "20191231", "0", "USD", "40"),
        ("f1", "Revenues", "v1", "20191231", "4", "USD", "200"),
        ("f1", "CostOfRevenue", "v1", "20191231", "4", "USD", "150"),
        ("f1", "NetCashProvidedByUsedInOperatingActivities", "v1", "20191231", "4", "USD", "7"),
        ("f2", "Assets", "v1", "20200331", "0", "USD", "n/a"),
        ("f2", "Assets", "v1", "20200331", "0", "USD", None),
        ("f2", "Inventory", "v1", "20200331", "0", "pct", "5"),
        ("f2", "Unknown", "v1", "20200331", "0", "USD", "5"),
        ("f3", "Assets", "v1", "20200331", "0", "USD", "9"),
        ("f4", "Assets", "v1", "20200331", "0", "USD", "9"),
        ("f9", "Assets", "v1", "20200331", "0", "USD", "9"),
        ("gone", "Assets", "v1", "20200331", "0", "USD", "9"),
    )
    tag = frame(
        spark, "tag version custom abstract datatype iord crdr tlabel doc",
        ("Assets", "v1", "0", "0", "monetary", "I", "D", "Total assets", "First\r\ndoc"),
        ("Assets", "v2", "0", "0", "monetary", "I", "D", "Total assets", "Second doc"),
        ("Assets", "v3", "0", "0", "monetary", "I", "D", "All assets", "Third doc"),
        ("Liabilities", "v1", "0", "0", "monetary", "I", "C", "Debts", "Debts doc"),
        ("StockholdersEquity", "v1", "0", "0", "monetary", "I", "C", "Equity", None),
        ("Revenues", "v1", "0", "0", "monetary", "D", "C", "Revenue", "Revenue doc"),
        ("CostOfRevenue", "v1", "0", "0", "monetary", "D", "D", "Cost", "Cost doc"),
        ("Inventory", "v1", "0", "0", "monetary", "I", "D", "Stock", "Stock doc"),
        ("NetCashProvidedByUsedInOperatingActivities", "v1", "0", "0", "monetary", "D", "D",
         "Operating cash", "Cash doc"),
    )
    pre = frame(
        spark, "adsh report line stmt inpth rfile tag version plabel negating",
        ("f1", "10", "1", "IS", "0", "H", "Assets", "v1", "Late row", "0"),
        ("f1", "2", "1", "BS", "0", "H", "Assets", "v1", 'The "assets"', "0"),
        ("f1", "2", "2", "BS", "0", "H", "Liabilities", "v1", "Debt", "0"),
        ("f1", "2", "3", "BS", "0", "H", "StockholdersEquity", "v1", "Equity", "0"),
        ("f1", "4", "1", "IS", "0", "H", "Revenues", "v1", "Revenue", "0"),
        ("f1", "4", "2", "IC", "0", "H", "CostOfRevenue", "v1", "Cost", "0"),
        ("f1", "5", "1", "CF", "0", "H", "NetCashProvidedByUsedInOperatingActivities", "v1", "Cash", "0"),
        ("f2", "2", "1", "BS", "0", "H", "Unknown", "v1", "Unknown", "0"),
        ("f2", "2", "1", "BS", "0", "H", "Inventory", "v1", "Stock", "0"),
    )
    sym = frame(
        spark, "symbol string, cik string, ord int",
        (" one ", "c1", 1), ("uno", "c1", 2), ("two", "c2", 1), ("x" * 20, "c6", 1),
        ("  ", "c7", 1), ("five", "c5", 1), ("four", "c4", 1), ("three", "c3", 1),
    )
    return {"sub": sub, "num": num, "tag": tag, "pre": pre, "sym": sym}
