"""Raw tables bucketed by filing, so that joins on the filing need no shuffle of the values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finfacts.plans.statements import Tables
from finfacts.sources.sinks import save_bucketed

BY_FILING = ("sub", "num", "pre")


def store_by_filing(tables: Tables, prefix: str, root: str, buckets: int) -> None:
    """Save the raw tables as catalog tables ``{prefix}{name}`` under ``root``.

    ``sub``, ``num`` and ``pre`` are bucketed and sorted by filing, in as many files a task as
    there are buckets: choose them so that a bucket of ``num`` fits a task. The dictionaries
    are stored plainly.
    """
    for name, df in tables.items():
        if name in BY_FILING:
            # One task for each bucket, so a bucket is one file.
            save_bucketed(df.repartition(buckets, "adsh"), f"{prefix}{name}", ["adsh"], buckets, f"{root}/{name}")
        else:
            df.write.mode("overwrite").format("parquet").option("path", f"{root}/{name}").saveAsTable(
                f"{prefix}{name}")


def _session_without_all_keys(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` whose joins may be dealt out by some of their keys."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.get(key, None) != value:
            own.conf.set(key, value)
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return own


def tables_by_filing(spark: SparkSession, prefix: str, names: Tables | tuple[str, ...]) -> dict[str, DataFrame]:
    """The stored tables. Joins on filing and tag then keep the buckets of the filing.

    For that they come from a session of their own, which does not ask for all keys of a join to be
    dealt out by; joins of other tables in ``spark`` still do, so that a hot filing is split there.
    Temporary views of their results belong to that session too. A filing that outgrows a task
    should stay in the plain store.
    """
    own = _session_without_all_keys(spark)
    return {name: own.table(f"{prefix}{name}") for name in names}
