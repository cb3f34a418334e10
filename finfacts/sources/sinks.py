"""Materialization of models, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside gives its shuffle files back as it ends.

    Else they stay until the driver happens to collect its garbage, and those of
    all steps of a job lie on the disks together.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def save_model(
    df: DataFrame, target: str, materialized: str = "table",
    partition_by: Sequence[str] = (), mode: str = "period", rebalance: bool = True,
    compression: str | None = None,
) -> None:
    """Materialize a model: a temporary view named ``target``, or Parquet under that path.

    A partitioned table replaces the partitions it writes; ``mode='replace'``
    replaces the whole table. Rows are rebalanced by partition before they are
    written: small partitions share a task, a large one is split. A few partitions
    that all tasks share evenly can do without, and without another shuffle.
    ``compression`` names a codec other than the session's.
    """
    if materialized == "view":
        df.createOrReplaceTempView(target)
        return
    if materialized != "table" or mode not in ("period", "replace"):
        raise ValueError("materialized is 'table' or 'view', mode is 'period' or 'replace'")
    overwrite = "dynamic" if partition_by and mode == "period" else "static"
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression is not None:
        writer = writer.option("compression", compression)
    with shuffles_freed(df.sparkSession):
        writer.parquet(target)


def save_bucketed(
    df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None
) -> None:
    """Save a catalog table bucketed and sorted by its join keys.

    Tables with equal buckets join on these keys without a shuffle.
    """
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def replace_view(df: DataFrame, name: str, root: str) -> str:
    """Replace what readers see under ``name`` without a moment in which it is gone.

    The rows are written to a new folder under ``root`` and the catalog's view ``name`` then
    points at it. A write that fails leaves the view as it was; readers that began
    before go on with the old folder, and columns may change. ``df`` may read the view itself.
    Returns the folder; older ones stay until ``remove_folder``.
    """
    folder = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")
    return folder


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder and all in it, in whatever store it lies; false if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


# Scratch folders of this process that remove_scratch has not removed yet.
_SCRATCH: list[str] = []


def remove_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders made so far; returns their number.

    To be called when no DataFrame that may read them is needed any more.
    """
    gone = 0
    while _SCRATCH:
        gone += remove_folder(spark, _SCRATCH.pop())
    return gone


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared place the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without that setting: its folder is then a temporary one.
    It stays until ``remove_scratch``, as lazy results may read it at any time.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="finfacts-")
    _SCRATCH.append(f"{shared.rstrip('/')}/finfacts-{uuid.uuid4().hex}")
    return _SCRATCH[-1]
