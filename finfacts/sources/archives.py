"""Quarterly archives: unpacking into period folders."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.sources.raw import period_of

LINES_PER_CHUNK = 50_000
LINE_SCHEMA = "period_folder string, member string, line_no long, value string"


def _lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of every archive member, in chunks; directory entries are skipped."""
    for frame in frames:
        for path, period, content in zip(frame["path"], frame["period_folder"], frame["content"]):
            try:
                archive = zipfile.ZipFile(io.BytesIO(content))
            except zipfile.BadZipFile as error:
                raise ValueError(f"invalid archive: {path}") from error
            for member in archive.infolist():
                if not member.is_dir():
                    with archive.open(member) as data:
                        yield from _chunks(period, member.filename, data)


def _chunks(period: str, member: str, data) -> Iterator[pd.DataFrame]:
    text = io.TextIOWrapper(data, encoding="utf-8", errors="replace", newline="\n")
    lines: list[str] = []
    done = 0
    for line in text:
        lines.append(line.rstrip("\n"))
        if len(lines) == LINES_PER_CHUNK:
            yield _chunk(period, member, done, lines)
            done += len(lines)
            lines = []
    if lines:
        yield _chunk(period, member, done, lines)


def _chunk(period: str, member: str, first: int, lines: list[str]) -> pd.DataFrame:
    return pd.DataFrame({
        "period_folder": period, "member": member,
        "line_no": range(first, first + len(lines)), "value": lines,
    })


def archive_lines(spark: SparkSession, src: str) -> DataFrame:
    """Numbered lines of all archive members under ``src``.

    An archive is one task, as its directory stands at its end; its lines leave
    the task in chunks. An invalid archive fails the job.
    """
    archives = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", True).load(src)
        .select("path", period_of(F.col("path")).alias("period_folder"), "content")
    )
    return archives.mapInPandas(_lines, LINE_SCHEMA)


def unpack_archives(spark: SparkSession, src: str, dst: str) -> None:
    """Write every archive member to ``period_folder=…/member=…`` under ``dst``.

    Lines keep their order, so the header stays first. Loaded again, a period
    replaces its earlier files and leaves other periods alone.
    """
    ordered = archive_lines(spark, src).sortWithinPartitions("period_folder", "member", "line_no")
    (
        ordered.drop("line_no").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("period_folder", "member").text(dst)
    )
