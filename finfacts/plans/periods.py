"""Company metrics that follow a new period without reading the others again.

Every period leaves the maximum of each statement tag per company and filing period, and
the statement tags its dictionary knows. The mart merges these small tables: a maximum of
maxima is the maximum over all raw rows. Tags are checked when they are merged, as a
later dictionary may bring a tag that earlier values use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.operators.aggregates import with_ratios
from finfacts.plans.statements import METRIC_KEYS, Tables, known_tags, metric_maxima, statement_tags
from finfacts.schema import METRIC_COLUMNS, STATEMENT_TAGS
from finfacts.sources.sinks import save_model

# A column for every statement tag, those of the metrics under their names.
_TAGS = {tag: name for name, tag in METRIC_COLUMNS.items()}
TAG_COLUMNS = {_TAGS.get(t, f"tag_{t}"): t for t in statement_tags(tuple(STATEMENT_TAGS))}


def period_maxima(tables: Tables) -> DataFrame:
    """Maximum of every statement tag per company and filing period, of the tables of one period."""
    return metric_maxima(tables, TAG_COLUMNS, known_only=False)


def add_period(tables: Tables, store: str, period: str) -> None:
    """Take the raw tables of one period into ``store``; a period loaded again replaces itself."""
    for name, rows in (("maxima", period_maxima(tables)), ("known_tags", known_tags(tables["tag"]))):
        save_model(rows.withColumn("period_folder", F.lit(period)), f"{store}/{name}",
                   partition_by=["period_folder"])


def company_metrics_of_periods(spark: SparkSession, store: str) -> DataFrame:
    """Twelve metrics and eight ratios per company and period, out of what all periods left."""
    # At most one row for each statement tag.
    known = {r["tag"] for r in spark.read.parquet(f"{store}/known_tags").select("tag").distinct().collect()}
    merged = spark.read.parquet(f"{store}/maxima").groupBy(*METRIC_KEYS).agg(*[
        (F.max(name) if tag in known else F.max(F.lit(None).cast("decimal(38,4)"))).alias(name)
        for name, tag in TAG_COLUMNS.items()
    ])
    reported = merged.filter(F.coalesce(*TAG_COLUMNS).isNotNull())
    return with_ratios(reported.select(*METRIC_KEYS, *METRIC_COLUMNS))
