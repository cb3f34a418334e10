"""Joins of facts, filings, dictionaries and document tables.

No join here names a broadcast side unless its size is fixed or was checked;
everything else is left to Catalyst and AQE, which choose by run-time size and
split skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A checked side is broadcast up to both bounds; beyond them the join shuffles.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 64


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a narrow dimension: true if it stays within rows and bytes.

    The scan stops after ``max_rows + 1`` rows, so the check is bounded too.
    """
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns),
        F.lit(8 * len(df.columns)),
    )
    size = df.limit(max_rows + 1).agg(
        F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    return size["n"] <= max_rows and size["bytes"] <= max_bytes


def salted_join(
    left: DataFrame, right: DataFrame, key: str, salts: int = SALTS
) -> DataFrame:
    """Inner join that spreads every key of ``left`` over ``salts`` partitions.

    The salt depends on the row and on its input partition: different rows of a
    key and copies of a row both spread, and a task run again salts alike. Each
    right row is repeated once per salt.
    """
    salt = F.pmod(F.xxhash64(*left.columns) + F.spark_partition_id(), F.lit(salts)).cast("int")
    spread = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", salt).join(spread, [key, "_salt"]).drop("_salt")


def join_dimension(
    left: DataFrame, right: DataFrame, key: str,
    max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner join to a dictionary on a skewed key: broadcast if its checked size allows, else salted.

    Rows whose key ``left`` lacks go first, so neither the size of a broadcast nor the
    copies of the salted side grow with the part of the dictionary that is not used.
    """
    used = right.join(left.select(key).distinct(), key, "left_semi")
    if fits_broadcast(used, max_rows, max_bytes):
        return left.join(F.broadcast(used), key)
    return salted_join(left, used, key)


def join_filing(num: DataFrame, sub: DataFrame) -> DataFrame:
    """Facts to filings on ``adsh``."""
    return num.join(sub, "adsh")


def join_tag(num: DataFrame, tag: DataFrame) -> DataFrame:
    """Facts to the tag dictionary on ``tag`` only: each version of a tag gives a row."""
    labels = tag.select("tag", F.col("version").alias("tag_version"), "tlabel", "datatype")
    return join_dimension(num, labels, "tag")


def valid_companies(facts: DataFrame, sub: DataFrame) -> DataFrame:
    """Facts whose company occurs among the filings."""
    companies = sub.select(F.col("cik").alias("company_symbol")).distinct()
    return facts.join(companies, "company_symbol", "left_semi")


def first_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: Sequence[str]
) -> DataFrame:
    """One row per key: the values of the first row in ``order`` (NULLs first).

    Ties are broken by the values, so the result does not depend on row order.
    The minimum is combined before the shuffle: a hot key sends one row per task.
    """
    ranked = F.struct(
        *[c.alias(f"_o{i}") for i, c in enumerate(order)],
        *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)],
    )
    picked = df.groupBy(*keys).agg(F.min(ranked).alias("_first"))
    return picked.select(
        *keys, *[F.col(f"_first._v{i}").alias(v) for i, v in enumerate(values)]
    )


def lookup_tag_doc(tag: DataFrame) -> DataFrame:
    """First documentation text of each tag, by version."""
    return first_by(tag, ["tag"], [F.col("version")], ["doc"])


def lookup_presentation(pre: DataFrame) -> DataFrame:
    """First presentation row of each tag within a filing, by report and line."""
    order = [F.col("report").try_cast("int"), F.col("line").try_cast("int")]
    return first_by(pre, ["adsh", "tag"], order, ["plabel", "stmt"])


def lookup_symbol(sym: DataFrame) -> DataFrame:
    """First ticker of each company, in file order."""
    return first_by(sym, ["cik"], [F.col("ord")], ["symbol"])


def counted(df: DataFrame, columns: Sequence[str | Column], name: str = "row_count") -> DataFrame:
    """Distinct rows with the number of times each occurs."""
    return df.groupBy(*columns).agg(F.count("*").alias(name))


def counted_join(
    left: DataFrame, right: DataFrame, key: str, name: str = "row_count"
) -> DataFrame:
    """Join two counted inputs; ``name`` is how often the plain join repeats the row.

    Both sides hold distinct rows with a ``row_count``. The product replaces the
    pairs that a many-to-many join of the plain rows would emit.
    """
    l = left.withColumnRenamed("row_count", "_left")
    r = right.withColumnRenamed("row_count", "_right")
    joined = l.join(r, key).withColumn(name, F.col("_left") * F.col("_right"))
    return joined.drop("_left", "_right")


def expand_counted(df: DataFrame, name: str = "row_count") -> DataFrame:
    """Repeat each row ``name`` times: the plain form of a counted result.

    Works row by row after all shuffles and keeps the row order. Numbers are made in
    two steps of their square root, so no row holds an array of all its repeats.
    """
    columns = [c for c in df.columns if c != name]
    one, n = F.lit(1).cast("bigint"), F.col(name)
    side = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
    outer = df.filter(n > 0).withColumn("_side", side).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / F.col("_side")))))
    inner = F.least(F.col("_side"), n - F.col("_block") * F.col("_side"))
    return outer.select(*columns, F.explode(F.sequence(one, inner)).alias("_n")).drop("_n")


def join_doc_tables(
    meta: DataFrame, data: DataFrame, meta_columns: Sequence[str],
    data_columns: Sequence[str], expand: bool = False,
) -> DataFrame:
    """Metadata to data rows on ``symbol``: distinct result rows with their ``row_count``.

    Several filings of a company multiply its data rows; ``expand`` returns the
    multiplied rows themselves.
    """
    m = counted(meta, ["symbol", *meta_columns])
    d = counted(data, ["symbol", *data_columns])
    joined = counted_join(m, d, "symbol")
    return expand_counted(joined) if expand else joined


def orphans(data: DataFrame, meta: DataFrame) -> DataFrame:
    """Data rows whose symbol has no metadata row; a NULL symbol is an orphan."""
    return data.join(meta.select("symbol").distinct(), "symbol", "left_anti")


def count_orphans(data: DataFrame, meta: DataFrame) -> DataFrame:
    """Their number as ``record_count``; rows are counted per symbol before the join."""
    per_symbol = counted(data, ["symbol"])
    missing = orphans(per_symbol, meta)
    return missing.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("record_count"))
