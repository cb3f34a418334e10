"""Embedding near-dedup: sign hashing in several tables, exact cosines, components.

Equal vectors of a label are one class. Every table hashes a class to the signs of its
products with random hyperplanes; classes that share a code in a table are compared. A
bucket is cut into blocks of bounded size and every pair of blocks is a task of its own,
so that a large bucket spreads. Two classes that share codes in several tables are
compared in the first of them only, so links can be counted without listing them; a task
returns sums per class and a spanning forest.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from finfacts.llm.common import Batches, Mapper, stored, table
from finfacts.llm.components import connected_components
from finfacts.llm.simhash_dedup import _Forest

SEED = 7
# Share of the pairs exactly at the least cosine that some table must bring together.
RECALL = 0.999
# Classes of a bucket that are held and compared at once.
BLOCK = 1024
# Blocks of a dimension's rows multiplied at once.
ROWS = 256


def bits_for(classes: int) -> int:
    """Hyperplanes of a table: a few classes a code if directions were uniform."""
    return min(30, max(8, math.ceil(math.log2(max(classes, 1))) - 2))


def tables_for(bits: int, min_cosine: float, recall: float = RECALL) -> int:
    """Tables that bring a pair at ``min_cosine`` together with probability ``recall``."""
    together = (1 - math.acos(min_cosine) / math.pi) ** bits
    return math.ceil(math.log(1 - recall) / math.log(1 - together))


def valid(vector: Column) -> Column:
    """True for vectors with a direction: no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(
        vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal dimension, scaled to length one in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _codes(bits: int, tables: int) -> Mapper:
    """Codes of a class in all tables."""
    def run(batches: Batches) -> Batches:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for b in batches:
            sizes = b.column("dim").to_numpy()
            codes = np.zeros((len(sizes), tables), np.int64)
            for dim in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dim)
                if dim not in planes:
                    planes[dim] = np.random.default_rng([SEED, dim]).standard_normal((dim, bits * tables))
                signs = _matrix(b.column("vector").take(pa.array(own))) @ planes[dim] > 0
                codes[own] = signs.reshape(len(own), tables, bits) @ weights
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, codes.size + 1, tables), pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column("cid"), b.column("label"), b.column("dim"), lists],
                names=["cid", "label", "dim", "codes"],
            )
    return run


def _compare(min_cosine: float):
    """Links of a pair of blocks: counts of vectors, and a forest of classes."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        cid, copies = rows.column("cid").to_numpy(), rows.column("copies").to_numpy()
        column = lambda n: rows.column(n).chunk(0)
        vectors = _matrix(column("vector"))
        codes = column("codes").flatten().to_numpy().reshape(len(cid), -1)
        level = int(rows.column("tab")[0].as_py())
        left, right = rows.column("left")[0].as_py(), rows.column("right")[0].as_py()
        block = rows.column("block").to_numpy()
        a, b = np.flatnonzero(block == left), np.flatnonzero(block == right)
        links, forest = np.zeros(len(cid), np.int64), _Forest(len(cid))
        for at in range(0, len(a), ROWS):
            some = a[at:at + ROWS]
            i, j = np.nonzero(vectors[some] @ vectors[b].T >= min_cosine - 1e-9)
            i, j = some[i], b[j]
            if left == right:
                i, j = i[cid[i] < cid[j]], j[cid[i] < cid[j]]
            for start in range(0, len(i), 20_000):
                x, y = i[start:start + 20_000], j[start:start + 20_000]
                exact = (vectors[x] * vectors[y]).sum(axis=1) >= min_cosine
                earlier = (codes[x, :level] == codes[y, :level]).any(axis=1)
                x, y = x[exact & ~earlier], y[exact & ~earlier]
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                forest.link(x, y)
        root = forest.roots(np.arange(len(cid)))
        out = np.flatnonzero(links > 0)
        return pa.table({"cid": cid[out], "links": links[out], "root": cid[root[out]]})
    return run


def class_links(classes: DataFrame, min_cosine: float) -> DataFrame:
    """Partial counts of linked vectors per class, with the root of its forest in that task.

    ``classes``: cid, label, dim, vector, copies.
    """
    n = classes.count()
    bits = bits_for(n)
    tables = tables_for(bits, min_cosine)
    coded = classes.select("cid", "label", "dim", "vector").mapInArrow(
        _codes(bits, tables), "cid long, label long, dim int, codes array<long>")
    coded = stored(coded)
    entries = coded.select("cid", "label", "dim", F.posexplode("codes").alias("tab", "code"))
    sizes = entries.groupBy("label", "dim", "tab", "code").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    busy = entries.join(
        sizes.select("label", "dim", "tab", "code", blocks.alias("blocks")), ["label", "dim", "tab", "code"])
    # A class stands in one block of its bucket and meets all blocks, itself in one pair.
    block = F.pmod(F.xxhash64("cid"), F.col("blocks").cast("long")).cast("int")
    paired = busy.withColumn("block", block).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    keyed = paired.select(
        "cid", "label", "dim", "tab", "code", "block",
        F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    rows = keyed.join(coded.select("cid", "codes"), "cid").join(
        classes.select("cid", "vector", "copies"), "cid")
    return rows.groupBy("label", "dim", "tab", "code", "left", "right").applyInArrow(
        _compare(min_cosine), "cid long, links long, root long")


def link_embeddings(vectors: DataFrame, min_cosine: float = 0.98) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vectors``.

    Rows link if their labels are equal and not null and their cosine, in double
    precision, is at least ``min_cosine``. Null or zero vectors, and those with null or
    non-finite components, link with nothing, as do vectors of different dimension. Every
    row is a vector of its own, so equal rows link with each other; of several rows with
    the smallest id of a component all are kept. A null id is never a component's id if it
    has another. Other columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").alias("vector"))
    fit = valid(F.col("vector")) & F.col("label").isNotNull()
    good = rows.filter(fit)
    grouped = good.groupBy("label", "vector").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = stored(grouped.select(
        "label", F.size("vector").alias("dim"), "vector", "copies", "least", *_keys()
    ).withColumn("cid", F.monotonically_increasing_id()))
    parts = stored(class_links(classes.select("cid", "label", "dim", "vector", "copies"), min_cosine))
    groups = connected_components(parts.select("cid", "root"))
    counts = parts.groupBy("cid").agg(F.sum("links").alias("links"))
    labelled = classes.select("cid", "copies", "least", "k1", "k2").join(counts, "cid", "left").join(
        groups.withColumnRenamed("node", "cid"), "cid", "left"
    ).withColumn("component", F.coalesce("component", "cid"))
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    result = labelled.join(smallest, "component").select(
        "k1", "k2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked = good.select("vec_id", *_keys()).join(result, ["k1", "k2"]).select(
        "vec_id", "n_links", "component_id")
    alone = rows.filter(~fit).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = linked.unionByName(alone)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _keys() -> tuple[Column, Column]:
    """Two hashes of label and vector; a zero hashes alike with either sign."""
    plain = F.transform("vector", lambda x: F.when(x == 0, F.lit(0).cast("double")).otherwise(x.cast("double")))
    return F.xxhash64("label", plain).alias("k1"), F.xxhash64(F.lit(7), "label", plain).alias("k2")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at a cosine of 0.98."""
    return link_embeddings(table(spark, sf_dir, "embeddings"), 0.98)
