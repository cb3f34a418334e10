"""SimHash near-dedup with vantage-point trees.

Texts become 64-bit fingerprints. A bounded sample of the distinct fingerprints gives
the upper part of a vantage-point tree, whose leaves are shards. A fingerprint is at home
in one shard and visits every earlier shard that the triangle inequality cannot rule out
within the radius. A shard's points at home and its visitors are cut into blocks of bounded
size; every block at home meets every block of either kind in a task of its own, which
grows a tree below that and searches it. It reports a spanning forest of its links, not
the pairs, and the forests are joined into components by rounds of distributed star
contraction.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from finfacts.llm.common import Batches, Mapper, content_key, nested, stored, table, texts, unnested
from finfacts.llm.components import connected_components
from finfacts.llm.shingle_sets import shingle_hashes, similar_components
from finfacts.llm.vantage_tree import SAMPLE, SAMPLED, Tree, meetings, search

# Fingerprints at home in a shard, and points of a block.
SHARD = 20_000
BLOCK = 4_096


def fingerprint(text: bytes, size: int) -> int:
    """The fingerprint as a signed number; zero without words."""
    ones, total = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text, size):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(h)
    packed = np.packbits(2 * ones > total, bitorder="little").tobytes()
    return int.from_bytes(packed, "little", signed=True)


def _fingerprints(size: int) -> Mapper:
    def run(batches: Batches) -> Batches:
        for b in batches:
            own = [fingerprint(t, size) for t in texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("k1"), b.column("k2"), b.column("doc_id"), pa.array(own, pa.int64())],
                names=["k1", "k2", "doc_id", "fp"],
            )
    return run


def _route(tree: Tree, depth: int, radius: int) -> Mapper:
    """A row at home, and one for every earlier shard visited."""
    def run(batches: Batches) -> Batches:
        for b in batches:
            fps = b.column("fp").to_numpy().view(np.uint64)
            home = tree.home(fps, depth)
            at, node = tree.visits(fps, depth, radius)
            earlier = node < home[at]
            for rows, shard, is_home in (
                (np.arange(len(fps)), home, True), (at[earlier], node[earlier], False),
            ):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), b.column("fp").take(pa.array(rows)),
                     pa.array(np.full(len(rows), is_home), pa.bool_())],
                    names=["shard", "fp", "home"],
                )
    return run


class _Forest:
    """Links between places, kept as a forest."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        up = self.parent[at]
        while True:
            more = self.parent[up]
            if np.array_equal(more, up):
                return up
            up = more

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        pairs = np.unique(np.stack([self.roots(i), self.roots(j)], 1), axis=0)
        for a, b in pairs.tolist():
            while self.parent[a] != a:
                a = self.parent[a]
            while self.parent[b] != b:
                b = self.parent[b]
            if a != b:
                self.parent[max(a, b)] = min(a, b)


def _block_links(radius: int):
    """Links of a block at home with itself, or with the other block that it meets."""
    def run(key: tuple, met: pa.Table) -> pa.Table:
        signed = met.column("fp").to_numpy()
        fps, first = signed.view(np.uint64), met.column("first").to_numpy(zero_copy_only=False)
        forest = _Forest(len(fps))

        def found(i: np.ndarray, j: np.ndarray) -> None:
            for a in range(0, len(i), 20_000):
                forest.link(i[a:a + 20_000], j[a:a + 20_000])

        # Two blocks look for pairs across only; the first one is the tree.
        search(fps, first, radius, found)
        root = forest.roots(np.arange(len(fps)))
        linked = np.flatnonzero(root != np.arange(len(fps)))
        return pa.table({"a": signed[linked], "b": signed[root[linked]]})
    return run


def fingerprint_links(points: DataFrame, radius: int) -> DataFrame:
    """A spanning set of links between the distinct fingerprints in ``points`` (fp)."""
    n = points.count()
    depth = min(max(0, math.ceil(math.log2(max(n, 1) / SHARD))), int(math.log2(SAMPLE // SAMPLED)))
    sample = points.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLED << depth).toPandas()["fp"]
    tree = Tree(sample.to_numpy(dtype=np.int64).view(np.uint64), depth)
    routed = stored(points.select("fp").mapInArrow(
        _route(tree, depth, radius), "shard int, fp long, home boolean"))
    met = meetings(routed, ["shard"], BLOCK)
    return met.groupBy("shard", "left", "right").applyInArrow(_block_links(radius), "a long, b long")


def near_components(
    docs: DataFrame, size: int = 5, radius: int = 12, min_similarity: float | None = 0.8,
    id_column: str = "doc_id",
) -> DataFrame:
    """One row per row of ``docs``: content key, ``doc_id``, ``fp``, ``component`` (an ``fp``).

    Texts are lower-cased (A-Z); shingles are ``size`` words, a shorter text is one
    shingle. With a minimum similarity, texts link if the Jaccard similarity of their
    shingle sets reaches it, ``fp`` stands for the set and ``radius`` plays no part.
    Without one, they link if their fingerprints differ in at most ``radius`` bits; a
    text without words has fingerprint zero. Equal ``fp`` always link. Ids are integers.
    """
    if min_similarity is not None:
        return similar_components(docs, size, min_similarity, id_column)
    k1, k2 = content_key(F.col(f"`{id_column}`"), F.col("`text`"))
    keyed = docs.select(F.col("`text`").cast("binary").alias("text"), k1, k2,
                        F.col(f"`{id_column}`").cast("long").alias("doc_id"))
    prints = stored(keyed.mapInArrow(
        _fingerprints(size), "k1 long, k2 long, doc_id long, fp long"))
    points = stored(prints.select("fp").distinct())
    parts = connected_components(fingerprint_links(points, radius))
    labels = parts.select(F.col("node").alias("fp"), "component")
    return prints.join(labels, "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )


def hex_fingerprint(fp: Column) -> Column:
    """Sixteen lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def dedup_near(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of every group of near copies: the smallest id (nulls last).

    Options are those of ``near_components``. Of rows with equal id and text the first by a
    hash of their columns stays. A null text has no words; all texts without words are one
    group. An empty table gives an empty table.
    """
    members = near_components(docs, id_column=id_column, **options)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")
    winners = members.groupBy("component").agg(F.min(order).alias("w")).select("w.k1", "w.k2")
    key = content_key(F.col(f"`{id_column}`"), F.col("`text`"))
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    rows = nested(docs, *key, F.xxhash64(*plain).alias("order"))
    keep = rows.join(winners, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(
        F.min_by("row", "order").alias("row"))
    return unnested(keep, docs.columns)


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: three words, two differing bits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    members = near_components(docs, size=3, radius=2, min_similarity=None)
    least = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return members.join(least, "component").select(
        "doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id"
    )
