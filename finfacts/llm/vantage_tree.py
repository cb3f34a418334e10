"""Vantage-point trees over fingerprints: shards of a table, blocks that meet, search in a task.

Fingerprints are 64-bit numbers, or wider ones whose words lie along the first axis.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

# Points that are searched without further splits.
LEAF = 128
# Bound of the driver's sample, of which each shard of the tree it gives needs some.
SAMPLE = 1 << 20
SAMPLED = 64


def _wide(fps: np.ndarray) -> np.ndarray:
    return fps[None] if fps.ndim == 1 else fps


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits, fewer than 256; the words lie along the first axis."""
    d = np.bitwise_count(a[0] ^ b[0])
    for x, y in zip(a[1:], b[1:]):
        d += np.bitwise_count(x ^ y)
    return d


class Tree:
    """The upper levels of a vantage-point tree over a sample; a shard is a node at some depth."""

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        sample = _wide(sample)
        self.points = np.zeros((len(sample), 1 << (depth + 1)), np.uint64)
        self.median = np.full(1 << (depth + 1), 64 * len(sample), np.int16)
        self._grow(1, sample, depth)

    def _grow(self, node: int, points: np.ndarray, depth: int) -> None:
        if depth == 0 or not points.shape[1]:
            return
        # Of a few candidates, the one whose distances spread most.
        spread = [distance(points, p).astype(float).var() for p in points.T[:8]]
        vantage = points[:, int(np.argmax(spread))]
        d = distance(points, vantage)
        self.points[:, node], self.median[node] = vantage, int(np.median(d))
        near = d <= self.median[node]
        self._grow(2 * node, points[:, near], depth - 1)
        self._grow(2 * node + 1, points[:, ~near], depth - 1)

    def home(self, fps: np.ndarray, depth: int) -> np.ndarray:
        fps = _wide(fps)
        node = np.ones(fps.shape[1], np.int64)
        for _ in range(depth):
            node = 2 * node + (distance(fps, self.points[:, node]) > self.median[node])
        return node

    def visits(self, fps: np.ndarray, depth: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``fps`` and the shards that may hold something within the radius."""
        fps = _wide(fps)
        at, node = np.arange(fps.shape[1]), np.ones(fps.shape[1], np.int64)
        for _ in range(depth):
            d = distance(fps[:, at], self.points[:, node]).astype(np.int16)
            near, far = d - radius <= self.median[node], d + radius > self.median[node]
            at = np.concatenate([at[near], at[far]])
            node = np.concatenate([2 * node[near], 2 * node[far] + 1])
        return at, node


def search(fps: np.ndarray, home: np.ndarray, radius: int, found, across: bool = False) -> None:
    """Call ``found(i, j)`` with all places of pairs within the radius, one of them at home.

    With ``across`` the other one is not at home.
    """
    fps = _wide(fps)

    def split(points: np.ndarray, queries: np.ndarray) -> None:
        if not len(points) or not len(queries):
            return
        if len(points) > LEAF:
            vantage = fps[:, points[len(points) // 2]]
            d = distance(fps[:, points], vantage).astype(np.int16)
            median = int(np.median(d))
            near = d <= median
            if near.all():
                near = d < median
                median -= 1
            if near.any() and not near.all():
                q = distance(fps[:, queries], vantage).astype(np.int16)
                split(points[near], queries[q - radius <= median])
                split(points[~near], queries[q + radius > median])
                return
        for a in range(0, len(queries), 256):
            some = queries[a:a + 256]
            for c in range(0, len(points), 4 * LEAF):
                block = points[c:c + 4 * LEAF]
                near = distance(fps[:, some, None], fps[:, None, block]) <= radius
                # Hits are few; searched in one dimension they take less time.
                i, j = np.divmod(np.flatnonzero(near), len(block))
                i, j = some[i], block[j]
                # Two points at home meet twice; one meeting counts.
                once = (i < j) | ~home[i]
                if once.any():
                    found(i[once], j[once])

    split(np.flatnonzero(home), np.flatnonzero(~home) if across else np.arange(fps.shape[1]))


def meetings(routed: DataFrame, shard: Sequence[str], block: int) -> DataFrame:
    """Rows (fp, home, ...) of shards with every pair of blocks, left and right, that they meet in.

    A block holds about ``block`` rows; one at home meets itself, the later ones at home and
    all blocks of visitors. ``first`` tells the rows of the first block of a pair.
    """
    # Two numbers a shard, of which there are few; a block holds a hashed share of them.
    sizes = routed.groupBy(*shard).agg(*[
        F.greatest(F.ceil(F.count_if(c) / block).cast("int"), F.lit(1)).alias(name)
        for name, c in (("homes", F.col("home")), ("guests", ~F.col("home")))])
    own = routed.join(F.broadcast(sizes), list(shard)).withColumn("block", F.pmod(
        F.xxhash64("fp"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("guests"))).cast("int"))
    as_first = F.transform(F.sequence(F.lit(0), F.col("homes") - 1 + F.col("guests")), lambda i: F.struct(
        F.col("block").alias("left"), i.alias("right"), F.lit(True).alias("first")))
    as_second = F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda i: F.struct(
        i.alias("left"), (F.col("block") + F.when(F.col("home"), 0).otherwise(F.col("homes"))).alias("right"),
        F.lit(False).alias("first")))
    meets = F.when(F.col("home"), F.concat(
        F.filter(as_first, lambda m: m["right"] >= F.col("block")),
        F.filter(as_second, lambda m: m["left"] < F.col("block")))).otherwise(as_second)
    return own.select(*[c for c in routed.columns if c != "home"], F.inline(meets))
