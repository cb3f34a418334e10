"""Near copies by SimHash fingerprints of word shingles, decided by exact Jaccard similarity.

Texts with equal sets of shingles are one point. Its fingerprint has 256 bits, each the
majority among the distinct shingles, so that sets at the limit differ in more bits than
the radius with a chance of about 1e-9 only. Sets of such similarity differ by a bounded
ratio in size, so a point meets its own band of sizes and the next few. Every band is cut
into shards by a vantage-point tree, every shard into blocks, and every pair of blocks is
searched on its own, so that no task holds more than two blocks. Fingerprints only propose
pairs, which their sets decide: the first round compares every point with the smallest one
within the radius, the second all pairs that are still apart and not ruled out by sizes and
bitmaps, which bound the difference of two sets from below.
"""

from __future__ import annotations

import math
from hashlib import blake2b
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from finfacts.llm.common import Batches, Mapper, batch, content_key, partitions, stored, texts
from finfacts.llm.components import connected_components
from finfacts.llm.vantage_tree import SAMPLE, SAMPLED, Tree, meetings, search

SEED = 42
HASHES_AT_ONCE = 1 << 18
# 64-bit words of a fingerprint.
WORDS = 4
# Bands of sizes that the ratio at the limit spans.
BANDS = 4
# Points of a band's shard, of a block that is searched, and of one whose pairs are listed.
SHARD = 20_000
BLOCK = 8_192
CLOSE = 2_048
# Partners of a hub that one task compares it with.
PARTNERS = 64
# Bits of a set's bitmap.
BITS = 1024

_RANDOM = np.random.default_rng(42).integers(0, 1 << 64, (3, WORDS), np.uint64)
_MASKS, _FACTORS, _SECOND = _RANDOM[0], _RANDOM[1] | np.uint64(1), _RANDOM[2] | np.uint64(1)


def shingle_hashes(text: bytes, size: int):
    """64-bit hashes of the word shingles, in arrays of bounded length; short texts are one shingle."""
    words = text.lower().split()
    n = max(1, len(words) - size + 1) if words else 0
    for at in range(0, n, HASHES_AT_ONCE):
        part = words[at:at + HASHES_AT_ONCE + size - 1]
        count = min(HASHES_AT_ONCE, n - at)
        joined = map(b" ".join, zip(*(part[i:] for i in range(size)))) if len(part) >= size \
            else iter([b" ".join(part)])
        yield np.fromiter(map(xxh64_intdigest, joined, repeat(SEED)), np.uint64, count)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Distinct shingle hashes, sorted."""
    parts = [np.unique(h) for h in shingle_hashes(text, size)]
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts or [np.zeros(0, np.uint64)]))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The fingerprint of a set in 64-bit words: the bits that over half of its hashes have."""
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(hashes), 4_080):
        mixed = (hashes[at:at + 4_080, None] ^ _MASKS) * _FACTORS
        mixed = (mixed ^ mixed >> np.uint64(32)) * _SECOND
        mixed ^= mixed >> np.uint64(29)
        bits = np.unpackbits(mixed.astype("<u8").view(np.uint8), axis=1, bitorder="little")
        for part in range(0, len(bits), 255):
            ones += bits[part:part + 255].sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")


def radius_of(min_similarity: float) -> int:
    """Bits by which the fingerprints of sets at the limit differ at most, but for a chance of 1e-9.

    Majorities of large sets differ by the angle between them, those of small ones by a quarter
    more (4 of 5 shingles: 0.1875 against 0.1514 of the bits).
    """
    share = min(0.5, 1.25 * math.acos(2 * min_similarity / (1 + min_similarity)) / math.pi)
    return int(64 * WORDS * share + 6.7 * math.sqrt(64 * WORDS * share * (1 - share)))


def parity(hashes: np.ndarray) -> np.ndarray:
    """The bitmap: a bit is set if an odd number of hashes falls on it.

    Every element that two sets do not share flips one bit, so the bitmaps of two sets
    differ in at most as many bits as the sets in elements.
    """
    odd = np.bincount((hashes % np.uint64(BITS)).astype(int), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(len(a) + len(b) - both, 1)


def _points(size: int) -> Mapper:
    """The hash of the set, its size, fingerprint and bitmap."""
    def run(batches: Batches) -> Batches:
        for b in batches:
            ids, sizes, prints, bits = [], [], [], []
            for t in texts(b.column("text")):
                own = shingle_set(t, size)
                digest = blake2b(own.astype("<u8").tobytes(), digest_size=8).digest()
                ids.append(int.from_bytes(digest, "little", signed=True))
                sizes.append(len(own))
                prints.append(wide_fingerprint(own))
                bits.append(parity(own))
            yield pa.RecordBatch.from_arrays(
                [b.column("k1"), b.column("k2"), b.column("doc_id"), pa.array(ids, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(prints, pa.list_(pa.int64())),
                 pa.array(bits, pa.list_(pa.int64()))],
                names=["k1", "k2", "doc_id", "fp", "size", "print", "bits"],
            )
    return run


def _hashes(size: int) -> Mapper:
    def run(batches: Batches) -> Batches:
        for b in batches:
            own = [shingle_set(t, size).tobytes() for t in texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("fp"), pa.array(own, pa.binary())], names=["fp", "hashes"])
    return run


def _decide(min_similarity: float) -> Mapper:
    """The pairs whose sets are similar enough; rows come sorted, a hub before its partners."""
    def run(batches: Batches) -> Batches:
        hub, own = None, None
        for b in batches:
            ends, sets = [], b.column("hashes")
            for i, (of, point) in enumerate(zip(b.column("hub").to_pylist(), b.column("fp").to_pylist())):
                held = np.frombuffer(sets[i].as_buffer(), np.uint64)
                if of == point:
                    # A copy, so that the batch can go.
                    hub, own = point, held.copy()
                elif jaccard(own, held) >= min_similarity:
                    ends.append((min(hub, point), max(hub, point)))
            yield batch(a=([x for x, _ in ends], pa.int64()), b=([y for _, y in ends], pa.int64()))
    return run


def _similar(pairs: DataFrame, sets: DataFrame, min_similarity: float) -> DataFrame:
    """The links among the proposed pairs (a, b, each once), by their sets (fp, hashes).

    The end with more pairs is the hub; its partners are cut into blocks, and its own set
    goes once to each block.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("fp"))
    degrees = ends.groupBy("fp").agg(F.count("*").alias("n"))
    of = lambda end: degrees.select(F.col("fp").alias(end), F.col("n").alias(f"n{end}"))
    met = pairs.join(of("a"), "a").join(of("b"), "b")
    first = F.struct("na", "a") > F.struct(F.col("nb").alias("na"), F.col("b").alias("a"))
    hubs = met.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("fp"), F.greatest("na", "nb").alias("n"))
    placed = stored(hubs.select("hub", "fp", F.pmod(
        F.xxhash64("fp"), F.ceil(F.col("n") / PARTNERS).cast("long")).alias("block")))
    own = placed.select("hub", "block").distinct().withColumn("fp", F.col("hub"))
    rows = placed.unionByName(own).join(sets, "fp")
    dealt = rows.repartition(partitions(pairs.sparkSession), "hub", "block").sortWithinPartitions(
        "hub", "block", F.col("fp") != F.col("hub"))
    return dealt.mapInArrow(_decide(min_similarity), "a long, b long")


def _words(column: pa.Array, n: int) -> np.ndarray:
    """Lists of ``n`` numbers as unsigned words, those of a row along the first axis."""
    return np.ascontiguousarray(column.flatten().to_numpy().view(np.uint64).reshape(-1, n).T)


def _route(tree: Tree, depths: dict[int, int], radius: int) -> Mapper:
    """A row at home, one for every earlier shard of its band visited, and for those of the next bands."""
    def run(batches: Batches) -> Batches:
        for b in batches:
            fps, bands = _words(b.column("print"), WORDS), b.column("band").to_numpy()
            for band in np.unique(bands).tolist():
                own = np.flatnonzero(bands == band)
                home = tree.home(fps[:, own], depths[band])
                at, node = tree.visits(fps[:, own], depths[band], radius)
                earlier = node < home[at]
                dealt = [(band, own, home, True), (band, own[at[earlier]], node[earlier], False)]
                for above in range(band + 1, band + BANDS + 1):
                    if above in depths:
                        at, node = tree.visits(fps[:, own], depths[above], radius)
                        dealt.append((above, own[at], node, False))
                for to, rows, key, is_home in dealt:
                    for k in range(0, len(rows), 10_000):
                        some = b.take(pa.array(rows[k:k + 10_000]))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(some), to), pa.int32()), pa.array(key[k:k + 10_000], pa.int32()),
                             pa.array(np.full(len(some), is_home), pa.bool_()), *some.columns[1:]],
                            names=["band", "key", "home", *some.schema.names[1:]])
    return run


def _met(points: DataFrame, min_similarity: float, block: int) -> DataFrame:
    """``points`` (fp, size, print, ...) with every pair of blocks in which they are searched.

    Pairs within the radius and the ratio of sizes share a pair of blocks (band, key, left, right).
    """
    width = math.log(1.01 / max(min_similarity, 0.01)) / BANDS
    banded = points.select(F.floor(F.log("size") / width).cast("int").alias("band"), *points.columns)
    # A hundred or two bands, as a text's size has few magnitudes.
    depths = {r["band"]: max(0, math.ceil(math.log2(r["n"] / SHARD)))
              for r in banded.groupBy("band").agg(F.count("*").alias("n")).collect()}
    depth = min(max(depths.values(), default=0), int(math.log2(SAMPLE // SAMPLED // WORDS)))
    sample = points.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLED << depth).select(
        *[F.col("print")[i].alias(f"w{i}") for i in range(WORDS)]).toPandas() if depth else None
    tree = Tree(np.zeros((WORDS, 0), np.uint64) if sample is None else
                sample.to_numpy(dtype=np.int64).view(np.uint64).T, depth)
    kinds = ", ".join(f"{name} {kind}" for name, kind in points.dtypes)
    routed = stored(banded.mapInArrow(
        _route(tree, {band: min(d, depth) for band, d in depths.items()}, radius_of(min_similarity)),
        f"band int, key int, home boolean, {kinds}"))
    return stored(meetings(routed, ["band", "key"], block))


def _by_blocks(met: DataFrame) -> DataFrame:
    """Dealt by pair of blocks into as many tasks as the session asks for, however small the rows are."""
    pair = ["band", "key", "left", "right"]
    return met.repartition(partitions(met.sparkSession), *pair).groupBy(*pair)


def _least(radius: int):
    """Every point with one within the radius in a pair of blocks, and the smallest of both and all such."""
    def run(key: tuple, met: pa.Table) -> pa.Table:
        ids, first = met.column("fp").to_numpy(), met.column("first").to_numpy()
        least, near = ids.copy(), np.zeros(len(ids), bool)

        def found(i: np.ndarray, j: np.ndarray) -> None:
            np.minimum.at(least, i, ids[j])
            np.minimum.at(least, j, ids[i])
            near[i] = near[j] = True

        search(_words(met.column("print").combine_chunks(), WORDS), first, radius, found, not first.all())
        return pa.table({"fp": ids[near], "least": least[near]})
    return run


def _apart(radius: int, min_similarity: float):
    """Pairs within the radius in different components that sizes and bitmaps do not rule out."""
    def run(key: tuple, met: pa.Table) -> pa.Table:
        ids, first = met.column("fp").to_numpy(), met.column("first").to_numpy()
        sizes, part = met.column("size").to_numpy(), met.column("component").to_numpy()
        bits = _words(met.column("bits").combine_chunks(), BITS // 64).T
        pairs = [np.zeros((2, 0), np.int64)]

        def found(i: np.ndarray, j: np.ndarray) -> None:
            may = (part[i] != part[j]) & (
                np.minimum(sizes[i], sizes[j]) >= min_similarity * np.maximum(sizes[i], sizes[j]))
            i, j = i[may], j[may]
            for at in range(0, len(i), 20_000):
                x, y = i[at:at + 20_000], j[at:at + 20_000]
                differ = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64)
                most = (1 - min_similarity) / (1 + min_similarity) * (sizes[x] + sizes[y]) + 1e-6
                x, y = ids[x[differ <= most]], ids[y[differ <= most]]
                pairs.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))

        search(_words(met.column("print").combine_chunks(), WORDS), first, radius, found, not first.all())
        a, b = np.concatenate(pairs, axis=1)
        return pa.table({"a": a, "b": b})
    return run


def similar_components(docs: DataFrame, size: int, min_similarity: float, id_column: str) -> DataFrame:
    """One row per row of ``docs``: content key, ``doc_id``, ``fp``, ``component``.

    ``fp`` stands for the shingle set; a component is the smallest of its sets.
    """
    k1, k2 = content_key(F.col(f"`{id_column}`"), F.col("`text`"))
    keyed = docs.select(F.col("`text`").cast("binary").alias("text"), k1, k2,
                        F.col(f"`{id_column}`").cast("long").alias("doc_id"))
    prints = stored(keyed.mapInArrow(
        _points(size),
        "k1 long, k2 long, doc_id long, fp long, size long, print array<long>, bits array<long>"))
    points = stored(prints.groupBy("fp").agg(
        F.min(F.struct("k1", "k2", "size", "print", "bits")).alias("x")).select("fp", "x.*"))
    radius = radius_of(min_similarity)
    # A text without words equals its like only.
    met = _met(points.filter("size > 0").select("fp", "size", "print"), min_similarity, BLOCK)
    near = stored(_by_blocks(met).applyInArrow(_least(radius), "fp long, least long").groupBy("fp").agg(
        F.min("least").alias("least")))
    chosen = points.select("fp", "k1", "k2").join(near.select("fp"), "fp")
    sets = stored(keyed.join(chosen, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("fp", "text").mapInArrow(
        _hashes(size), "fp long, hashes binary"))
    first = near.filter("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    links = stored(_similar(first, sets, min_similarity))
    parts = stored(connected_components(links).toDF("fp", "component"))
    close = stored(points.select("fp", "size", "print", "bits").join(near.select("fp"), "fp").join(
        parts, "fp", "left").withColumn("component", F.coalesce("component", "fp")))
    more = _by_blocks(_met(close, min_similarity, min(BLOCK, CLOSE))).applyInArrow(
        _apart(radius, min_similarity), "a long, b long").join(first, ["a", "b"], "left_anti")
    more = stored(_similar(stored(more), sets, min_similarity))
    labels = connected_components(links.union(more)).toDF("fp", "component")
    return prints.drop("size", "print", "bits").join(labels, "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
