"""The trie of conversation prefixes, with the total of every subtree.

Turns are numbered by one distributed sort and then stand for themselves by two 64-bit
hashes; texts do not move further. A prefix is known by the exclusive or of the hashes of
its turns at their places, so it needs no list of turns, and a conversation of any length
is summed up in blocks. Nodes are the distinct prefixes; parallel tree contraction gives
what their subtrees hold.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from finfacts.llm.common import Batches, batch, partitions, stored, table
from finfacts.llm.tree_contraction import subtree_sums

# Turns of a conversation that are summed up in one task.
BLOCK = 1024
# Ids of one row when the members of a node are listed.
IDS_AT_ONCE = 4096


class Trie(NamedTuple):
    """``nodes``: one row each; ``ends``: for every conversation the node of its last turn."""

    nodes: DataFrame
    ends: DataFrame


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``depth`` (from 1), two hashes and the bytes of the text of every turn.

    Turns are ordered by ``turn`` (nulls first), then role and text; equal rows are turns of
    their own. A null role or text is empty; rows with a null ``conv_id`` are left out.
    """
    text, role = (F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in ("text", "role"))
    keys = ("conv_id", "turn", "role", "text")
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role, text)
    dealt = rows.repartitionByRange(partitions(turns.sparkSession), *keys).sortWithinPartitions(*keys)
    # The id holds the part and the place in it, so it counts on from one part to the next.
    placed = stored(dealt.select(
        "conv_id", F.monotonically_increasing_id().alias("at"), F.xxhash64("role", "text").alias("t1"),
        F.xxhash64(F.lit(7), "role", "text").alias("t2"), F.octet_length("text").cast("long").alias("size")))
    part, place = F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part).agg(F.count("*").alias("n"))
    # One row a part.
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    counted = placed.withColumn("part", part).join(F.broadcast(before), "part").select(
        "conv_id", (F.col("before") + place).alias("at"), "t1", "t2", "size")
    first = counted.groupBy("conv_id").agg(F.min("at").alias("first"))
    return stored(counted.join(first, "conv_id").select(
        "conv_id", (F.col("at") - F.col("first") + 1).alias("depth"), "t1", "t2", "size"))


def _prefixes(numbered: DataFrame) -> DataFrame:
    """Numbered turns with the keys of the prefixes they end (k1, k2) and extend (p1, p2)."""
    turn = numbered.select(
        "conv_id", "depth", "size", F.floor(F.col("depth") / BLOCK).cast("long").alias("block"),
        F.xxhash64("depth", "t1", "t2").alias("x1"), F.xxhash64(F.lit(7), "depth", "t2", "t1").alias("x2"))
    within = Window.partitionBy("conv_id", "block").orderBy("depth") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = turn.select("*", *[F.bit_xor(f"x{i}").over(within).alias(f"r{i}") for i in (1, 2)])
    blocks = turn.groupBy("conv_id", "block").agg(*[F.bit_xor(f"x{i}").alias(f"b{i}") for i in (1, 2)])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select(
        "conv_id", "block", *[F.bit_xor(f"b{i}").over(earlier).alias(f"e{i}") for i in (1, 2)]
    ).filter("block > 0")
    whole = running.join(before, ["conv_id", "block"], "left").select(
        "conv_id", "depth", "size", "x1", "x2",
        *[F.col(f"r{i}").bitwiseXOR(F.coalesce(f"e{i}", F.lit(0))).alias(f"k{i}") for i in (1, 2)])
    return whole.select("conv_id", "depth", "size", "k1", "k2", *[
        F.col(f"k{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"p{i}") for i in (1, 2)])


def build_trie(numbered: DataFrame, members: DataFrame | None = None) -> Trie:
    """The trie of numbered turns. ``members``: all conversations, also those without a turn."""
    turns = stored(_prefixes(numbered))
    if members is None:
        members = numbered.select("conv_id").distinct()
    found = stored(turns.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("size").alias("size"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2")))
    zero = F.lit(0).cast("long")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0") \
        .select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs",
                zero.alias("size"), zero.alias("p1"), zero.alias("p2"))
    every = found.union(root)
    above = every.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                         F.col("conv_id").alias("parent_conv_id"))
    linked = found.join(above, ["depth", "p1", "p2"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "size")
    base = stored(linked.union(root.select(
        "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "size")))
    parent = F.when(F.col("parent_conv_id").isNotNull(), F.struct(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")))
    children = base.filter("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count("*").alias("n_children"))
    node = stored(base.join(children, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.struct("conv_id", "depth").alias("v"), parent.alias("p"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")))
    sums = subtree_sums(
        node.select("v", "p", "saved_tokens", (F.col("n_children") == 0).cast("long").alias("n_leaves")),
        ["saved_tokens", "n_leaves"])
    nodes = node.drop("saved_tokens", "p").join(sums, "v").drop("v").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    # The last turn of a conversation ends at its node; without turns it ends at the root.
    last = turns.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    tails = turns.join(last, ["conv_id", "depth"]).select(F.col("conv_id").alias("member"), "depth", "k1", "k2")
    at_nodes = tails.join(found.select("depth", "k1", "k2", "conv_id"), ["depth", "k1", "k2"]).select(
        "conv_id", "depth", "member")
    turnless = members.join(last, "conv_id", "left_anti").select(F.col("conv_id").alias("member"), zero.alias("depth"))
    at_root = turnless.join(F.broadcast(root.select("conv_id", "depth")), "depth")  # the root is one row
    return Trie(nodes, at_nodes.union(at_root.select("conv_id", "depth", "member")))


def prefix_trie(turns: DataFrame) -> Trie:
    """The trie of conversations (conv_id, turn, role, text).

    A node is a distinct sequence of the first ``depth`` turns; the root has none. It is named
    by ``depth`` and the smallest ``conv_id`` that starts with it, its parent by
    ``parent_conv_id`` one level up (null for the root). ``n_convs`` counts conversations that
    start with it, ``n_children`` its children, ``n_leaves`` the childless nodes of its subtree,
    itself included; ``saved_tokens`` sums over its subtree the bytes of a node's last
    text, once for every conversation but the first. ``ends`` has ``member``, a conversation,
    with its node (conv_id, depth). Order, nulls and ties: ``numbered_turns``. Other
    columns are ignored. Without conversations there are no nodes, not even a root.
    """
    return build_trie(numbered_turns(turns))


def _lists(batches: Batches) -> Batches:
    """Rows sorted by node and member, as lists of ids in decimal, joined by commas."""
    node, ids = None, []

    def flush() -> pa.RecordBatch:
        return batch(conv_id=([node[0]], pa.int64()), depth=([node[1]], pa.int64()), first=([ids[0]], pa.int64()),
                     ids=([",".join(map(str, ids))], pa.string()))

    for b in batches:
        for conv_id, depth, member in zip(*(b.column(c).to_pylist() for c in ("conv_id", "depth", "member"))):
            if ids and ((conv_id, depth) != node or len(ids) == IDS_AT_ONCE):
                yield flush()
                ids = []
            node = conv_id, depth
            ids.append(member)
    if ids:
        yield flush()


def _digests(batches: Batches) -> Batches:
    """SHA-256 of the lists of a node; rows come sorted by node and first id."""
    node, digest = None, None

    def result() -> pa.RecordBatch:
        return batch(conv_id=([node[0]], pa.int64()), depth=([node[1]], pa.int64()),
                     ends_sha256=([digest.hexdigest()], pa.string()))

    for b in batches:
        for conv_id, depth, ids in zip(*(b.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))):
            if (conv_id, depth) != node:
                if node is not None:
                    yield result()
                node, digest = (conv_id, depth), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if node is not None:
        yield result()


def ends_digests(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` of every node with ends: their ids, ascending, in decimal, joined by commas.

    The members of a node are listed in parts that any task may hold; one digest reads the
    lists of a node one after the other and keeps none of them.
    """
    n, keys = partitions(ends.sparkSession), ("conv_id", "depth", "member")
    lists = ends.repartitionByRange(n, *keys).sortWithinPartitions(*keys).mapInArrow(
        _lists, "conv_id long, depth long, first long, ids string")
    return lists.repartition(n, "conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first").mapInArrow(
        _digests, "conv_id long, depth long, ends_sha256 string")


def rebuilt_turns(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings, and all of their ids.

    Conversation c begins with the first h turns of conversation c - c % 5 and goes on with its own
    turns after its first h, where h is the checksum of its id modulo 9.
    """
    sizes = stored(numbered.groupBy("conv_id").agg(F.count("*").alias("n")))
    donor = F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(5))
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(9))
    plan = sizes.select("conv_id", donor.alias("donor"), head.alias("h"))
    has = plan.join(sizes.select(F.col("conv_id").alias("donor"), F.col("n").alias("given")), "donor", "left") \
        .select("conv_id", "donor", "h", F.least("h", F.coalesce("given", F.lit(0))).alias("taken"))
    values = ("t1", "t2", "size")
    lent = numbered.filter("depth <= 8 AND pmod(conv_id, 5) = 0").withColumnRenamed("conv_id", "donor")
    begun = has.join(lent, "donor").filter("depth <= h").select("conv_id", "depth", *values)
    own = numbered.join(has.drop("donor"), "conv_id").filter("depth > h").select(
        "conv_id", (F.col("depth") - F.col("h") + F.col("taken")).alias("depth"), *values)
    return begun.union(own), sizes.select("conv_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of conversations that were rebuilt to share beginnings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trie = build_trie(*rebuilt_turns(numbered_turns(turns)))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return trie.nodes.join(ends_digests(trie.ends), ["conv_id", "depth"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", nothing))
