"""Sums over all subtrees by parallel tree contraction, in rounds of joins.

A round rakes all leaves into their parents, then compresses: of the nodes with one child
left, an independent set is taken out of the chains, where each passes its own value to
its parent and its child to its parent too. Chains shrink by a constant share and
bushes by their leaves, so the rounds grow with the logarithm of the nodes, not with the
depth. The rounds are then undone from the last to the first: a node taken out of a
chain has its child's total and what it held itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from finfacts.llm.common import stored


def _sums(rows: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Sums of the values and the number of rows (``gone``) of every key, as ``of``, named apart."""
    return rows.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("of")).agg(
        *[F.sum(c).alias(f"more_{c}") for c in values], F.count("*").alias("gone"))


def _with_sums(rows: DataFrame, sums: DataFrame, values: Sequence[str], *others: str | Column) -> DataFrame:
    """``rows`` with the sums for their node added to their values, and the ``others``."""
    return rows.join(sums, F.col("v") == F.col("of"), "left").select(
        "v", "p", *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in values], *others)


def _rake(live: DataFrame, values: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The leaves with their totals, and the other nodes with ``n``, their children that are left."""
    children = live.filter("p IS NOT NULL").groupBy(F.col("p").alias("of")).agg(F.count("*").alias("n"))
    counted = stored(live.join(children, F.col("v") == F.col("of"), "left").select(
        "v", "p", *values, F.coalesce("n", F.lit(0)).alias("n")))
    leaves = counted.filter("n = 0")
    rest = _with_sums(counted.filter("n > 0"), _sums(leaves, "p", values), values,
                      (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n"))
    return leaves.select("v", *values), stored(rest)


def _chosen(rest: DataFrame, round_number: int) -> DataFrame:
    """Nodes with one child, no two of them linked: those above both neighbours in a hashed order."""
    unary = rest.filter("n = 1 AND p IS NOT NULL")
    rank = lambda v: F.struct(F.xxhash64(v, F.lit(round_number)), v)
    pairs = unary.select(F.col("v").alias("low"), F.col("p").alias("up")).join(
        unary.select(F.col("v").alias("up")), "up")
    beaten = pairs.select(F.when(rank("low") < rank("up"), F.col("low")).otherwise(F.col("up")).alias("v"))
    return unary.join(beaten.distinct(), "v", "left_anti")


def subtree_sums(tree: DataFrame, values: Sequence[str]) -> DataFrame:
    """``v`` and, for each of ``values``, its sum over the subtree of ``v``, itself included.

    ``tree`` holds every node ``v`` once with its parent ``p``, null for a root, of any type
    that can be compared, and integer values without nulls; it may be a forest or empty.
    Every step is stored in the shared folder. No key but a parent's gathers rows, and
    those are summed before they move.
    """
    live, totals, passed, round_number = stored(tree.select("v", "p", *values)), [], [], 0
    while not live.isEmpty():
        round_number += 1
        leaves, rest = _rake(live, values)
        totals.append(leaves)
        chosen = stored(_chosen(rest, round_number).select("v", "p", *values))
        out = chosen.select(F.col("v").alias("out"), F.col("p").alias("above"),
                            *[F.col(c).alias(f"own_{c}") for c in values])
        # Whose parent is taken out, hangs from that one's parent.
        hung = stored(rest.join(out, F.col("p") == F.col("out"), "left"))
        passed.append(hung.filter("out IS NOT NULL").select(
            "out", "v", *[f"own_{c}" for c in values]))
        moved = hung.select("v", F.when(F.col("out").isNotNull(), F.col("above")).otherwise(F.col("p")).alias("p"),
                            *values).join(chosen.select("v"), "v", "left_anti")
        live = stored(_with_sums(moved, _sums(chosen, "p", values), values))
    if not totals:
        return live.select("v", *values)
    # A child that a node was left with outlived its round: only later rounds know its total.
    known = totals[-1]
    for leaves, links in zip(totals[-2::-1], passed[-2::-1]):
        found = stored(links.join(known, "v").select(
            F.col("out").alias("v"), *[(F.col(c) + F.col(f"own_{c}")).alias(c) for c in values]))
        known = known.union(found).union(leaves)
    return known
