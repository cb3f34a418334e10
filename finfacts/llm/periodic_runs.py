"""Periodic runs of words: a suffix automaton with link-cut access finds the squares.

The suffix links of the automaton of a text form a tree; the path from the state of a
prefix to the root holds all of its suffixes. Appending word ``i`` accesses that path: it
is recoloured with ``i``, the last end of an occurrence. A segment of one old colour ``j``
whose longest string has at least ``i - j`` words is a square of period ``i - j`` that
ends at ``i``; with the square goes everything that repeats before it, so its start is
that of the run, and the last ``i`` that shows it is the run's end. The recoloured
segments are the preferred paths of a link-cut tree. The tree is complete before the first
access, so they are kept as stacks on its heavy paths instead of splay trees.

A run of a length and exponent holds a window of words that occurs twice in its text, and
such windows cover it. Hashes of windows find the stretches that may hold runs; a run
lies in one stretch, and only stretches go through the automaton.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.llm.common import Batches, Mapper, shape, stored, table, texts

MIN_LENGTH = 24
MIN_PERIODS = 3

Run = tuple[int, int, int]
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def stretches(words: list[bytes], size: int) -> list[tuple[int, int]]:
    """The stretches, as start and end, covered by windows of ``size`` words that occur twice.

    Equal hashes propose windows; a chance hit only makes a stretch longer.
    """
    n = len(words) - size + 1
    if n < 2:
        return []
    mixed = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64) | np.uint64(1)
    # Windows of twice the width from two neighbours, then one that overlaps.
    width = 1
    with np.errstate(over="ignore"):
        while width < size:
            step = min(width, size - width)
            left, right = mixed[:len(mixed) - step], mixed[step:]
            mixed = (left ^ (left >> np.uint64(29))) * _FACTOR + right * np.uint64(2 * width + 1)
            width += step
    ranked = np.sort(mixed)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return []
    at = np.flatnonzero(np.isin(mixed, np.unique(twice)))
    breaks = np.flatnonzero(np.diff(at) > size)
    first, last = np.append(at[:1], at[breaks + 1]), np.append(at[breaks], at[-1:]) + size
    return list(zip(first.tolist(), last.tolist()))


def suffix_automaton(word: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and longest lengths of the states (0 is the root), and each prefix's state."""
    link, longest, steps, prefix = [-1], [0], [{}], []
    last = 0
    for c in word:
        new = len(link)
        link.append(0)
        longest.append(longest[last] + 1)
        steps.append({})
        prefix.append(new)
        p, last = last, new
        while p >= 0 and c not in steps[p]:
            steps[p][c] = new
            p = link[p]
        if p < 0:
            continue
        q = steps[p][c]
        if longest[q] == longest[p] + 1:
            link[new] = q
            continue
        clone = len(link)
        link.append(link[q])
        longest.append(longest[p] + 1)
        steps.append(dict(steps[q]))
        while p >= 0 and steps[p].get(c) == q:
            steps[p][c] = clone
            p = link[p]
        link[q] = link[new] = clone
    return link, longest, prefix


class HeavyPaths:
    """The tree of suffix links as heavy paths; a path's states run from its head downwards."""

    def __init__(self, link: list[int], longest: list[int]) -> None:
        n = len(link)
        order = np.argsort(np.array(longest), kind="stable").tolist()
        below, heavy = [1] * n, [-1] * n
        for v in reversed(order[1:]):
            up = link[v]
            below[up] += below[v]
            if heavy[up] < 0 or below[v] > below[heavy[up]]:
                heavy[up] = v
        self.path, self.place, self.states = [0] * n, [0] * n, []
        for v in order:
            up = link[v]
            if up >= 0 and heavy[up] == v:
                self.path[v], self.place[v] = self.path[up], self.place[up] + 1
                self.states[self.path[v]].append(v)
            else:
                self.path[v] = len(self.states)
                self.states.append([v])


def squares(word: list[int]) -> Iterator[tuple[int, int, int]]:
    """Period, start and end of each square that an appended word shows, extended to the left."""
    link, longest, prefix = suffix_automaton(word)
    paths = HeavyPaths(link, longest)
    path, place, states = paths.path, paths.place, paths.states
    # Segments of a path: the place of the lowest state and the colour; the highest segment is last.
    segments: list[list[tuple[int, int]]] = [[] for _ in states]
    for i, v in enumerate(prefix):
        newest = -1
        while v > 0:
            own, at = path[v], place[v]
            stack, members = segments[own], states[own]
            met = []
            while stack and stack[-1][0] <= at:
                met.append(stack.pop())
            if stack and (not met or met[-1][0] < at):
                met.append((at, stack[-1][1]))
            # From the deepest segment up: of one colour only the longest string counts.
            for low, colour in reversed(met):
                if colour > newest:
                    newest = colour
                    length = longest[members[low]]
                    if i - colour <= length:
                        yield i - colour, colour - length + 1, i
            stack.append((at, i))
            v = link[members[0]]


def runs_of(words: list[bytes], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[Run]:
    """Start, length and smallest period of all runs of that length and exponent, by start, then period."""
    found = []
    window = min_length - min_length // min_periods
    for first, last in stretches(words, window):
        known: dict[bytes, int] = {}
        word = [known.setdefault(w, len(known)) for w in words[first:last]]
        ends = {(period, start): end for period, start, end in squares(word)}
        for (period, start), end in ends.items():
            length = end - start + 1
            if length >= max(min_length, min_periods * period):
                found.append((first + start, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def without_repeats(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [w for w, inside in zip(words, np.cumsum(edges).tolist()) if not inside]


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest exact exponent; ties by start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _find(min_length: int, min_periods: int, rewrite: Rewrite | None) -> Mapper:
    def run(batches: Batches) -> Batches:
        for b in batches:
            counts, runs, kept = [], [], []
            ids = b.column("id").to_pylist() if rewrite else ()
            for i, text in enumerate(texts(b.column("text"))):
                words = text.split()
                if rewrite:
                    words = rewrite(ids[i], words)
                own = runs_of(words, min_length, min_periods)
                counts.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in own])
                kept.append(b" ".join(without_repeats(words, own)))
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(counts, pa.int64()), pa.array(runs, kind),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["row", "n_words", "runs", "collapsed"],
            )
    return run


def periodic_runs(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS,
    id_column: str = "doc_id", rewrite: Rewrite | None = None,
) -> DataFrame:
    """``docs`` without ``text``, with ``n_words``, ``runs`` and the ``collapsed`` text.

    A word is anything between the six ASCII white spaces. A run is a stretch of words with
    smallest period q and at least ``min_length`` words and ``min_periods`` periods (two or
    more) that no neighbouring word extends; ``runs`` lists start (from 0), length and
    period by start, then period. ``collapsed`` keeps the first period of every run and all
    words outside, joined by one space. ``rewrite`` may change the words of a document,
    given its id, before the search. A null or empty text has no words and no runs; rows
    keep their number; columns named like the results are replaced. A text is held whole by
    its task; its stretches take about a kilobyte a word while they are searched.
    """
    if min_periods < 2 or min_length < 2 * min_periods:
        raise ValueError("a run has at least two periods, and min_length twice as many words")
    added = ("n_words", "runs", "collapsed")
    others = [c for c in docs.columns if c not in ("text", *added)]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("none of the columns")).alias("row"),
        F.col(f"`{id_column}`").alias("id"), F.col("`text`").cast("binary").alias("text"))
    found = rows.mapInArrow(_find(min_length, min_periods, rewrite), shape(
        rows, ["row"],
        "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"))
    return found.select(*[F.col("row").getField(c).alias(c) for c in others], *added)


def periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten with a tail that repeats its beginning, by the id's checksum."""
    if doc_id is None or not words:
        return words
    group, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    n, at = len(words), group % len(words)
    period = 1 + (n - at) // (3 + group % 8)
    times = -(-(n - at) // period)
    return words[:at] + (words[at:at + period] * times)[:n - at]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, its strongest run, and digests of the runs and of the collapsed text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs, rewrite=periodic_tail)
    # Exact order of length / period by cross products; the first of equals has the smallest start.
    better = lambda a, b: F.when(
        a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", none, better)
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )
