"""Best-fit packing by minimum bin slack.

Texts become token pieces; only their lengths decide how they are packed, and there are
at most as many lengths as tokens in a sequence. The driver packs the histogram of lengths:
a bin takes the longest length left and the combination that fills it best, found by
subset sums over a bit set, and the same bin is used as often as its lengths last. A
piece finds its bin by its rank within its length, so that pieces never gather.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from finfacts.llm.common import Batches, Mapper, batch, nested, shape, stored, table, unnested
from finfacts.llm.tokens import encoder

CAPACITY = 4096
END_ID = 1


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The lengths, with their numbers, of a largest sum up to ``room``; longer lengths first."""
    reach, steps, limit = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, step = min(counts[length], room // length), 1
        while left > 0:
            take = min(step, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & limit
            left, step = left - take, 2 * step
        if reach >> room & 1:
            break
    target, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> target & 1:
            target -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def pack_lengths(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Bins as (uses, lengths with their numbers); their contents are the whole histogram."""
    counts = {k: v for k, v in histogram.items() if v}
    bins = []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        content = best_fill({k: v for k, v in counts.items() if v}, capacity - longest)
        counts[longest] += 1
        content[longest] = content.get(longest, 0) + 1
        uses = min(counts[k] // n for k, n in content.items())
        bins.append((uses, content))
        for k, n in content.items():
            counts[k] -= uses * n
            if not counts[k]:
                del counts[k]
    return bins


class Places:
    """Sequence and offset of a piece from its length and its rank within that length."""

    def __init__(self, bins: list[tuple[int, dict[int, int]]]) -> None:
        rows, given, sequence = [], {}, 0
        for uses, content in bins:
            offset = 0
            for length in sorted(content, reverse=True):
                number, rank = content[length], given.get(length, 0)
                rows.append((length, rank, number, sequence, offset))
                given[length] = rank + uses * number
                offset += length * number
            sequence += uses
        rows.sort()
        self.length, self.rank, self.number, self.sequence, self.offset = (
            np.array(c, np.int64) for c in (zip(*rows) if rows else [()] * 5)
        )
        self.sequences = sequence

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.searchsorted(self.length, length)
        last = np.searchsorted(self.length, length, "right")
        # Binary search for the last bin of that length whose first rank is not above.
        while (last - first > 1).any():
            middle = (first + last) // 2
            low = self.rank[middle] <= rank
            first, last = np.where(low, middle, first), np.where(low, last, np.maximum(middle, first + 1))
        over = rank - self.rank[first]
        use, slot = over // self.number[first], over % self.number[first]
        return self.sequence[first] + use, self.offset[first] + slot * length


def _pieces(
    path: str, words: bool, end_id: int, capacity: int, with_ids: bool, chunk: int | None,
) -> Mapper:
    def run(batches: Batches) -> Batches:
        own = encoder(path, words)
        for b in batches:
            names, at = b.column("doc_id").to_pylist(), 0
            for tokens, ends in own.encode_many(b.column("text"), chunk):
                rows, begin = [], 0
                for to in ends.tolist():
                    ids = np.append(tokens[begin:to], np.uint32(end_id)).astype("<u4", copy=False)
                    for n, start in enumerate(range(0, len(ids), capacity)):
                        raw = ids[start:start + capacity].tobytes()
                        rows.append((names[at], n, start, len(raw) // 4, zlib.crc32(raw),
                                     raw if with_ids else None))
                    begin, at = to, at + 1
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield batch(**{n: (c, k) for n, c, k in zip(_PIECE, columns, kinds)})
    return run


_PIECE = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")


def token_pieces(
    docs: DataFrame, path: str, words: bool = True, end_id: int = END_ID,
    capacity: int = CAPACITY, with_ids: bool = True, chunk: int | None = None,
) -> DataFrame:
    """The pieces of every text (doc_id, text) with its end id; only longer ones are cut.

    A task looks up ``chunk`` bytes of text at once; the result does not depend on it.
    """
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(path, words, end_id, capacity, with_ids, chunk),
        "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary",
    )
    return pieces if with_ids else pieces.drop("ids")


def _place(places: Places) -> Mapper:
    def run(batches: Batches) -> Batches:
        for b in batches:
            sequence, offset = places.find(
                b.column("length").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=["row", "sequence_id", "offset"],
            )
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, which replace columns of these names.

    Only ``length``, between 1 and ``capacity``, decides; all other columns stay, whatever their
    names and types. Equal rows are pieces of their own. The pieces are stored once, where each
    gets its number; a piece's rank among those of its length comes from its part of that
    table, so the commonest length is ranked in as many tasks as there are parts. At most
    ``capacity`` rows, one per length, reach the driver. No pieces give no rows.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = stored(nested(
        pieces.select(*[F.col(f"`{c}`") for c in columns]), F.col("`length`").cast("long").alias("length"),
        F.monotonically_increasing_id().alias("at")))
    part = F.shiftright("at", 33).alias("part")
    counts = rows.groupBy("length", part).agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(k is None or not 0 < k <= capacity for k in histogram):
        raise ValueError(f"a length lies outside 1 to {capacity}")
    within = Window.partitionBy("length", "part").orderBy("at")
    ranked = rows.select("row", "length", "at", part).withColumn("within", F.row_number().over(within) - 1) \
        .join(bases, ["length", "part"]) \
        .select("row", "length", (F.col("base") + F.col("within")).cast("long").alias("rank"))
    placed = ranked.mapInArrow(
        _place(Places(pack_lengths(histogram, capacity))), shape(ranked, ["row"], "sequence_id long, offset long"))
    return unnested(placed, columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str, **options) -> DataFrame:
    """Pieces of all texts with their places; a null text is the end id alone. Options: ``token_pieces``."""
    return pack(token_pieces(docs, path, **options), options.get("capacity", CAPACITY))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
