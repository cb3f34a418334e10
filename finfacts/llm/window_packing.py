"""Bounded-space online packing: best fit into a fixed number of open windows.

Every partition packs its own texts as it tokenises them. A piece goes into the open
window it leaves least room in; if none has room, a further window is opened, and once
the fixed number is open, the fullest one is topped up with the head of the piece and
emitted. Only the pieces of the windows that are still open at the end of a partition
move: groups of a few partitions pack them again in the same way, in rounds, until one
group is left. What remains there fills whole windows, and a last rest is cut into
windows of powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.llm.common import Batches, Mapper, stored, table
from finfacts.llm.tokens import encoder

CAPACITY = 2048
END_ID = 1
# Open windows of a partition, and partitions whose leftovers are packed together.
OPEN_WINDOWS = 32
FAN_IN = 8

_SCHEMA = (
    "part long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long, ids binary"
)
_ARROW = pa.schema([
    (c, pa.binary() if c == "ids" else pa.int64())
    for c in (x.split()[0] for x in _SCHEMA.split(","))
])


class Piece(NamedTuple):
    """A stretch of the ids of a document of ``doc_tokens`` ids."""

    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        """The first ``at`` ids and the others."""
        return (self._replace(ids=self.ids[:at]),
                self._replace(start=self.start + at, ids=self.ids[at:]))


Window = list[Piece]


class OpenWindows:
    """At most ``limit`` windows in the making, by the room they have left."""

    def __init__(self, capacity: int, limit: int) -> None:
        self.capacity, self.limit = capacity, limit
        self.room: list[int] = []
        self.windows: list[Window] = []

    def _hold(self, room: int, window: Window) -> None:
        at = bisect_left(self.room, room)
        self.room.insert(at, room)
        self.windows.insert(at, window)

    def place(self, piece: Piece) -> Iterator[Window]:
        """Take a piece in; yields the windows that are full by that."""
        while len(piece.ids) >= self.capacity:
            head, piece = piece.cut(self.capacity)
            yield [head]
        while len(piece.ids):
            size = len(piece.ids)
            at = bisect_left(self.room, size)
            if at < len(self.room):
                room, window = self.room.pop(at), self.windows.pop(at)
                window.append(piece)
                if room == size:
                    yield window
                else:
                    self._hold(room - size, window)
                return
            if len(self.room) < self.limit:
                self._hold(self.capacity - size, [piece])
                return
            head, piece = piece.cut(self.room.pop(0))
            yield [*self.windows.pop(0), head]

    def finish(self) -> Iterator[Window]:
        """Everything that is still open, in full windows and then in powers of two."""
        pieces = [p for window in self.windows for p in window]
        left = sum(len(p.ids) for p in pieces)
        self.room, self.windows = [], []
        window: Window = []
        size = room = _size(left, self.capacity)
        for piece in pieces:
            while len(piece.ids) >= room:
                head, piece = piece.cut(room)
                yield [*window, head]
                left -= size
                window, size = [], _size(left, self.capacity)
                room = size
                if not left:
                    return
            if len(piece.ids):
                window.append(piece)
                room -= len(piece.ids)


def _size(left: int, capacity: int) -> int:
    """The next window when ``left`` ids remain: a whole one, or the largest power of two."""
    return capacity if left >= capacity else 1 << (left.bit_length() - 1) if left else 0


class _Rows:
    """Result rows of a task, as record batches."""

    def __init__(self, part: int, sequence: int, with_ids: bool) -> None:
        self.part, self.next, self.with_ids = part, sequence, with_ids
        self.columns: list[list] = [[] for _ in _ARROW]

    def _add(self, piece: Piece, sequence: int | None, offset: int, ids: bytes | None, raw) -> None:
        row = (self.part, piece.doc_id, piece.start, len(piece.ids), zlib.crc32(raw),
               piece.doc_tokens, sequence, offset, ids)
        for column, value in zip(self.columns, row):
            column.append(value)

    def add(self, windows: Iterable[Window], is_open: bool = False) -> None:
        """Full windows, or open ones: these have no sequence yet and always carry their ids."""
        for window in windows:
            offset = 0
            for piece in window:
                raw = piece.ids.tobytes()
                carried = raw if is_open or self.with_ids else None
                self._add(piece, None if is_open else self.next, offset, carried, raw)
                offset += len(piece.ids)
            self.next += not is_open

    def take(self) -> pa.RecordBatch:
        """What was added since the last time."""
        given = [pa.array(c, f.type) for c, f in zip(self.columns, _ARROW)]
        self.columns = [[] for _ in _ARROW]
        return pa.RecordBatch.from_arrays(given, schema=_ARROW)


def _first_sequence(round_number: int, part: int) -> int:
    """Sequence numbers start apart for every round and part."""
    return round_number << 57 | part << 32


def _pack_partition(
    path: str, words: bool, end_id: int, capacity: int, open_windows: int, with_ids: bool
) -> Mapper:
    def run(batches: Batches) -> Batches:
        part = TaskContext.get().partitionId()
        own, windows = encoder(path, words), OpenWindows(capacity, open_windows)
        rows = _Rows(part, _first_sequence(0, part), with_ids)
        for b in batches:
            names, at = b.column("doc_id").to_pylist(), 0
            for tokens, ends in own.encode_many(b.column("text")):
                begin = 0
                for to in ends.tolist():
                    # A copy, so that an open window holds no other ids.
                    ids = np.append(tokens[begin:to], np.uint32(end_id)).astype("<u4", copy=False)
                    rows.add(windows.place(Piece(names[at], 0, ids, len(ids))))
                    begin, at = to, at + 1
                yield rows.take()
        rows.add(windows.windows, is_open=True)
        yield rows.take()
    return run


def _pack_leftovers(round_number: int, capacity: int, open_windows: int, with_ids: bool, last: bool):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        part = key[0].as_py()
        windows = OpenWindows(capacity, open_windows)
        rows = _Rows(part, _first_sequence(round_number, part), with_ids)
        order = [(c, "ascending") for c in ("part", "doc_id", "start", "length", "ids_crc32")]
        for r in group.sort_by(order).to_pylist():
            ids = np.frombuffer(r["ids"], "<u4")
            rows.add(windows.place(Piece(r["doc_id"], r["start"], ids, r["doc_tokens"])))
        if last:
            rows.add(windows.finish())
        else:
            rows.add(windows.windows, is_open=True)
        return pa.Table.from_batches([rows.take()], _ARROW)
    return run


def pack_windows(
    docs: DataFrame, path: str, words: bool = True, end_id: int = END_ID, capacity: int = CAPACITY,
    open_windows: int = OPEN_WINDOWS, fan_in: int = FAN_IN, with_ids: bool = True,
) -> DataFrame:
    """The pieces of all texts (doc_id, text) with ``sequence_id`` and ``offset``; with their ``ids`` if asked.

    A document is its ids and the end id; a null or empty text is the end id alone. All
    sequences hold ``capacity`` ids but the last few, whose lengths are different powers of
    two. At most one document is cut for each sequence beside those longer than one. Rows
    with equal or null ids are documents of their own; other columns are ignored; an empty
    table gives no rows. Ids are integers. A group of leftovers has at most ``fan_in`` times
    ``open_windows`` windows, whatever the size of the data.
    """
    options = (capacity, open_windows, with_ids)
    packed = stored(docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`")).mapInArrow(
        _pack_partition(path, words, end_id, *options), _SCHEMA))
    parts = packed.agg(F.max("part")).first()[0]
    done = [packed.filter("sequence_id IS NOT NULL")]
    groups, round_number = 0 if parts is None else parts + 1, 0
    while groups and (groups > 1 or not round_number):
        groups, round_number = -(-groups // fan_in), round_number + 1
        group = F.floor(F.col("part") / fan_in).cast("long").alias("group")
        packed = stored(packed.filter("sequence_id IS NULL").groupBy(group).applyInArrow(
            _pack_leftovers(round_number, *options, groups == 1), _SCHEMA))
        done.append(packed.filter("sequence_id IS NOT NULL"))
    whole = done[0]
    for more in done[1:]:
        whole = whole.union(more)
    return whole.drop("part") if with_ids else whole.drop("part", "ids")


def op13_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_windows(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
