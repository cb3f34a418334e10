"""A wavelet matrix over token ids, and its compressed file.

Level by level, from the highest bit of the ids, the bits of all ids in the present
order form a plane; ids with a 0 then go before those with a 1, both in order. Ranks on the
planes answer what stands at a place, how often an id occurs before it, and where. The file
holds the rank directories too, and planes in chunks, so that a question unpacks a small part.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np
import zstandard

MAGIC = b"WVM2"
# Bits between two entries of the rank directory, and bits of a plane that are unpacked together.
BLOCK = 512
CHUNK = 1 << 18
_HEADER = "<4sBBQQ"


class Plane:
    """Bits with rank and select.

    ``load(0)`` gives the directory, the ones before every block, and ``load(1 + k)`` the
    64-bit words of chunk ``k``; only what a question needs is loaded.
    """

    def __init__(self, n: int, load: Callable[[int], np.ndarray]) -> None:
        self.n, self._load, self._parts = n, load, {}

    def part(self, k: int) -> np.ndarray:
        if k not in self._parts:
            self._parts[k] = self._load(k)
        return self._parts[k]

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        """A plane of these bits, filled up to whole blocks."""
        raw = np.packbits(bits, bitorder="little")
        full = np.zeros(-(-len(bits) // BLOCK) * BLOCK // 8, np.uint8)
        full[:len(raw)] = raw
        words = full.view("<u8")
        ones = np.bitwise_count(words.reshape(-1, BLOCK // 64)).sum(axis=1, dtype=np.int64)
        directory = np.append(0, np.cumsum(ones)).astype("<i8")
        return cls(len(bits), lambda k: words[(k - 1) * CHUNK // 64:k * CHUNK // 64] if k else directory)

    @property
    def directory(self) -> np.ndarray:
        return self.part(0)

    @property
    def zeros(self) -> int:
        return self.n - int(self.directory[-1])

    def bits(self) -> np.ndarray:
        words = [self.part(1 + k) for k in range(chunks(self.n))]
        raw = np.concatenate(words).view(np.uint8) if words else np.zeros(0, np.uint8)
        return np.unpackbits(raw, count=self.n, bitorder="little").view(bool)

    def get(self, i: int) -> int:
        chunk, at = divmod(i, CHUNK)
        return int(self.part(1 + chunk)[at >> 6]) >> (at & 63) & 1

    def rank(self, bit: int, i: int) -> int:
        """How many of the first ``i`` bits equal ``bit``."""
        ones = int(self.directory[i // BLOCK])
        if i % BLOCK:
            chunk, at = divmod(i, CHUNK)
            words, first = self.part(1 + chunk), at // BLOCK * BLOCK // 64
            ones += int(np.bitwise_count(words[first:at >> 6]).sum())
            if at & 63:
                ones += (int(words[at >> 6]) & ((1 << (at & 63)) - 1)).bit_count()
        return ones if bit else i - ones

    def select(self, bit: int, ks: np.ndarray) -> np.ndarray:
        """The places of the ``ks``-th (from 0) bits equal to ``bit``, for many at once."""
        edges = np.arange(len(self.directory), dtype=np.int64) * BLOCK
        upto = self.directory if bit else edges - self.directory
        out = np.empty(len(ks), np.int64)
        for begin in range(0, len(ks), BLOCK):
            own = ks[begin:begin + BLOCK]
            blocks = np.searchsorted(upto, own, "right") - 1
            used, row = np.unique(blocks, return_inverse=True)
            per = CHUNK // BLOCK
            words = np.concatenate([
                self.part(1 + b // per)[b % per * BLOCK // 64:(b % per + 1) * BLOCK // 64] for b in used.tolist()
            ])
            bits = np.unpackbits(words.view(np.uint8), bitorder="little").reshape(-1, BLOCK)
            seen = np.cumsum(bits == bit, axis=1, dtype=np.int16)
            within = (seen[row] > (own - upto[blocks])[:, None]).argmax(axis=1)
            out[begin:begin + BLOCK] = blocks * BLOCK + within
        return out


def sides(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the zeros and where the ones stand; moving ids by places is several times faster than by a mask."""
    return np.flatnonzero(~bits), np.flatnonzero(bits)


def chunks(n: int) -> int:
    """Chunks of a plane of ``n`` bits."""
    return -(-n // CHUNK)


class WaveletMatrix:
    """Token ids as bit planes."""

    def __init__(self, planes: list[Plane], n: int) -> None:
        self.planes, self.n, self.levels = planes, n, len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        ids = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes = []
        for level in range(levels - 1, -1, -1):
            bits = (ids & ids.dtype.type(1 << level)) != 0
            planes.append(Plane.of(bits))
            ids = np.concatenate([ids.take(own) for own in sides(bits)])
        return cls(planes, len(ids))

    def all(self) -> np.ndarray:
        """All ids in order."""
        ids = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level, plane in enumerate(reversed(self.planes)):
            (zeros, ones), above = sides(plane.bits()), np.empty_like(ids)
            above[zeros] = ids[:len(zeros)]
            above[ones] = ids[len(zeros):] | ids.dtype.type(1 << level)
            ids = above
        return ids

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        value = 0
        for plane in self.planes:
            bit = plane.get(i)
            value = 2 * value + bit
            i = plane.rank(bit, i) + bit * plane.zeros
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        for level, plane in enumerate(self.planes):
            bit = token >> (self.levels - 1 - level) & 1
            start = plane.rank(bit, start) + bit * plane.zeros
            end = plane.rank(bit, end) + bit * plane.zeros
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often ``token`` occurs from place ``start`` up to before ``end``."""
        if token >> self.levels:
            return 0
        low, high = self._range(token, start, self.n if end is None else end)
        return high - low

    def select(self, token: int, k: int) -> int:
        """The place of the ``k``-th (from 0) occurrence of ``token``."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        return self._places(token, np.array([k], np.int64)).tolist()[0]

    def occurrences(self, token: int) -> list[int]:
        """All places of ``token``, in order."""
        return self._places(token, np.arange(self.count(token), dtype=np.int64)).tolist()

    def _places(self, token: int, ks: np.ndarray) -> np.ndarray:
        if not len(ks):
            return ks
        places = self._range(token, 0, 0)[0] + ks
        for level, plane in enumerate(reversed(self.planes)):
            bit = token >> level & 1
            places = plane.select(bit, places - bit * plane.zeros)
        return places


def write_file(ids: np.ndarray, doc_ids: list, lengths: list[int], levels: int) -> bytes:
    """One shard as bytes: header, sizes of the blocks, then the blocks, each compressed on its own.

    The blocks are document ids, null flags, lengths, and for each plane its rank directory and chunks.
    """
    matrix, pack = WaveletMatrix.build(ids, levels), zstandard.ZstdCompressor(level=1).compress
    known = np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    blocks = [known, bytes(d is None for d in doc_ids), np.array(lengths, "<u8").tobytes()]
    for plane in matrix.planes:
        blocks += [plane.part(k).tobytes() for k in range(1 + chunks(len(ids)))]
    blocks = list(map(pack, blocks))
    return b"".join([
        struct.pack(_HEADER, MAGIC, 2, levels, len(ids), len(doc_ids)),
        np.array(list(map(len, blocks)), "<u8").tobytes(), *blocks,
    ])


class ShardFile:
    """A shard of which single blocks are unpacked when they are asked for; ``unpacked`` counts their bytes."""

    def __init__(self, data: bytes) -> None:
        magic, version, levels, self.n, docs = struct.unpack_from(_HEADER, data)
        if magic != MAGIC or version != 2:
            raise ValueError("not a wavelet shard")
        self.levels, self.data, self.unpacked = levels, memoryview(data), 0
        each = 1 + chunks(self.n)
        sizes = np.frombuffer(data, "<u8", 3 + levels * each, struct.calcsize(_HEADER)).astype(np.int64)
        begin = struct.calcsize(_HEADER) + 8 * len(sizes)
        self.ends = np.cumsum(np.append(begin, sizes)).tolist()
        if self.ends[-1] != len(data):
            raise ValueError("the shard is longer or shorter than its header says")
        self._unpack = zstandard.ZstdDecompressor().decompress
        self.matrix = WaveletMatrix(
            [Plane(self.n, self._loader(3 + level * each)) for level in range(levels)], self.n
        )

    def block(self, i: int) -> bytes:
        self.unpacked += self.ends[i + 1] - self.ends[i]
        return self._unpack(self.data[self.ends[i]:self.ends[i + 1]])

    def _loader(self, first: int) -> Callable[[int], np.ndarray]:
        return lambda k: np.frombuffer(self.block(first + k), "<u8" if k else "<i8")

    def documents(self) -> tuple[list, list[int]]:
        """Ids and lengths of the documents."""
        known, gone = np.frombuffer(self.block(0), "<i8").tolist(), self.block(1)
        return [None if g else d for d, g in zip(known, gone)], np.frombuffer(self.block(2), "<u8").tolist()


def read_file(data: bytes) -> tuple[WaveletMatrix, list, list[int]]:
    """The matrix, the document ids and the lengths of a shard."""
    shard = ShardFile(data)
    return shard.matrix, *shard.documents()
