"""Token ids of whole texts by the tokenizers library, word by word.

Both vocabularies cut a text at white space first, so the ids of a text are those of its
words in a row. A worker keeps the ids of the words it has met as packed bytes. Words of
plain letters, with punctuation behind, go straight to the library's model; all other
words go through the whole library, and so does a text in which a cut could matter.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from finfacts.llm.common import SPACES

# Words kept by a worker, of which the older half goes at that number, and their parts.
KNOWN = 300_000
PIECES = 1_200_000
# Bytes of text that are looked up together.
CHUNK = 8 << 20

_MARKS = b".,;:!?|*$%&#"
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_LOWER = re.compile("[a-zß-öø-ÿ]+")
# Printable ASCII without the apostrophe, which may bind letters.
_PLAIN = re.compile(rb"[!-&(-~]+")
_RUNS = re.compile(rb"[A-Za-z]+|[0-9]|[^A-Za-z0-9]+")
_NUMBERS = re.compile(rb"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]+")
# Where a cut before every space and line feed is not what the library does.
_MIXED = r"[\t\r\x0b\x0c]|  | \n|\n |\n\n\n|\n\n$| $"
_UNITS = re.compile(rb"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
# White space of Unicode beside the six ASCII characters, and line and file separators.
_WIDE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_TABLE = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
_SPACE = _byte_letters()[ord(" ")]
_PACKERS = [struct.Struct(f"<{n}I").pack for n in range(32)]


def packed(ids) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    return _PACKERS[len(ids)](*ids) if len(ids) < 32 else struct.pack(f"<{len(ids)}I", *ids)


def listed(items: pa.Array) -> list[bytes]:
    """The bytes of every item; by way of numpy, as ``to_pylist`` makes a scalar of each first."""
    return items.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def spaced(items: pa.Array, bare: pa.Array) -> list[bytes]:
    """The items with a space before each, but for ``bare`` ones."""
    return listed(pc.binary_join_element_wise(pc.if_else(bare, "", " "), items, ""))


class WordEncoder:
    """Ids of texts as packed bytes, from the ids of their units, which a worker remembers.

    A subclass gives the ids of a whole text, of a unit and the cut of a column.
    """

    # Ids at the start of every text that its cut has added.
    lead = 0
    known = KNOWN

    def __init__(self) -> None:
        self.new: dict[bytes, bytes | None] = {}
        self.old: dict[bytes, bytes | None] = {}

    def encode(self, text: bytes) -> bytes:
        """Packed ids of a whole text."""
        raise NotImplementedError

    def cut(self, column: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
        """The units of every text, and which texts must not be cut."""
        raise NotImplementedError

    def units(self, items: pa.Array) -> list[bytes]:
        """The units behind items of the cut."""
        return listed(items)

    def compute(self, units: list[bytes]) -> list[bytes | None]:
        """Ids of units; None where only the whole text decides."""
        raise NotImplementedError

    def _lookup(self, units: list[bytes]) -> tuple[list[bytes], list[int]]:
        parts = list(map(self.new.get, units, repeat(b"")))
        missing = [i for i, part in enumerate(parts) if not part and part is not None and units[i]]
        asked = [units[i] for i in missing]
        found = list(map(self.old.get, asked, repeat(b"")))
        unknown = [i for i, part in enumerate(found) if part == b""]
        for i, part in zip(unknown, self.compute([asked[i] for i in unknown])):
            found[i] = part
        if len(self.new) >= self.known // 2:
            self.old, self.new = self.new, {}
        self.new.update(zip(asked, found))
        for i, part in zip(missing, found):
            parts[i] = part
        open_ = [i for i, part in enumerate(parts) if part is None]
        for i in open_:
            parts[i] = b""
        return parts, open_

    def encode_many(self, column: pa.Array, chunk: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For slices of a text column: all ids in a row, and where each text's ids end.

        A slice has at most ``chunk`` bytes (``CHUNK``) or is one text; less takes less memory, more is faster.
        """
        chunk = chunk or CHUNK
        column = pc.fill_null(column, "")
        sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(column):
            before = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + chunk, "right")))
            yield self._slice(column.slice(at, to - at))
            at = to

    def _slice(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists, whole = self.cut(column)
        ends = lists.offsets.to_numpy()
        ends = ends - ends[0]
        encoded = lists.flatten().dictionary_encode()
        units = self.units(encoded.dictionary)
        parts, open_ = self._lookup(units)
        if open_:
            bad = np.append(0, np.cumsum(np.isin(encoded.indices.to_numpy(zero_copy_only=False), open_)))
            whole |= np.diff(bad[ends]) > 0
        # 64-bit offsets: a single text may have gigabytes of ids.
        found = pa.array(parts, pa.large_binary()).take(encoded.indices)
        upto = np.zeros(1, np.int64)
        if len(found):
            upto = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1) // 4
        out = np.frombuffer(found.buffers()[2], "<u4", upto[-1]) if upto[-1] else np.zeros(0, "<u4")
        bounds = upto[ends[1:]]
        if not self.lead and not whole.any():
            return out, bounds
        texts, begin, split = [], 0, []
        for i, end in enumerate(bounds.tolist()):
            if whole[i]:
                texts.append(np.frombuffer(self.encode(column[i].as_py().encode()), "<u4"))
            else:
                texts.append(out[begin + self.lead:end])
            split.append(len(texts[-1]))
            begin = end
        return np.concatenate(texts), np.cumsum(split)


class Encoder(WordEncoder):
    """Ids by the tokenizers library; equal to the library's ids of the whole text.

    ``words`` tells a vocabulary that drops white space and lower-cases from a byte-level
    one. Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, words: bool) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.words, self.lead = words, 0 if words else 1
        # Lower-cased words have fewer parts, and their workers serve further stages.
        self.most = PIECES // 4 if words else PIECES
        self.known = 200_000 if words else KNOWN
        self.pieces: dict[bytes, bytes] = {}
        self.marks: dict[bytes, bytes] = {b"": b""}

    def whole(self, text: str) -> bytes:
        """The library's ids of a text."""
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _model(self, piece: bytes) -> bytes:
        # ASCII letters stand for themselves.
        if piece.isalpha():
            mapped = piece.decode()
        elif piece[:1] == b" " and piece[1:].isalpha():
            mapped = _SPACE + piece[1:].decode()
        else:
            mapped = piece.decode("latin-1").translate(_TABLE)
        return packed([t.id for t in self.model.tokenize(mapped)])

    def _piece(self, piece: bytes) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            got = self._model(piece)
            if len(self.pieces) >= self.most:
                self.pieces.clear()
            self.pieces[piece] = got
        return got

    def _mark(self, marks: bytes) -> bytes:
        got = self.marks.get(marks)
        if got is None:
            got = self._model(marks)
            if len(marks) < 4:
                self.marks[marks] = got
        return got

    def _compute(self, unit: bytes) -> bytes | None:
        """Ids of a word, or None where the text around it matters."""
        core = unit.rstrip(_MARKS)
        if self.words:
            if core.isalpha() or core and _LOWER.fullmatch(core.decode("utf-8", "replace")):
                return self._piece(core.lower()) + self._mark(unit[len(core):])
            if _PLAIN.fullmatch(unit):
                return b"".join(map(self._piece, _RUNS.findall(unit.lower())))
            return self.whole(unit.decode("utf-8", "replace"))
        if core[:1] == b" " and core[1:].isalpha():
            first = self._piece(core)
            return first + self._mark(unit[len(core):]) if len(core) < len(unit) else first
        body = core.lstrip(SPACES)
        space = core[:len(core) - len(body)]
        if space in (b" ", b"", b"\n") and (
            body.isalpha() or body and _LETTERS.fullmatch(body.decode("utf-8", "replace"))
        ):
            first = self._piece(body) if space != b" " else self._piece(core)
            return (self._mark(space) if space == b"\n" else b"") + first + self._mark(unit[len(core):])
        if space in (b" ", b"", b"\n") and _PLAIN.fullmatch(unit[len(space):]):
            pieces = _NUMBERS.findall(unit[len(space):])
            if space == b" ":
                pieces[0] = space + pieces[0]
            elif space:
                pieces.insert(0, space)
            return b"".join(map(self._piece, pieces))
        text = unit.decode("utf-8", "replace")
        return None if _WIDE.search(text) else self.whole(text)

    def compute(self, units: list[bytes]) -> list[bytes | None]:
        return list(map(self._compute, units))

    def encode(self, text: bytes) -> bytes:
        parts, open_ = self._lookup(text.split() if self.words else _UNITS.findall(text))
        return self.whole(text.decode("utf-8", "replace")) if open_ else b"".join(parts)

    def units(self, items: pa.Array) -> list[bytes]:
        if self.words:
            return super().units(items)
        return spaced(items, pc.or_(pc.starts_with(items, "\n"), pc.equal(items, "")))

    def cut(self, column: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
        if self.words:
            return pc.ascii_split_whitespace(column), np.zeros(len(column), bool)
        # Every unit begins with a space or line feed; the first line feed is taken off again.
        led = pc.binary_join_element_wise(pa.scalar("\n"), column, pa.scalar(""))
        mixed = pc.match_substring_regex(led, _MIXED).to_numpy(zero_copy_only=False)
        return pc.split_pattern(pc.replace_substring(led, "\n", " \n"), " "), mixed.copy()


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, words: bool) -> Encoder:
    """The encoder of a vocabulary file, one per Python worker."""
    if (path, words) not in _ENCODERS:
        _ENCODERS[path, words] = Encoder(path, words)
    return _ENCODERS[path, words]
