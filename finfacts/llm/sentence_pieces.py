"""SentencePiece encoding and decoding by unigram Viterbi over a double-array trie.

Pieces and their log scores come from a model file. A text gets a marker in front and for
every space; its best segmentation has the highest sum of scores. No piece continues past
a marker that follows other characters, so the best path of a text is that of its words,
and many words go through the trie at once, level by level. A character without a piece
is written as its UTF-8 bytes.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.llm.common import Batches, Mapper, nested, shape, table, unnested
from finfacts.llm.tokens import WordEncoder, packed, spaced

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
# Longer words are searched one by one, in time and memory linear in their length.
LONG = 64
AT_ONCE = 20_000
_UNITS = re.compile(rb" *[^ ]+| +")


class DoubleArray:
    """Trie over byte strings: child ``c`` of state ``s`` is ``base[s] + c`` if its check is ``s``."""

    def __init__(self, words: list[bytes]) -> None:
        order = sorted(range(len(words)), key=words.__getitem__)
        size = 4 * sum(map(len, words)) // 3 + 1024
        self.base, self.check, self.value = (np.full(size, v, np.int32) for v in (0, -1, -1))
        self.check[0] = 0
        used, free = bytearray(size), 1
        used[0] = 1
        todo = [(0, 0, len(order), 0)]
        while todo:
            state, low, high, depth = todo.pop()
            children, at = [], low
            while at < high and len(words[order[at]]) == depth:
                self.value[state] = order[at]
                at += 1
            while at < high:
                label, begin = words[order[at]][depth], at
                while at < high and words[order[at]][depth] == label:
                    at += 1
                children.append((label, begin, at))
            if not children:
                continue
            # The search goes on where free places were rare last time.
            base = max(1, free - children[0][0])
            tries = 0
            while any(used[base + c] for c, _, _ in children):
                base, tries = base + 1, tries + 1
                if base + 256 >= len(used):
                    self._extend(used)
            if tries > 16:
                free = base + children[0][0]
            self.base[state] = base
            for label, begin, end in children:
                used[base + label] = 1
                self.check[base + label] = state
                todo.append((base + label, begin, end, depth + 1))
            if base + 512 >= len(used):
                self._extend(used)
        # A step from any state stays inside the arrays.
        self._extend(used)

    def _extend(self, used: bytearray) -> None:
        more = max(4096, len(used) // 2)
        used.extend(bytes(more))
        self.base = np.append(self.base, np.zeros(more, np.int32))
        self.check, self.value = (np.append(a, np.full(more, -1, np.int32)) for a in (self.check, self.value))


class PieceModel:
    """Pieces, scores and the trie of a model file."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        given = SentencePieceProcessor(model_file=path)
        ids = range(given.vocab_size())
        bytes_ = {int(given.id_to_piece(i)[3:5], 16): i for i in ids if given.is_byte(i)}
        self.byte_ids = [bytes_.get(b, given.unk_id()) for b in range(256)]
        normal = [i for i in ids if not (
            given.is_byte(i) or given.is_control(i) or given.is_unknown(i) or given.is_unused(i))]
        spelled = {i: given.id_to_piece(i).replace(MARKER, " ").encode() for i in normal}
        if any(b" " in p.lstrip(b" ") for p in spelled.values()):
            raise ValueError("a piece goes on past a marker, so texts cannot be cut into words")
        self.ids = np.array(normal, np.int64)
        self.scores = np.array([given.get_score(i) for i in normal])
        self.unknown = float(self.scores.min()) - UNKNOWN_PENALTY
        self.longest = max(map(len, spelled.values()))
        self.trie = DoubleArray(list(spelled.values()))
        self.out = [b""] * len(ids)
        for i, p in spelled.items():
            self.out[i] = p
        for b, i in bytes_.items():
            self.out[i] = bytes([b])
        self.out[given.unk_id()] = " ⁇ ".encode()

    def best_paths(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of the best segmentation of each word; the longest last piece wins ties."""
        out = [b""] * len(words)
        short = sorted((i for i, w in enumerate(words) if len(w) <= LONG), key=lambda i: len(words[i]))
        for at in range(0, len(short), AT_ONCE):
            some = short[at:at + AT_ONCE]
            for i, ids in zip(some, self._together([words[i] for i in some])):
                out[i] = ids
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self._alone(w)
        return out

    def _emit(self, word: bytes, cuts: list[tuple[int, int, int]]) -> bytes:
        ids = []
        for start, end, piece in cuts:
            if piece >= 0:
                ids.append(int(self.ids[piece]))
            else:
                ids += [self.byte_ids[b] for b in word[start:end]]
        return packed(ids)

    def _together(self, words: list[bytes]) -> list[bytes]:
        n, width = len(words), max(map(len, words), default=0)
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
        text = text.reshape(n, width).astype(np.int32)
        sizes = np.fromiter(map(len, words), np.int64, n)
        chars = (text & 0xC0) != 0x80
        chars &= np.arange(width) < sizes[:, None]
        steps = 1 + (text >= 0xC0).astype(np.int64) + (text >= 0xE0) + (text >= 0xF0)
        best = np.full((n, width + 4), -np.inf)
        best[:, 0] = 0
        back, piece = np.zeros((n, width + 4), np.int32), np.full((n, width + 4), -1, np.int32)

        def offer(rows: np.ndarray, start: int, ends, score, pieces) -> None:
            total = best[rows, start] + score
            won = total > best[rows, ends]
            rows = rows[won]
            ends = ends[won] if isinstance(ends, np.ndarray) else ends
            best[rows, ends] = total[won]
            back[rows, ends] = start
            piece[rows, ends] = pieces[won] if isinstance(pieces, np.ndarray) else pieces

        trie = self.trie
        for start in range(width):
            begun = np.flatnonzero(chars[:, start] & (best[:, start] > -np.inf))
            rows, state = begun, np.zeros(len(begun), np.int64)
            single = np.zeros(n, bool)
            for end in range(start + 1, min(width, start + self.longest) + 1):
                to = trie.base[state] + text[rows, end - 1]
                on = trie.check[to] == state
                rows, state = rows[on], to[on]
                if not len(rows):
                    break
                value = trie.value[state]
                held = value >= 0
                if held.any():
                    offer(rows[held], start, end, self.scores[value[held]], value[held])
                    single[rows[held & (steps[rows, start] == end - start)]] = True
            alone = begun[~single[begun]]
            if len(alone):
                offer(alone, start, start + steps[alone, start], self.unknown, -1)
        at, columns, starts, ends = sizes.copy(), [], [], []
        every = np.arange(n)
        while (at > 0).any():
            columns.append(np.where(at > 0, piece[every, at], -2))
            ends.append(at)
            at = np.where(at > 0, back[every, at], 0)
            starts.append(at)
        found = np.array(columns[::-1]).T.tolist() if columns else [[]] * n
        simple = ~(np.array(columns) == -1).any(axis=0) if columns else np.ones(n, bool)
        ids, results = self.ids.tolist(), []
        for i, row in enumerate(found):
            if simple[i]:
                own = [ids[p] for p in row if p >= 0]
                results.append(struct.pack(f"<{len(own)}I", *own))
            else:
                cuts = [(int(starts[k][i]), int(ends[k][i]), int(columns[k][i]))
                        for k in range(len(columns) - 1, -1, -1) if columns[k][i] != -2]
                results.append(self._emit(words[i], cuts))
        return results

    def _alone(self, word: bytes) -> bytes:
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        n = len(word)
        best, back, piece = [float("-inf")] * (n + 4), [0] * (n + 4), [-1] * (n + 4)
        best[0] = 0.0
        for start in range(n):
            if word[start] & 0xC0 == 0x80 or best[start] == float("-inf"):
                continue
            first = word[start]
            step = 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)
            state, single = 0, False
            for end in range(start + 1, min(n, start + self.longest) + 1):
                to = int(base[state]) + word[end - 1]
                if check[to] != state:
                    break
                state = to
                held = int(value[state])
                if held >= 0:
                    total = best[start] + float(self.scores[held])
                    if total > best[end]:
                        best[end], back[end], piece[end] = total, start, held
                    single |= end - start == step
            if not single and best[start] + self.unknown > best[start + step]:
                end = start + step
                best[end], back[end], piece[end] = best[start] + self.unknown, start, -1
        cuts, at = [], n
        while at > 0:
            cuts.append((back[at], at, piece[at]))
            at = back[at]
        return self._emit(word, cuts[::-1])

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces in a row, markers as spaces, without the marker in front."""
        raw = b"".join(map(self.out.__getitem__, ids))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


class PieceEncoder(WordEncoder):
    """Ids of texts by a piece model."""

    # A new word costs a search, so more of them are kept.
    known = 700_000

    def __init__(self, model: PieceModel) -> None:
        super().__init__()
        self.model = model

    def compute(self, units: list[bytes]) -> list[bytes | None]:
        return self.model.best_paths(units)

    def encode(self, text: bytes) -> bytes:
        marked = text.replace(MARKER.encode(), b" ")
        return b"".join(self._lookup(_UNITS.findall(b" " + marked))[0]) if text else b""

    def units(self, items: pa.Array) -> list[bytes]:
        return spaced(items, pc.equal(items, ""))

    def cut(self, column: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
        marked = pc.binary_join_element_wise(pa.scalar(" "), column, pa.scalar(""))
        runs = pc.match_substring_regex(marked, f"  | $|{MARKER}").to_numpy(zero_copy_only=False)
        return pc.split_pattern(marked, " "), runs.copy()


_MODELS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    """The encoder of a model file, one per Python worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceEncoder(PieceModel(path))
    return _MODELS[path]


def _encode(path: str, back: bool) -> Mapper:
    def run(batches: Batches) -> Batches:
        own = _encoder(path)
        for b in batches:
            at = 0
            for ids, ends in own.encode_many(b.column("text")):
                offsets = pa.array(np.append(0, ends * 4), pa.int32())
                columns = [b.column("row").slice(at, len(ends)), pa.Array.from_buffers(
                    pa.binary(), len(ends), [None, offsets.buffers()[1], pa.py_buffer(ids)])]
                if back:
                    begins = np.append(0, ends[:-1])
                    columns.append(pa.array(
                        [own.model.decode(ids[i:j].tolist()) for i, j in zip(begins, ends)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["row", "ids", "decoded"][:len(columns)])
                at += len(ends)
    return run


def _decode(path: str) -> Mapper:
    def run(batches: Batches) -> Batches:
        model = _encoder(path).model
        for b in batches:
            decoded = [
                model.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in b.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(decoded, pa.string())], names=["row", "decoded"])
    return run


def encode_pieces(docs: DataFrame, path: str, back: bool = False) -> DataFrame:
    """``docs`` with ``ids``: packed little-endian unsigned 32-bit ids of ``text``.

    With ``back`` also ``decoded``, the text that the ids give, by the same worker. A null
    or empty text has no ids. Columns named ``ids`` or ``decoded`` are replaced. Rows stay
    where they are and keep their number; an empty table stays empty.
    """
    packed_rows = nested(docs, F.col("`text`").alias("text"))
    added = ["ids", "decoded"] if back else ["ids"]
    fields = shape(packed_rows, ["row"], "ids binary" + ", decoded string" * back)
    return unnested(packed_rows.mapInArrow(_encode(path, back), fields), docs.columns, *added)


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of ``ids``; null ids give an empty text.

    A column named ``decoded`` is replaced. Byte pieces that are no UTF-8 become U+FFFD.
    """
    packed_rows = nested(encoded, F.col("ids"))
    decoded = packed_rows.mapInArrow(_decode(path), shape(packed_rows, ["row"], "decoded string"))
    return unnested(decoded, encoded.columns, "decoded")


def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, digested, and whether decoding gives the text back.

    ``round_trip`` holds for every text without a literal marker character.
    """
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = encode_pieces(docs, path, back=True)
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"), (F.col("decoded") == F.col("text")).alias("round_trip"),
    )
