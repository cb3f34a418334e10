"""Line dedup with two Bloom filters and exact confirmation of the suspected repeats.

Every task notes the hashes of its line keys in two sparse bit sets: keys that occur
in a document, and keys that it has met in two. The sets are merged by segment, where
a bit that two tasks set becomes a bit of the second set. A key that lacks a bit in
the merged second set occurs in one document only and takes no further part; the
128-bit digests of the others are counted exactly. Only these move: the filters
have a fixed size, and a filter that is too full costs rows to count, never results.
"""

from __future__ import annotations

import zlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from finfacts.llm.common import (
    Batches, Mapper, SPACES, batch, content_key, nested, partitions, shape, stored, table, texts, unnested,
)

FILTER_BITS = 1 << 29
HASHES = 3
SEGMENT_BITS = 1 << 21
PENDING = 1 << 20
SALTS = 32


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, A-Z lower-cased."""
    return line.strip(SPACES).lower()


def _keys(text: bytes, min_chars: int) -> list[bytes]:
    keys = dict.fromkeys(line_key(x) for x in text.split(b"\n"))
    return [k for k in keys if len(k) >= min_chars and (
        min_chars < 2 or len(k.decode("utf-8", "replace")) >= min_chars)]


def _digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def _positions(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return [
        ((hashes + np.uint64(i) * step) % np.uint64(bits)).astype(np.int64) for i in range(HASHES)
    ]


def _seen(min_chars: int, bits: int) -> Mapper:
    """Sparse bits per segment: set by a document, and set by two documents of this task."""
    def rows(hashes: np.ndarray) -> pa.RecordBatch:
        unique, counts = np.unique(hashes, return_counts=True)
        once = np.unique(np.concatenate(_positions(unique, bits)))
        twice = np.unique(np.concatenate(_positions(unique[counts > 1], bits)))
        segments = np.unique(once // SEGMENT_BITS)
        edges = lambda a: np.searchsorted(a // SEGMENT_BITS, np.append(segments, segments[-1:] + 1))
        cuts, cuts2 = edges(once), edges(twice)
        offsets = lambda a, c: [
            (a[i:j] % SEGMENT_BITS).astype("<u4").tobytes() for i, j in zip(c[:-1], c[1:])
        ]
        return batch(segment=(segments, pa.int32()), once=(offsets(once, cuts), pa.binary()),
                     twice=(offsets(twice, cuts2), pa.binary()))

    def run(batches: Batches) -> Batches:
        pending: list[int] = []
        for b in batches:
            for text in texts(b.column("text")):
                pending += map(xxh3_64_intdigest, _keys(text, min_chars))
                if len(pending) >= PENDING:
                    yield rows(np.array(pending, np.uint64))
                    pending = []
        if pending:
            yield rows(np.array(pending, np.uint64))
    return run


def _merge(batches: Batches) -> Batches:
    """Bits that two sources set, or one that met them twice; rows come sorted by segment."""
    segment, once, twice = None, None, None

    def result() -> pa.RecordBatch:
        packed = zlib.compress(np.packbits(twice, bitorder="little").tobytes(), 1)
        return batch(segment=([segment], pa.int32()), bits=([packed], pa.binary()))

    for b in batches:
        for s, o, t in zip(*(b.column(n).to_pylist() for n in ("segment", "once", "twice"))):
            if s != segment:
                if segment is not None and twice.any():
                    yield result()
                segment = s
                once, twice = np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
            at = np.frombuffer(o, "<u4")
            twice[at[once[at]]] = True
            once[at] = True
            twice[np.frombuffer(t, "<u4")] = True
    if segment is not None and twice.any():
        yield result()


def _filter(segments: list, bits: int) -> np.ndarray:
    """The merged filter, unpacked for one task: a worker keeps nothing of it."""
    whole = np.zeros(bits // 8, np.uint8)
    size = SEGMENT_BITS // 8
    for s, packed in segments:
        whole[s * size:(s + 1) * size] = np.frombuffer(zlib.decompress(packed), np.uint8)
    return whole


def _suspects(shared, min_chars: int, bits: int) -> Mapper:
    """Digests of the keys of a document that the second filter holds; other documents give no row."""
    def run(batches: Batches) -> Batches:
        whole = _filter(shared.value, bits)
        for b in batches:
            keys = [_keys(t, min_chars) for t in texts(b.column("text"))]
            hashes = np.fromiter(
                (xxh3_64_intdigest(k) for own in keys for k in own), np.uint64
            )
            hit = np.ones(len(hashes), bool)
            for at in _positions(hashes, bits):
                hit &= (whole[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            found, place = [], 0
            for own in keys:
                flags = hit[place:place + len(own)]
                place += len(own)
                found.append([_digest(own[i]) for i in np.flatnonzero(flags)])
            out = pa.RecordBatch.from_arrays(
                [b.column("k1"), b.column("k2"), b.column("id"), pa.array(found, pa.list_(pa.binary()))],
                names=["k1", "k2", "id", "digests"],
            )
            yield out.filter(pa.array([bool(x) for x in found], pa.bool_()))
    return run


def _rebuild(keep_first: bool) -> Mapper:
    """Texts without the lines whose digests are listed."""
    def run(batches: Batches) -> Batches:
        for b in batches:
            lines_n, dropped_n, kept = [], [], []
            whole = texts(b.column("text"))
            for text, drop, first in zip(
                whole, b.column("drop").to_pylist(), b.column("first").to_pylist()
            ):
                lines = text.split(b"\n")
                lines_n.append(len(lines))
                if not drop:
                    kept.append(text)
                    dropped_n.append(0)
                    continue
                drop, first, stay = set(drop), set(first or ()) if keep_first else set(), []
                for line in lines:
                    digest = _digest(line_key(line))
                    if digest in first:
                        first.discard(digest)
                        stay.append(line)
                    elif digest not in drop:
                        stay.append(line)
                kept.append(b"\n".join(stay))
                dropped_n.append(len(lines) - len(stay))
            new = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), new, pa.array(lines_n, pa.int64()), pa.array(dropped_n, pa.int64())],
                names=["row", "text", "n_lines", "n_dropped"],
            )
    return run


def repeated_line_filter(keyed: DataFrame, min_chars: int = 1, bits: int = FILTER_BITS) -> list:
    """The merged second filter as compressed segments; at most ``bits`` bits in all."""
    spark = keyed.sparkSession
    seen = keyed.select("text").mapInArrow(
        _seen(min_chars, bits), "segment int, once binary, twice binary"
    )
    merged = seen.repartition(partitions(spark), "segment").sortWithinPartitions("segment") \
        .mapInArrow(_merge, "segment int, bits binary")
    return [(r["segment"], bytes(r["bits"])) for r in merged.collect()]


def dedup_lines(
    docs: DataFrame, min_docs: int = 2, keep_first: bool = True, min_chars: int = 1,
    id_column: str = "doc_id", bits: int = FILTER_BITS,
) -> DataFrame:
    """``docs`` without the lines that occur in at least ``min_docs`` rows.

    A line's key is the line stripped and lower-cased; keys shorter than
    ``min_chars`` code points always stay. With ``keep_first`` the first occurrence
    stays, by id (nulls first), then by content and line. Columns ``n_lines`` and
    ``n_dropped`` are added, or replaced where the input has such names. A null text is
    one empty line and becomes empty; each row counts as a document, and equal rows
    share their fate. An empty table gives an empty table.
    """
    spark, columns = docs.sparkSession, docs.columns
    k1, k2 = content_key(F.col(f"`{id_column}`"), F.col("`text`"))
    keyed = docs.select(F.col("`text`").cast("binary").alias("text"), k1, k2,
                        F.col(f"`{id_column}`").alias("id"))
    merged = repeated_line_filter(keyed, min_chars, bits)
    shared = spark.sparkContext.broadcast(merged)
    suspects = stored(keyed.mapInArrow(
        _suspects(shared, min_chars, bits), shape(keyed, ["k1", "k2", "id"], "digests array<binary>")
    ))
    each = suspects.select("k1", "k2", F.explode("digests").alias("digest"))
    counts = each.groupBy("digest").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs)
    own = suspects.groupBy("k1", "k2").agg(F.first("id").alias("id"), F.first("digests").alias("digests")) \
        .select("k1", "k2", "id", F.explode("digests").alias("digest"))
    # A line that a third of the documents hold meets its count in many tasks.
    salt = F.pmod("k1", F.lit(SALTS)).cast("int")
    spread = counts.select("digest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    hits = own.withColumn("salt", salt).join(spread, ["digest", "salt"]).drop("salt")
    lists = hits.groupBy("k1", "k2").agg(F.collect_list("digest").alias("drop"))
    if keep_first:
        # The first row of a line takes the line along; the others need not meet it again.
        firsts = hits.groupBy("digest").agg(F.min(F.struct("id", "k1", "k2")).alias("lead"))
        led = firsts.groupBy("lead.k1", "lead.k2").agg(F.collect_list("digest").alias("first"))
        lists = lists.join(led, ["k1", "k2"], "left")
    else:
        lists = lists.withColumn("first", F.lit(None).cast("array<binary>"))
    joined = nested(docs, k1, k2).join(lists, ["k1", "k2"], "left").select(
        "row", F.col("row").getField("text").cast("binary").alias("text"), "drop", "first"
    )
    rebuilt = joined.mapInArrow(
        _rebuild(keep_first), shape(joined, ["row"], "text string, n_lines long, n_dropped long")
    )
    return unnested(rebuilt, columns, "text", "n_lines", "n_dropped").select(
        *[f"`{c}`" for c in columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped"
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines of all documents found in at least ten documents lose all their occurrences."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clean = dedup_lines(docs, min_docs=10, keep_first=False)
    return clean.select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, row, pos, line,
    translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (
    SELECT doc_id, row, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
    FROM (SELECT doc_id, row_number() OVER () AS row,
      string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
  )
), hot AS (
  SELECT key FROM lines WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT row) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(hot.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (hot.key IS NULL), ''))
    AS kept_sha256
FROM lines LEFT JOIN hot USING (key) GROUP BY row, doc_id
"""
