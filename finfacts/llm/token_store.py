"""Token ids of documents in shards, one wavelet matrix each.

Documents are dealt out by ranges of their id and sorted, so that partitions and the
shards in them follow the ids. A task turns its texts into ids and closes a shard
whenever it holds enough of them; a shard is a compressed file of its own, kept as a
binary value in a Parquet table, so that any store Spark reads will do.
"""

from __future__ import annotations

import public_tokenizers
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from finfacts.llm.common import Batches, Mapper, batch, partitions, stored, table
from finfacts.llm.tokens import encoder
from finfacts.llm.wavelet import read_file, write_file

SHARD_TOKENS = 1 << 20
END_ID = 2


def _write(path: str, words: bool, end_id: int, levels: int) -> Mapper:
    def run(batches: Batches) -> Batches:
        own, part, shard, first = encoder(path, words), TaskContext.get().partitionId(), 0, 0
        arrays, ids, lengths, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            data = write_file(np.concatenate(arrays), ids, lengths, levels)
            return batch(part=([part], pa.int32()), shard=([shard], pa.int32()),
                         first=([first], pa.int64()), n_docs=([len(ids)], pa.int64()),
                         n_tokens=([held], pa.int64()), file=([data], pa.binary()))

        end = np.array([end_id], "<u4")
        for b in batches:
            names, at = b.column("doc_id").to_pylist(), 0
            for tokens, ends in own.encode_many(b.column("text")):
                begin = 0
                for to in ends.tolist():
                    arrays += [tokens[begin:to], end]
                    ids.append(names[at])
                    lengths.append(to - begin + 1)
                    held += lengths[-1]
                    begin, at = to, at + 1
                    if held >= SHARD_TOKENS:
                        yield close()
                        first, shard = first + held, shard + 1
                        arrays, ids, lengths, held = [], [], [], 0
        if ids:
            yield close()
    return run


def write_shards(
    docs: DataFrame, path: str, words: bool = False, end_id: int = END_ID, levels: int = 16,
) -> DataFrame:
    """The stored shards of ``docs`` (doc_id, text) in ascending order of doc_id.

    Null ids come first, equal ids in the order of a hash of their texts, equal rows stay.
    A null text is empty, so that its document is the end id alone. ``levels`` are the
    bits of the largest id. Columns: ``part``, ``shard`` in it, ``first`` token in the part,
    ``n_docs``, ``n_tokens``, ``file``. An empty table gives no shards.
    """
    tie = F.xxhash64("text")
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(
        partitions(docs.sparkSession), F.asc_nulls_first("doc_id"), tie
    ).sortWithinPartitions(F.asc_nulls_first("doc_id"), tie)
    return stored(dealt.mapInArrow(
        _write(path, words, end_id, levels),
        "part int, shard int, first long, n_docs long, n_tokens long, file binary",
    ))


def with_start(shards: DataFrame) -> DataFrame:
    """Shards with ``start``, the tokens of all shards before; one small row per part is summed."""
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # One row per partition of the writer: the number of partitions bounds what is sent.
    return shards.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("first")).drop("base")


def _read(batches: Batches) -> Batches:
    for b in batches:
        for start, data in zip(b.column("start").to_pylist(), b.column("file").to_pylist()):
            matrix, names, lengths = read_file(data)
            ids = matrix.all().astype("<u4")
            ends = np.cumsum(lengths)
            offsets = pa.array(np.append(0, ends * 4), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(start + ends - lengths, pa.int64()),
                 pa.array(lengths, pa.int64()),
                 pa.Array.from_buffers(pa.binary(), len(names), [None, offsets.buffers()[1], pa.py_buffer(ids)])],
                names=["doc_id", "start", "n_tokens", "ids"],
            )


def read_documents(shards: DataFrame) -> DataFrame:
    """Every document of the shards: ``doc_id``, ``start``, ``n_tokens``, packed ``ids``."""
    return with_start(shards).select("start", "file").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids binary"
    )


def _find(token: int) -> Mapper:
    def run(batches: Batches) -> Batches:
        for b in batches:
            for start, data in zip(b.column("start").to_pylist(), b.column("file").to_pylist()):
                matrix, names, lengths = read_file(data)
                places = np.array(matrix.occurrences(token), np.int64)
                ends = np.cumsum(lengths)
                at = np.searchsorted(ends, places, "right")
                begins = ends - lengths
                yield batch(doc_id=([names[i] for i in at], pa.int64()),
                            place=(places - begins[at], pa.int64()),
                            position=(places + start, pa.int64()))
    return run


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """Where ``token`` occurs: document, place in it, position in all; by select on the planes."""
    return with_start(shards).select("start", "file").mapInArrow(
        _find(token), "doc_id long, place long, position long"
    )


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to wavelet shards and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shards = write_shards(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(shards).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
