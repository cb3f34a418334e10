"""Quality rules: figures of each text, and how often its lines occur across documents.

A first pass takes every text to a few numbers and the hashes of its distinct
normalised lines with their words. These small rows are stored; distinct documents are
counted for every host and line hash (equal texts of a host are one document), lines
above the limit are removed from the count of a document's words, and a document that
has lost too much is rejected. Texts do not move for the verdict.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from xxhash import xxh3_64_intdigest

from finfacts.llm.common import (
    Batches, SPACES, content_key, nested, shape, stored, table, texts, unnested,
)

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# A line in more distinct documents of one host than this is removed.
MAX_DOCS = 100
# A document that keeps a smaller share of its words than this is rejected.
MIN_KEPT_PERCENT = 30
SALTS = 16

_DIGITS = bytes.maketrans(b"123456789", b"000000000")


def normal_line(line: bytes) -> bytes:
    """Words joined by one space, A-Z lower-cased, digits as 0."""
    return b" ".join(line.lower().translate(_DIGITS).split())


def line_hash(line: bytes) -> int:
    """A signed 64-bit hash of the normalised line."""
    value = xxh3_64_intdigest(normal_line(line))
    return value - (1 << 64) if value >= 1 << 63 else value


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of eight that occur twice or more in the text, first ones included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, len(words))
    if len(known) == len(words):
        return 0
    mixed = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[i:i + n] + np.uint64(1)
    order = np.argsort(mixed, kind="stable")
    ranked = mixed[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    paired = np.zeros(n, bool)
    paired[1:] |= same
    paired[:-1] |= same
    at = np.sort(order[paired])
    # The hash only proposes windows; equal words decide.
    windows = [ids[i:i + WINDOW].tobytes() for i in at.tolist()]
    counts = Counter(windows)
    starts = at[np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))]
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def text_figures(text: bytes) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, line hashes, their words."""
    words = text.split()
    spaces = len(text) - len(text.translate(None, SPACES))
    seen, duplicates, hashes = set(), 0, {}
    for line in text.split(b"\n"):
        size = len(line.split())
        if size:
            duplicates += line in seen
            seen.add(line)
            key = line_hash(line)
            hashes[key] = hashes.get(key, 0) + size
    return (
        len(words), len(text.decode("utf-8", "replace")) - spaces,
        len(text) - len(text.translate(None, SYMBOLS)), duplicates, repeated_words(words),
        list(hashes), list(hashes.values()),
    )


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measure(batches: Batches) -> Batches:
    for b in batches:
        got = list(zip(*map(text_figures, texts(b.column("text"))))) or [()] * 7
        kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
        yield pa.RecordBatch.from_arrays(
            [b.column("k1"), b.column("k2"), b.column("host"),
             *[pa.array(list(v), k) for v, k in zip(got, kinds)]],
            names=["k1", "k2", "host", *FIGURES, "lines", "sizes"],
        )


def _without(batches: Batches) -> Batches:
    for b in batches:
        out = []
        for text, bad in zip(b.column("text").to_pylist(), b.column("removed").to_pylist()):
            if bad:
                bad = set(bad)
                text = b"\n".join(
                    x for x in text.split(b"\n") if not x.split() or line_hash(x) not in bad
                )
            out.append(text)
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), pa.array(out, pa.binary()).cast(pa.string())], names=["row", "text"]
        )


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """Figures and line hashes of every row, under its content key."""
    k1, k2 = content_key(F.col(f"`{host}`"), F.col("`text`"))
    keyed = docs.select(F.col("`text`").cast("binary").alias("text"), k1, k2,
                        F.col(f"`{host}`").cast("string").alias("host"))
    fields = ", ".join(f"{n} long" for n in FIGURES)
    return keyed.mapInArrow(
        _measure, f"k1 long, k2 long, host string, {fields}, lines array<long>, sizes array<long>"
    )


def verdicts(
    figures: DataFrame, max_docs: int = MAX_DOCS, min_kept_percent: int = MIN_KEPT_PERCENT
) -> DataFrame:
    """One row per content key: figures, hashes of removed lines, ``base_failed`` and ``kept``."""
    own = figures.dropDuplicates(["k1", "k2"])
    pairs = own.select("host", F.explode("lines").alias("line"))
    salt = F.pmod(F.col("k1"), F.lit(SALTS)).cast("int").alias("salt")
    common = pairs.groupBy("host", "line").agg(F.count("*").alias("n")) \
        .filter(F.col("n") > max_docs) \
        .select(F.coalesce("host", F.lit("")).alias("h"), F.col("host").isNull().alias("null_host"),
                "line", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    each = own.select(
        "k1", "k2", salt, F.coalesce("host", F.lit("")).alias("h"),
        F.col("host").isNull().alias("null_host"),
        F.explode(F.arrays_zip("lines", "sizes")).alias("x"),
    ).select("k1", "k2", "salt", "h", "null_host", F.col("x.lines").alias("line"),
             F.col("x.sizes").alias("size"))
    lost = each.join(common, ["h", "null_host", "line", "salt"]).groupBy("k1", "k2").agg(
        F.sum("size").alias("lost"), F.collect_list("line").alias("removed")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    removed_words = F.coalesce("lost", F.lit(0))
    depleted = 100 * (F.col("n_words") - removed_words) < min_kept_percent * F.col("n_words")
    return own.select("k1", "k2", *FIGURES).join(lost, ["k1", "k2"], "left").select(
        "k1", "k2", *FIGURES, "removed", removed_words.alias("n_removed_words"),
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
    )


def rule_quality(
    docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS,
    min_kept_percent: int = MIN_KEPT_PERCENT,
) -> DataFrame:
    """``docs`` with their figures, ``n_removed_words``, ``base_failed``, ``kept`` and clean text.

    A normalised line in more than ``max_docs`` distinct texts of its host is removed from
    the text; a document that keeps less than ``min_kept_percent`` of its words, or
    fails the base rules, is not kept. Equal texts of a host count once and share a
    verdict, so copies do not condemn each other. A null text has no words, fails, and becomes empty; rows with a null host
    form one host. Columns named like results are replaced.
    """
    judged = verdicts(stored(measured(docs, host)), max_docs, min_kept_percent)
    k1, k2 = content_key(F.col(f"`{host}`"), F.col("`text`"))
    added = [*FIGURES, "n_removed_words", "base_failed", "kept"]
    joined = nested(docs, k1, k2).join(judged, ["k1", "k2"])
    packed = joined.select(
        F.struct("row", *added).alias("row"), "removed",
        F.coalesce(F.col("row").getField("text"), F.lit("")).cast("binary").alias("text"),
    )
    clean = packed.mapInArrow(_without, shape(packed, ["row"], "text string"))
    flat = clean.select(F.col("row.row").alias("row"), "text", *[F.col(f"row.{c}").alias(c) for c in added])
    return unnested(flat, docs.columns, "text", *added).select(
        *[f"`{c}`" for c in docs.columns if c not in added], *added
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    figures = stored(measured(docs))
    k1, k2 = content_key("source", "text")
    return docs.select("doc_id", k1, k2).join(verdicts(figures), ["k1", "k2"]).select(
        "doc_id", *FIGURES, "base_failed", "kept"
    )
