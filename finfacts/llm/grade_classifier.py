"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text is the set of its distinct words: each gives hashed weights for its letters and for
how it begins, and its shape (runs of capitals, small letters, digits, other signs) counts
by its share. All grades share these weights; ordered thresholds turn the one score into the probabilities
of reaching each grade, so into an expected grade and the tail that selects documents.
The model is fitted on the driver to a bounded, documented sample of rated documents.
"""

from __future__ import annotations

import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.llm.common import Batches, Mapper, nested, shape, stored, table, texts, unnested

HASH_BITS = 18
# Bound of the fitted sample, chosen by a hash of the id.
FIT_DOCUMENTS = 6000
# A feature that fewer sampled documents hold is left out.
MIN_DOCUMENTS = 5
# Standard deviations from chance that a feature's sum of grades must reach.
MIN_SIGMAS = 4.0
RIDGE = 3.0
ROUNDS = 100
SHAPE_WEIGHT = 20.0
LEVELS = 10
KEEP_PROBABILITY = 0.6
# Letters of a word's beginning.
BEGINNING = 4
# Words whose places a task remembers.
KNOWN = 200_000

_CLASSES = bytes(
    ord("a") if chr(b).islower() or b >= 128 else ord("A") if chr(b).isupper()
    else ord("0") if chr(b).isdigit() else b for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.S)
_EDGE = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def _hash(kind: bytes, value: bytes) -> int:
    return zlib.crc32(value, zlib.crc32(kind)) & ((1 << HASH_BITS) - 1)


def word_features(word: bytes) -> tuple[int, int, int]:
    """Places of a word's letters, of its beginning and of its shape."""
    shape = _RUN.sub(rb"\1", word.translate(_CLASSES))
    letters = word.strip(_EDGE).lower()
    begin = letters.decode("utf-8", "replace")[:BEGINNING].encode()
    return _hash(b"w", letters), _hash(b"b", begin), _hash(b"s", shape)


def _levels(words: list[bytes], distinct: dict) -> list[int]:
    """Places of the share of distinct words, and of the presence of any."""
    if not words:
        return [_hash(b"n", b"none")]
    return [_hash(b"n", b"share %d" % (LEVELS * len(distinct) // len(words)))]


def features(text: bytes) -> tuple[list[int], list[float]]:
    """Places and values of a text's features, each place once."""
    words = text.split()
    distinct = dict.fromkeys(words)
    letters, shapes = set(), {}
    for word in distinct:
        letter, begin, shape = word_features(word)
        letters |= {letter, begin}
        shapes[shape] = shapes.get(shape, 0) + 1
    values = dict.fromkeys(letters, 1.0)
    for place, n in shapes.items():
        values[place] = values.get(place, 0.0) + SHAPE_WEIGHT * n / len(distinct)
    for place in _levels(words, distinct):
        values[place] = values.get(place, 0.0) + 1.0
    return list(values), list(values.values())


class Model(NamedTuple):
    """Shared weights and ordered thresholds, one below each grade but the lowest."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """Probability of reaching each grade above the lowest."""
        return _sigmoid(score[:, None] - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[tuple[list[int], list[float]]], grades: np.ndarray) -> Model | None:
    """The model of least penalised loss; None without two different grades."""
    top = int(grades.max()) if len(grades) else 0
    if not len(grades) or len(np.unique(grades)) < 2:
        return None
    places = np.concatenate([np.asarray(p, np.int64) for p, _ in rows])
    values = np.concatenate([np.asarray(v, float) for _, v in rows])
    owner = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    used, column, held = np.unique(places, return_inverse=True, return_counts=True)
    # Features whose sum of grades is no chance; each is scaled to a mean square of one.
    square = np.bincount(column, values ** 2)
    deviation = np.bincount(column, values * (grades - grades.mean())[owner])
    sure = (held >= MIN_DOCUMENTS) & (np.abs(deviation) >= MIN_SIGMAS * grades.std() * np.sqrt(square))
    taken = sure[column]
    new_place = np.cumsum(sure) - 1
    column, values, owner = new_place[column[taken]], values[taken], owner[taken]
    used, scale = used[sure], np.sqrt(square[sure] / len(rows))
    values = values / scale[column]
    n, every = len(rows), np.arange(len(rows))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean penalised loss and its gradient by weights, first threshold, logs of the steps."""
        weights, bounds = x[:len(used)], x[len(used):]
        thresholds = _ordered(bounds)
        score = np.bincount(owner, values * weights[column], n)
        reach = np.column_stack([np.ones(n), _sigmoid(score[:, None] - thresholds), np.zeros(n)])
        upper, lower = reach[every, grades], reach[every, grades + 1]
        mass = np.maximum(upper - lower, 1e-12)
        value = -np.log(mass).mean() + RIDGE * (weights @ weights) / (2 * n)
        pull = -(1 - upper - lower) / n
        by_weight = np.bincount(column, values * pull[owner], len(used)) + RIDGE * weights / n
        slope = np.zeros((n, top + 2))
        slope[every, grades] += upper * (1 - upper) / mass / n
        slope[every, grades + 1] -= lower * (1 - lower) / mass / n
        after = np.cumsum(slope[:, 1:top + 1].sum(axis=0)[::-1])[::-1]
        return value, np.concatenate([by_weight, after[:1], after[1:] * np.exp(bounds[1:])])

    found = _minimise(loss, np.concatenate([np.zeros(len(used)), [-1.0], np.zeros(top - 1)]))
    whole = np.zeros(1 << HASH_BITS)
    whole[used] = found[:len(used)] / scale
    return Model(whole, _ordered(found[len(used):]))


def _ordered(bounds: np.ndarray) -> np.ndarray:
    return bounds[0] + np.concatenate([[0.0], np.cumsum(np.exp(bounds[1:]))])


def _minimise(loss, x: np.ndarray, memory: int = 10) -> np.ndarray:
    """Limited-memory quasi-Newton steps, halved until the loss falls enough."""
    value, gradient = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(ROUNDS):
        step, kept = gradient.copy(), []
        for s, y in reversed(past):
            share = (s @ step) / (s @ y)
            kept.append(share)
            step -= share * y
        if past:
            s, y = past[-1]
            step *= (s @ y) / (y @ y)
        for (s, y), share in zip(past, reversed(kept)):
            step += (share - (y @ step) / (s @ y)) * s
        size = 1.0 if past else min(1.0, 1 / np.abs(step).max())
        while size > 1e-8:
            new, slope = loss(x - size * step)
            if new <= value - 1e-4 * size * (gradient @ step):
                break
            size /= 2
        else:
            return x
        moved, turned = -size * step, slope - gradient
        if moved @ turned > 1e-12:
            past = [*past[-(memory - 1):], (moved, turned)]
        done = value - new < 1e-5 * abs(value)
        x, value, gradient = x + moved, new, slope
        if done:
            return x
    return x


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``grade``: 0 poor, 1 good but toxic, 2 good; the lowest of several."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2)
    known = labels.select("doc_id", grade.alias("grade")).dropna()
    return known.groupBy("doc_id").agg(F.min("grade").alias("grade"))


def _extract(batches: Batches) -> Batches:
    for b in batches:
        got = list(zip(*map(features, texts(b.column("text"))))) or [(), ()]
        yield pa.RecordBatch.from_arrays(
            [b.column("grade"), pa.array(got[0], pa.list_(pa.int32())), pa.array(got[1], pa.list_(pa.float64()))],
            names=["grade", "places", "values"],
        )


def _telling(sample: DataFrame) -> np.ndarray:
    """The places that ``fit`` would use, a little more: held often, and with a sum of grades that is no chance."""
    grade = F.col("grade").cast("double")
    n, mean, spread = sample.agg(
        F.count("*"), F.avg(grade), F.coalesce(F.stddev_pop(grade), F.lit(0.0))).first()
    each = sample.select(grade.alias("grade"), F.explode(F.arrays_zip("places", "values")).alias("x"))
    value = F.col("x.values")
    sums = each.groupBy(F.col("x.places").alias("place")).agg(
        F.count("*").alias("held"), F.sum(value * value).alias("square"),
        F.sum(value * (F.col("grade") - F.lit(mean or 0.0))).alias("deviation"))
    kept = sums.filter((F.col("held") >= MIN_DOCUMENTS) & (
        F.abs("deviation") >= 0.999 * MIN_SIGMAS * spread * F.sqrt("square")))
    # At most one row for each place of the hash.
    return np.sort(kept.select("place").toArrow().column("place").to_numpy())


def _only(places: np.ndarray) -> Mapper:
    """Features at these places."""
    def run(batches: Batches) -> Batches:
        for b in batches:
            lists = b.column("places")
            own, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            own_offsets = offsets - offsets[0]
            kept = np.isin(own, places)
            upto = pa.array(np.append(0, np.cumsum(kept))[own_offsets], pa.int32())
            values = b.column("values").flatten().to_numpy()[kept]
            yield pa.RecordBatch.from_arrays(
                [b.column("grade"), pa.ListArray.from_arrays(upto, pa.array(own[kept], pa.int32())),
                 pa.ListArray.from_arrays(upto, pa.array(values))],
                names=["grade", "places", "values"])
    return run


def fit_documents(docs: DataFrame, ratings: DataFrame, limit: int = FIT_DOCUMENTS) -> Model | None:
    """Fit on at most ``limit`` rated documents; the choice depends on their ids only.

    ``ratings``: doc_id, grade (0 and up). The sample's features are stored; only those that
    can be used reach the driver, so texts of any length leave little there.
    """
    chosen = ratings.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rated = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    fields = "grade int, places array<int>, values array<double>"
    sample = stored(rated.select("grade", F.col("text").cast("binary").alias("text")).mapInArrow(
        _extract, fields).orderBy(F.xxhash64("places", "values")).limit(limit))
    found = sample.mapInArrow(_only(_telling(sample)), fields).toArrow()
    own = lambda name: [x.values.to_numpy() for x in found.column(name)]
    return fit(list(zip(own("places"), own("values"))), np.array(found.column("grade").to_pylist(), np.int64))


class _Weights(dict):
    """Of words: the places of letters and beginning as one real number, the shape's weight as imaginary."""

    def __init__(self, weights: np.ndarray) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> complex:
        if len(self) >= KNOWN:
            self.clear()
        letter, begin, shape = word_features(word)
        got = self[word] = complex(letter + (begin << HASH_BITS), self.weights[shape])
        return got


def score_text(text: bytes, known: _Weights) -> float:
    """The score of a text; the same as its features times the weights."""
    words = text.split()
    distinct = dict.fromkeys(words)
    got = np.fromiter(map(known.__getitem__, distinct), np.complex128, len(distinct))
    total = sum(known.weights[p] for p in _levels(words, distinct))
    if len(distinct):
        # Places of letters and beginnings count once; a shape by its share.
        both = got.real.astype(np.int64)
        letters = np.unique(np.concatenate([both & ((1 << HASH_BITS) - 1), both >> HASH_BITS]))
        total += known.weights[letters].sum() + SHAPE_WEIGHT * got.imag.sum() / len(distinct)
    return float(total)


def _score(model: Model, only_kept: bool, least: float) -> Mapper:
    def run(batches: Batches) -> Batches:
        known = _Weights(model.weights)
        for b in batches:
            scores = np.array([score_text(t, known) for t in texts(b.column("text"))])
            tails = np.round(model.tails(scores.reshape(-1)), 9)
            kept = tails[:, -1] >= least
            if only_kept:
                yield pa.RecordBatch.from_arrays([b.column("row")], names=["row"]).filter(pa.array(kept))
                continue
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, tails.size + 1, tails.shape[1]), pa.int32()), pa.array(tails.ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(np.round(tails.sum(axis=1), 9)), lists, pa.array(kept)],
                names=["row", "expected_grade", "tails", "kept"],
            )
    return run


def grade_documents(
    docs: DataFrame, model: Model | None, keep_probability: float = KEEP_PROBABILITY,
) -> DataFrame:
    """``docs`` with ``expected_grade``, ``tails`` (P of each grade above the lowest), ``kept``.

    ``kept`` asks for the top grade with at least ``keep_probability``. A null text is one
    without words. Without a model all rows are kept, with null figures. Columns with the
    names of the results are replaced; rows keep their number.
    """
    added = ("expected_grade", "tails", "kept")
    if model is None:
        return docs.drop(*added).select(
            "*", F.lit(None).cast("double").alias("expected_grade"),
            F.lit(None).cast("array<double>").alias("tails"), F.lit(True).alias("kept"))
    rows = nested(docs, F.col("`text`").cast("binary").alias("text"))
    scored = rows.mapInArrow(
        _score(model, False, keep_probability),
        shape(rows, ["row"], "expected_grade double, tails array<double>, kept boolean"))
    return unnested(scored, docs.columns, *added)


def select_documents(
    docs: DataFrame, model: Model | None, keep_probability: float = KEEP_PROBABILITY,
) -> DataFrame:
    """The rows of ``docs`` that ``grade_documents`` keeps, unchanged."""
    if model is None:
        return docs
    rows = nested(docs, F.col("`text`").cast("binary").alias("text"))
    kept = rows.mapInArrow(_score(model, True, keep_probability), shape(rows, ["row"]))
    return unnested(kept, docs.columns)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of all documents, and whether they are selected."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_documents(docs, graded(table(spark, sf_dir, "labels")))
    rated = grade_documents(docs, model)
    return rated.select(
        "doc_id", "expected_grade", F.element_at("tails", 1).alias("p_at_least_1"),
        F.element_at("tails", -1).alias("p_top"), "kept",
    )
