"""Quality by ordinal regression: one hashed weight vector, and ordered thresholds between grades.

A text's score is a weighted sum of hashed features of three views: its words
and their stems; the shapes of its tokens (runs of small letters, capitals and
digits, other signs as they are); and tokens that repeat the one before. In each
view a feature counts by the root of its share. The chance of at least grade g
is the logistic function of the score less threshold g, so all grades share the
weights, and thresholds rise by construction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.text import bytes_of, hashed_words, labelled_texts, mapped, mixed, run_hashes, strings, word_starts
from waymark.llm.toxicity import terms_of

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[128:256], _SHAPE[65:91], _SHAPE[48:58] = 97, 97, 65, 48


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hashed place and value of each feature of each text."""
    raw, offsets = bytes_of(column)
    inside, starts = word_starts(raw, offsets)
    views = [terms_of(column)]
    if len(starts):
        token_text = np.searchsorted(offsets, starts, side="right") - 1
        shape = _SHAPE[raw]
        fresh = inside.copy()
        fresh[1:] &= (shape[1:] != shape[:-1]) | ~inside[:-1]
        fresh[starts] = True
        views.append((run_hashes(shape, fresh, starts), token_text))
        words, bounds = hashed_words(column)
        again = np.append(False, (words[1:] == words[:-1]) & (token_text[1:] == token_text[:-1]))
        views.append((again.astype(np.uint64), token_text))
    out = []
    for view, (hashes, text) in enumerate(views):
        place = (mixed(hashes, 50 + view) >> np.uint64(64 - bits)).astype(np.int64)
        pairs, counts = np.unique(text << np.int64(bits) | place, return_counts=True)
        text, place = pairs >> bits, pairs & ((1 << bits) - 1)
        total = np.bincount(text, weights=counts, minlength=len(column))
        out.append((text, place, np.sqrt(counts / total[text])))
    return tuple(np.concatenate(parts) for parts in zip(*out))


@dataclass(frozen=True)
class GradeModel:
    bits: int
    weights: np.ndarray
    thresholds: np.ndarray  # rising, one fewer than grades

    def tails(self, column: pa.Array) -> np.ndarray:
        """The chance of at least grade 1, 2, ... of each text."""
        text, place, value = features(column, self.bits)
        scores = np.bincount(text, weights=value * self.weights[place], minlength=len(column))
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))


def _sampled(bits: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text, place, value = features(strings(batch.column("text")), bits)
        order = np.argsort(text, kind="stable")
        edges = pa.array(np.searchsorted(text[order], np.arange(batch.num_rows + 1)).astype(np.int32))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("grade").cast(pa.int32()), pa.ListArray.from_arrays(edges, pa.array(place[order].astype(np.int32))),
            pa.ListArray.from_arrays(edges, pa.array(value[order].astype(np.float32))),
        ], names=["doc_id", "grade", "places", "values"])
    return run


def fit(docs: DataFrame, ratings: DataFrame, grades: int = 3, train_documents: int = 8000, bits: int = 18, rounds: int = 150, penalty: float = 1e-5, rate: float = 0.3) -> GradeModel:
    """Fit to ``ratings`` (doc_id, grade from 0) by gradient steps on the likelihood.

    At most ``train_documents`` rated texts, those of least id hash, reach the
    driver as hashed features. Where an id has several ratings the least counts.
    Without ratings all thresholds are at chance one half.
    """
    rated = ratings.filter(F.col("doc_id").isNotNull() & F.col("grade").between(0, grades - 1)).groupBy("doc_id").agg(F.min("grade").alias("grade"))
    sample = mapped(labelled_texts(docs, rated, "grade", train_documents), _sampled(bits), "doc_id long, grade int, places array<int>, values array<float>").toArrow().sort_by("doc_id")
    n, size = sample.num_rows, 1 << bits
    if not n:
        return GradeModel(bits, np.zeros(size), np.arange(grades - 1) * 1e-9)
    grade = sample.column("grade").to_numpy()
    lists = sample.column("places").combine_chunks()
    row = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    place, value = lists.flatten().to_numpy().astype(np.int64), sample.column("values").combine_chunks().flatten().to_numpy().astype(float)
    share = np.clip(np.array([(grade >= g).mean() for g in range(1, grades)]), 0.01, 0.99)
    start = np.maximum.accumulate(-np.log(share / (1 - share)) + np.arange(grades - 1) * 1e-3)
    # The first threshold, then logarithms of the steps to the next ones.
    at = np.concatenate([np.zeros(size), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    mean, square = np.zeros_like(at), np.zeros_like(at)
    logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    for step in range(1, rounds + 1):
        weights, steps = at[:size], np.exp(at[size + 1:])
        edges = np.concatenate([[-np.inf], at[size] + np.append(0, np.cumsum(steps)), [np.inf]])
        scores = np.bincount(row, weights=value * weights[place], minlength=n)
        high, low = logistic(edges[grade + 1] - scores), logistic(edges[grade] - scores)
        chance = np.maximum(high - low, 1e-12)
        up, down = -high * (1 - high) / chance / n, low * (1 - low) / chance / n
        by_edge = np.bincount(grade + 1, weights=up, minlength=grades + 1) + np.bincount(grade, weights=down, minlength=grades + 1)
        inner = by_edge[1:grades]
        slope = np.concatenate([np.bincount(place, weights=value * -(up + down)[row], minlength=size) + penalty * weights, [inner.sum()], np.cumsum(inner[::-1])[::-1][1:] * steps])
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        at = at - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    return GradeModel(bits, at[:size], at[size] + np.append(0, np.cumsum(np.exp(at[size + 1:]))))


def _graded(model: GradeModel, grade: int, chance: float):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        column = strings(batch.column("text"))
        tails = model.tails(column)
        full = np.diff(hashed_words(column)[1]) > 0
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(tails.sum(axis=1)), pa.array(tails.tolist(), pa.list_(pa.float64())), pa.array(full & (tails[:, grade - 1] >= chance)),
        ], names=["doc_id", "expected_grade", "tail_probabilities", "kept"])
    return run


def grade(docs: DataFrame, model: GradeModel, least_grade: int = 1, chance: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, tail_probabilities (of at least grade 1, 2, ...) and kept of each row.

    A row is kept if its chance of at least ``least_grade`` is at least
    ``chance``. A null text or one without words scores as a text of average
    odds and is not kept. A null doc_id passes through. Repeated rows are
    graded each. Other columns are ignored.
    """
    return mapped(docs.select("doc_id", "text"), _graded(model, least_grade, chance), "doc_id long, expected_grade double, tail_probabilities array<double>, kept boolean")
