"""Toxicity scores from a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample

#: Hash buckets, size of an interaction vector, letters of the two stems of a word, bound of the sample.
BUCKETS, FACTORS, STEMS, SAMPLE_ROWS = 1 << 20, 8, (4, 6), 6000
#: Words a task remembers.
REMEMBERED = 400_000

_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def buckets(word: str) -> list[int]:
    """Those of a word and of its stems."""
    return [zlib.crc32(w.encode()) % BUCKETS for w in (word, *(word[:n] + "-" for n in STEMS if len(word) > n))]


def terms(text: str) -> np.ndarray:
    """Sorted distinct buckets of a whole text."""
    return np.array(sorted({b for w in words(text) for b in buckets(w)}), np.int64)


@dataclass
class Machine:
    """Logit: bias + sum of weights + sum over pairs of <vector, vector>, over the buckets that a text holds and training left."""

    bias: float
    buckets: np.ndarray  # sorted
    weights: np.ndarray
    vectors: np.ndarray

    def places(self, found: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.buckets, found)
        at[at == len(self.buckets)] = 0
        return at[self.buckets[at] == found] if len(self.buckets) else at[:0]


class Scorer:
    """Scores texts one by one and remembers where words lie in the machine; most have no place."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.place = {int(b): i for i, b in enumerate(machine.buckets)}
        self.known: dict[str, list[int]] = {}

    def probability(self, text: str) -> float:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        found = set()
        for word in words(text):
            places = self.known.get(word)
            if places is None:
                places = self.known[word] = [self.place[b] for b in buckets(word) if b in self.place]
            found.update(places)
        z = logit(np.array(sorted(found), np.int64), self.machine)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def logit(places: np.ndarray, machine: Machine) -> float:
    vectors = machine.vectors[places]
    pairs = 0.5 * ((vectors.sum(axis=0) ** 2).sum() - (vectors ** 2).sum())
    return float(machine.bias + machine.weights[places].sum() + pairs)


def train(rows: list[tuple[np.ndarray, int]], epochs: int = 40, settle: int = 12, rate: float = 0.2, batch: int = 256, penalties: tuple[float, float] = (0.5, 2.0),
          support: float = 5, decay: float = 1e-4, seed: int = 5) -> Machine:
    """Fit on the logistic loss over (terms, label), both labels weighing alike in sum; every bucket of the rows has a weight and a vector.

    Adagrad with proximal steps: after each step a weight, and a vector as a whole, shrinks towards zero by its penalty, in units of the largest
    gradient that one row can have. So what only a few rows carry falls to exactly zero and what many rows agree on stays, alone or
    in a pair. For the last `settle` epochs the penalties are a quarter, over what is left. A bucket of n rows counts by n / (n + support).
    One label only: that label's prior.
    """
    rng = np.random.default_rng(seed)
    positive = sum(y for _, y in rows)
    bias = float(np.log((positive + 1) / (len(rows) - positive + 1)))
    if not 0 < positive < len(rows):
        return Machine(bias, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    share = positive / len(rows)
    label = np.array([y for _, y in rows])
    importance = np.where(label == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    shrink_w, shrink_v = (p * float(importance.max()) for p in penalties)
    buckets, at, often = np.unique(np.concatenate([f for f, _ in rows]), return_inverse=True, return_counts=True)
    ends = np.concatenate([[0], np.cumsum([len(f) for f, _ in rows])])
    trust = (often / (often + support)).astype(np.float32)
    weights, vectors = np.zeros(len(buckets), np.float32), rng.normal(0, 0.05, (len(buckets), FACTORS)).astype(np.float32)
    squares_w, squares_v, square_b = np.full(len(buckets), 1e-6, np.float32), np.full(len(buckets), 1e-6, np.float32), 1e-6

    def step(part: np.ndarray) -> None:
        nonlocal bias, square_b
        places = np.concatenate([at[ends[i]:ends[i + 1]] for i in part])
        lengths = ends[part + 1] - ends[part]
        row, filled = np.repeat(np.arange(len(part)), lengths), lengths > 0
        starts = (np.cumsum(lengths) - lengths)[filled]

        def by_row(values: np.ndarray) -> np.ndarray:
            out = np.zeros((len(part), *values.shape[1:]), np.float32)
            if len(starts):
                out[filled] = np.add.reduceat(values, starts, axis=0)
            return out

        value = trust[places]
        scaled = value[:, None] * vectors[places]
        total = by_row(scaled)
        z = bias + by_row(value * weights[places]) + 0.5 * ((total ** 2) - by_row(scaled ** 2)).sum(axis=1)
        d = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[part]) * importance[part]).astype(np.float32)
        square_b += float(d.sum()) ** 2
        bias -= rate * float(d.sum()) / square_b ** 0.5
        if not len(places):
            return
        here, back = np.unique(places, return_inverse=True)
        order = np.argsort(back, kind="stable")
        first = np.searchsorted(back[order], np.arange(len(here)))
        g_w = np.bincount(back, d[row] * value, len(here)).astype(np.float32) + decay * len(part) * weights[here]
        g_v = np.add.reduceat((d[row, None] * value[:, None] * (total[row] - scaled))[order], first, axis=0) + decay * len(part) * vectors[here]
        squares_w[here] += g_w ** 2
        squares_v[here] += (g_v ** 2).mean(axis=1)
        size_w, size_v = rate / np.sqrt(squares_w[here]), 0.25 * rate / np.sqrt(squares_v[here])
        w = weights[here] - size_w * g_w
        weights[here] = np.sign(w) * np.maximum(0, np.abs(w) - size_w * shrink_w)
        v = vectors[here] - size_v[:, None] * g_v
        norm = np.maximum(np.sqrt((v ** 2).sum(axis=1)), 1e-9)
        vectors[here] = v * np.maximum(0, 1 - size_v * shrink_v / norm)[:, None]

    for epoch in range(epochs):
        if epoch == epochs - settle:
            shrink_w, shrink_v = shrink_w / 4, shrink_v / 4
            left = (weights != 0) | (vectors != 0).any(axis=1)
            keep = left[at]
            ends = np.concatenate([[0], np.cumsum(keep)])[ends]
            at = (np.cumsum(left) - 1)[at[keep]]
            buckets, trust, weights, vectors, squares_w, squares_v = (x[left] for x in (buckets, trust, weights, vectors, squares_w, squares_v))
        order = rng.permutation(len(rows))
        for begin in range(0, len(order), batch):
            step(order[begin:begin + batch])
    return Machine(bias, buckets, (trust * weights).astype(float), (trust[:, None] * vectors).astype(float))


def fit(docs: DataFrame, labels: DataFrame, learn_from: Callable[[Column], Column], label: str = "toxic",
        id_column: str = "doc_id", text_column: str = "text", rows: int = SAMPLE_ROWS) -> Machine:
    """Train on labelled documents whose id satisfies `learn_from`, at most `rows` of them, drawn by the hash of the id.

    The sample is bounded (buckets of `rows` whole texts reach the driver) and is all that the machine learns from. Labels that
    contradict each other count as the higher one; rows without id or label are left out; without any the machine answers 0.5.
    """
    sample = labelled_sample(docs, labels, learn_from, label, id_column, text_column, rows)

    @F.arrow_udf("array<int>")
    def of(column: pa.Array) -> pa.Array:
        return pa.array([terms(t) for t in column.to_pylist()], pa.list_(pa.int32()))

    found = sample.select("doc_id", of("text").alias("terms"), "label").collect()
    return train([(np.array(r.terms, np.int64), r.label) for r in sorted(found)])


def score(text: Column, machine: Machine) -> Column:
    """Probability (double) that a whole text is toxic; null counts as empty. Local to a row."""
    @F.arrow_udf("double")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(machine)
        for column in columns:
            yield pa.array([scorer.probability(t.as_py() or "") for t in column], pa.float64())

    return of(text)
