"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample

#: Shape of the network: bytes a filter sees, bytes between its positions, filters, hidden units,
#: bytes of a block; a chunk is two neighbouring blocks, so chunks overlap by half.
WIDTH, STRIDE, FILTERS, HIDDEN, BLOCK = 6, 2, 32, 16, 256
#: Bound of the training sample: labelled rows, and the longest text in it. Training reads whole texts, as scoring does.
SAMPLE_ROWS, LONGEST = 3000, 32_768
#: Positions that are computed at once.
SLICE = 1 << 14


@dataclass
class Network:
    """Weights; `pairs` holds what two bytes next to each other add to every filter, for each of the WIDTH / 2 pairs of a window."""

    filters: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    combine: np.ndarray  # weights of mean, lowest and highest chunk, and a constant

    def pairs(self) -> list[np.ndarray]:
        return [(self.filters[k][:, None, :] + self.filters[k + 1][None, :, :]).reshape(65536, FILTERS)
                for k in range(0, WIDTH, 2)]


def _windows(raw: bytes) -> tuple[np.ndarray, int]:
    """The pair codes of a text at every STRIDE-th byte, zero padded to whole blocks, and the number of blocks."""
    blocks = max(2, -(-len(raw) // BLOCK))
    padded = np.zeros(blocks * BLOCK + WIDTH, np.uint8)
    padded[:len(raw)] = np.frombuffer(raw, np.uint8)
    return padded[:-1:2].astype(np.int32) * 256 + padded[1::2], blocks


def block_maxima(raw: bytes, pairs: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
    """blocks x FILTERS: the highest answer of every filter in every block of the whole text."""
    codes, blocks = _windows(raw)
    per = BLOCK // STRIDE
    out = np.empty((blocks, FILTERS), np.float32)
    step = max(1, SLICE // per)
    for b in range(0, blocks, step):
        e = min(blocks, b + step)
        answer = pairs[0][codes[b * per:e * per]]
        for k in range(1, WIDTH // 2):
            answer += pairs[k][codes[b * per + k:e * per + k]]
        out[b:e] = answer.reshape(e - b, per, FILTERS).max(axis=1)
    return out + bias


def _logit(maxima: np.ndarray, net: Network) -> float:
    chunk = np.maximum(np.maximum(maxima[:-1], maxima[1:]), 0)
    score = np.tanh(chunk @ net.hidden + net.hidden_bias) @ net.out
    return float(net.combine @ [score.mean(), score.min(), score.max(), 1])


def probability(raw: bytes, net: Network, pairs: list[np.ndarray]) -> float:
    return float(1 / (1 + np.exp(-np.clip(_logit(block_maxima(raw, pairs, net.bias), net), -30, 30))))


def train(rows: list[tuple[bytes, int]], epochs: int = 8, rate: float = 0.01, batch: int = 32, seed: int = 7,
          least_steps: int = 500) -> Network:
    """Fit the network on (text, label) by Adam on the logistic loss; few rows are gone through more often.

    One label only: that label's prior.
    """
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
                  rng.normal(0, FILTERS ** -0.5, (FILTERS, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
                  rng.normal(0, HIDDEN ** -0.5, HIDDEN).astype(np.float32), np.array([1, .5, .5, 0], np.float32))
    positive = sum(y for _, y in rows)
    net.combine[3] = np.log((positive + 1) / (len(rows) - positive + 1))
    if not 0 < positive < len(rows):
        net.out[:] = 0
        return net
    weight = {1: len(rows) / (2 * positive), 0: len(rows) / (2 * (len(rows) - positive))}
    coded = [(_windows(raw), y) for raw, y in rows]
    names = ["filters", "bias", "hidden", "hidden_bias", "out", "combine"]
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    step, per = 0, BLOCK // STRIDE
    epochs = max(epochs, -(-least_steps // -(-len(rows) // batch)))
    for epoch in range(epochs):
        order = rng.permutation(len(coded))
        for at in range(0, len(order), batch):
            part = [coded[i] for i in order[at:at + batch]]
            pairs = net.filters
            grads = {n: np.zeros_like(getattr(net, n)) for n in names}
            low = [np.concatenate([c[k:b * per + k] for (c, b), _ in part]) for k in range(WIDTH // 2)]
            answer = sum(pairs[2 * k][c >> 8] + pairs[2 * k + 1][c & 255] for k, c in enumerate(low))
            answer = answer.reshape(-1, per, FILTERS)
            where = answer.argmax(axis=1)
            maxima = np.take_along_axis(answer, where[:, None, :], 1)[:, 0] + net.bias
            grad_maxima = np.zeros_like(maxima)
            begin = 0
            for (_, blocks), y in part:
                m = maxima[begin:begin + blocks]
                upper = m[1:] > m[:-1]
                pooled = np.where(upper, m[1:], m[:-1])
                chunk = np.maximum(pooled, 0)
                inner = np.tanh(chunk @ net.hidden + net.hidden_bias)
                score = inner @ net.out
                summary = np.array([score.mean(), score.min(), score.max(), 1], np.float32)
                p = 1 / (1 + np.exp(-np.clip(net.combine @ summary, -30, 30)))
                d = (p - y) * weight[y] / len(part)
                grads["combine"] += d * summary
                d_score = np.full(len(score), d * net.combine[0] / len(score), np.float32)
                d_score[score.argmin()] += d * net.combine[1]
                d_score[score.argmax()] += d * net.combine[2]
                grads["out"] += inner.T @ d_score
                d_inner = d_score[:, None] * net.out * (1 - inner ** 2)
                grads["hidden"] += chunk.T @ d_inner
                grads["hidden_bias"] += d_inner.sum(axis=0)
                d_pooled = (d_inner @ net.hidden.T) * (pooled > 0)
                g = grad_maxima[begin:begin + blocks]
                g[1:] += d_pooled * upper
                g[:-1] += d_pooled * ~upper
                begin += blocks
            grads["bias"] = grad_maxima.sum(axis=0)
            row, column = np.nonzero(grad_maxima)
            at_position, value = row * per + where[row, column], grad_maxima[row, column]
            for k in range(WIDTH // 2):
                c = low[k][at_position]
                np.add.at(grads["filters"][2 * k], (c >> 8, column), value)
                np.add.at(grads["filters"][2 * k + 1], (c & 255, column), value)
            step += 1
            now = rate * (1 - epoch / epochs)
            for n in names:
                first[n] += 0.1 * (grads[n] - first[n])
                second[n] += 0.001 * (grads[n] ** 2 - second[n])
                getattr(net, n)[...] -= now * (first[n] / (1 - 0.9 ** step)) / (np.sqrt(second[n] / (1 - 0.999 ** step)) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, learn_from: Callable[[Column], Column], label: str = "quality",
        id_column: str = "doc_id", text_column: str = "text", rows: int = SAMPLE_ROWS) -> Network:
    """Train on labelled documents whose id satisfies `learn_from`, at most `rows` of them, drawn by the hash of the id.

    The sample is bounded (`rows` whole texts of at most LONGEST bytes reach the driver; longer ones are not drawn) and is all that the model learns from. Labels that contradict
    each other count as the higher one; rows without id or label are left out; without any the model answers 0.5.
    """
    short = docs.filter(F.coalesce(F.octet_length(F.col(f"`{text_column}`")), F.lit(0)) <= LONGEST)
    sample = labelled_sample(short, labels, learn_from, label, id_column, text_column, rows)
    found = sample.select("doc_id", F.col("text").cast("binary").alias("raw"), "label").sort("doc_id", "raw").collect()
    return train([(bytes(r.raw), r.label) for r in found])


def score(text: Column, net: Network) -> Column:
    """Probability (double) that a whole text is of good quality; null counts as empty. Local to a row."""
    @F.arrow_udf("double")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs = net.pairs()
        for column in columns:
            yield pa.array([probability(t.as_buffer().to_pybytes() if t.is_valid else b"", net, pairs) for t in column], pa.float64())

    return of(text)
