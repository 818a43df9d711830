"""Hashed n-gram features, logistic regression and Platt calibration in numpy.

Features are frequencies, so a score is a mean of weights over the n-grams of the whole text
and needs no vector per text. Training works on dense vectors of a bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from replylane.llm.words import Texts, chunks, segment_sums

BITS = 11
SCALE = 8.0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500.0, 500.0)))


def logit(p: np.ndarray | float) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def families(texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, cuts per text) of words, word pairs and byte triples."""
    shift = np.uint64(64 - BITS)
    hashes = texts.word_hashes()
    pairs, at = texts.windows(hashes, 2)
    data = texts.data.astype(np.uint32)
    if len(data) >= 3:
        triples = data[:-2] | (data[1:-1] << np.uint32(8)) | (data[2:] << np.uint32(16))
        triples = (triples * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    else:
        triples = np.zeros(0, np.uint32)
    # a triple must not reach into the next text
    lengths = np.maximum(np.diff(texts.offsets) - 2, 0)
    inside = np.repeat(texts.offsets[:-1] - np.cumsum(np.append(0, lengths[:-1])), lengths)
    triples = triples[inside + np.arange(lengths.sum())]
    return [
        ((hashes >> shift).astype(np.int64), texts.bounds),
        ((pairs >> shift).astype(np.int64), np.searchsorted(at, texts.bounds)),
        (triples.astype(np.int64), np.append(0, np.cumsum(lengths))),
    ]


FAMILIES = 3
WIDTH = FAMILIES << BITS


def vectors(column: pa.Array) -> np.ndarray:
    """One dense float32 vector per text; zeros for a text without words."""
    out = np.zeros((len(column), WIDTH), np.float32)
    for first, _, texts in chunks(column):
        for f, (buckets, cuts) in enumerate(families(texts)):
            for i in range(texts.count):
                a, b = cuts[i], cuts[i + 1]
                if b > a:
                    counts = np.bincount(buckets[a:b], minlength=1 << BITS)
                    out[first + i, f << BITS : (f + 1) << BITS] = counts * (SCALE / (b - a))
    return out


@dataclass
class Logistic:
    """Weights and bias, then a calibration slope and offset."""

    weights: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def raw(self, x: np.ndarray | Sparse) -> np.ndarray:
        return (x @ self.weights.astype(x.dtype)).astype(np.float64) + self.bias

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * raw + self.offset)

    def raw_texts(self, column: pa.Array) -> np.ndarray:
        """``raw`` of whole texts, without making their vectors."""
        out = np.zeros(len(column))
        for first, last, texts in chunks(column):
            total = np.full(texts.count, self.bias)
            for f, (buckets, cuts) in enumerate(families(texts)):
                own = self.weights[f << BITS : (f + 1) << BITS]
                sums = segment_sums(own[buckets], cuts)
                total += sums * (SCALE / np.maximum(np.diff(cuts), 1))
            out[first:last] = total
        return out


class Sparse:
    """Rows of few values other than zero, with the two products that ``fit`` takes.

    The products go by blocks of rows, so what they make on the way is bounded.
    """

    __array_ufunc__ = None
    BLOCK = 1 << 18

    def __init__(self, slots: np.ndarray, values: np.ndarray, cuts: np.ndarray, width: int):
        self.slots, self.values, self.cuts = slots, values, cuts
        self.shape, self.dtype = (len(cuts) - 1, width), np.dtype(np.float32)

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]], width: int) -> Sparse:
        """From (slots, values) of each row."""
        cuts = np.cumsum([0, *[len(slots) for slots, _ in rows]])
        slots, values = np.empty(cuts[-1], np.uint16), np.empty(cuts[-1], np.float16)
        for i, (own, value) in enumerate(rows):
            slots[cuts[i] : cuts[i + 1]], values[cuts[i] : cuts[i + 1]] = own, value
        return cls(slots, values, cuts, width)

    def __len__(self) -> int:
        return self.shape[0]

    def _blocks(self):
        first = 0
        while first < len(self):
            last = int(np.searchsorted(self.cuts, self.cuts[first] + self.BLOCK, "right")) - 1
            last = min(max(last, first + 1), len(self))
            a, b = self.cuts[first], self.cuts[last]
            yield first, last, self.slots[a:b], self.values[a:b].astype(np.float32)
            first = last

    def __getitem__(self, rows: np.ndarray) -> Sparse:
        return Sparse.of(
            [(self.slots[a:b], self.values[a:b]) for a, b in zip(self.cuts[rows], self.cuts[rows + 1])],
            self.shape[1],
        )

    def __matmul__(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self), np.float64)
        for first, last, slots, values in self._blocks():
            cuts = self.cuts[first : last + 1] - self.cuts[first]
            out[first:last] = segment_sums(values * w[slots], cuts)
        return out

    def __rmatmul__(self, error: np.ndarray) -> np.ndarray:
        out = np.zeros(self.shape[1], np.float64)
        for first, last, slots, values in self._blocks():
            each = np.repeat(error[first:last], np.diff(self.cuts[first : last + 1]))
            out += np.bincount(slots, each * values, self.shape[1])
        return out.astype(np.float32)


def fit(
    x: np.ndarray | Sparse, y: np.ndarray, weight: np.ndarray | None = None, penalty: float = 1e-3,
    steps: int = 150, rate: float = 0.05,
) -> Logistic:
    """Weighted logistic regression by full-batch gradient steps of adaptive size."""
    n, width = x.shape
    if not n or y.min() == y.max():
        prior = float(y.mean()) if n else 0.5
        return Logistic(np.zeros(width), float(logit(prior)))
    weight = np.ones(n) if weight is None else weight
    weight = (weight / weight.sum()).astype(np.float32)
    w, b = np.zeros(width, np.float32), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        error = (weight * (sigmoid(x @ w + b) - y)).astype(np.float32)
        g, gb = error @ x + np.float32(penalty) * w, float(error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = rate * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        w -= (step * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
        b -= step * mb / (np.sqrt(vb) + 1e-8)
    return Logistic(w.astype(np.float64), float(b))


def platt(raw: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Slope (above 0) and offset that make ``sigmoid(slope * raw + offset)`` a probability."""
    if not len(y) or y.min() == y.max():
        return 1.0, 0.0
    weight = np.ones(len(y)) if weight is None else weight
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * raw + b)
        error, curve = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([error @ raw + 1e-3 * (a - 1), error.sum()])
        cross = curve @ raw
        hessian = np.array([[curve @ (raw * raw) + 1e-3, cross], [cross, curve.sum() + 1e-9]])
        move = np.linalg.solve(hessian, gradient)
        move *= min(1.0, 2.0 / max(1e-12, np.abs(move).max()))
        a, b = max(a - move[0], 1e-2), b - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return float(a), float(b)
