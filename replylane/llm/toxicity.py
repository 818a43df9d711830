"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A step of the network is a word. Its input joins a hashed word vector with the mean of hashed
vectors of its character triples. Two gated recurrences read a window of ``WINDOW`` words, an
attention layer pools their states, and the pooled state gives a logit. Windows overlap by
half and cover the whole text; a text is as toxic as its worst window. Training needs no
labels on windows: each step scores all windows of a batch of texts and learns from the worst
of each. It runs in numpy on at most ``PER_CLASS`` labelled texts of each class.

Words are runs of letters, digits and non-ASCII characters, ASCII in lower case.

Defined results: a null text is an empty one; a text without words has the score of an empty
window; repeated rows give the same result up to rounding; other columns are ignored; without labels of
both classes every score is the rate of label 1 (0 if there are none).
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from replylane.llm import labelled
from replylane.llm.linear import logit, platt, sigmoid
from replylane.llm.words import Texts, chunks, mix

WINDOW, STRIDE = 24, 12
WORD_BITS, CHAR_BITS = 14, 12
VECTOR, HIDDEN, ATTENTION = 8, 8, 8
PER_CLASS = 1_500
UPDATES, HALF_BATCH, RATE = 500, 24, 0.01
BLOCK = 4096
FOLDS = 5
SEED = 2

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _sigmoid(x: np.ndarray) -> None:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


@dataclass
class Vocabulary:
    """The distinct words of a run of texts: word slots, and character slots with cuts."""

    words: np.ndarray
    characters: np.ndarray
    cuts: np.ndarray


def read(texts: Texts) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """(vocabulary, word numbers in it, cuts per text)."""
    texts = Texts(_FOLD[texts.data], texts.offsets)
    hashes = texts.word_hashes()
    distinct, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    starts, ends = texts.starts[first], texts.ends[first]
    # character triples of a word between two marks: one triple per character
    sizes = ends - starts
    cuts = np.append(0, np.cumsum(sizes))
    at = np.repeat(starts - cuts[:-1], sizes) + np.arange(cuts[-1])
    data = texts.data.astype(np.uint32)
    middle = data[at]
    before = data[np.maximum(at - 1, 0)]
    after = data[np.minimum(at + 1, max(0, len(data) - 1))]
    before[cuts[:-1]] = 1
    after[cuts[1:] - 1] = 2
    triples = (before | (middle << np.uint32(8)) | (after << np.uint32(16))) * np.uint32(0x9E3779B1)
    vocabulary = Vocabulary(
        (distinct >> np.uint64(64 - WORD_BITS)).astype(np.int64),
        (triples >> np.uint32(32 - CHAR_BITS)).astype(np.int64), cuts,
    )
    return vocabulary, number.reshape(-1), texts.bounds


def windows(number: np.ndarray, cuts: np.ndarray, empty: int) -> tuple[np.ndarray, np.ndarray]:
    """(window rows of word numbers padded with ``empty``, text of each window)."""
    sizes = np.diff(cuts)
    many = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(sizes)), many)
    turn = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    start = cuts[:-1][text] + turn * STRIDE
    place = start[:, None] + np.arange(WINDOW)
    inside = place < cuts[1:][text][:, None]
    padded = np.append(number, empty)
    return np.where(inside, padded[np.minimum(place, len(number))], empty), text


@dataclass
class Network:
    """The parameters, all float32, and the calibration of the final logit."""

    p: dict[str, np.ndarray] = field(default_factory=dict)
    slope: float = 1.0
    offset: float = 0.0

    @classmethod
    def fresh(cls, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)

        def draw(*shape, scale=0.3):
            return rng.normal(0, scale, shape).astype(np.float32)

        h = HIDDEN
        return cls({
            # unseen words and characters stay near zero
            "word": draw(1 << WORD_BITS, VECTOR, scale=0.02),
            "char": draw(1 << CHAR_BITS, VECTOR, scale=0.02),
            "input": draw(2 * VECTOR, 6 * h), "bias": np.zeros(6 * h, np.float32),
            "forward": draw(h, 3 * h), "backward": draw(h, 3 * h),
            "look": draw(2 * h, ATTENTION), "see": draw(ATTENTION),
            "out": draw(2 * h), "base": np.full(1, -1.0, np.float32),
        })

    def project(self, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
        """Gate inputs of every distinct word for both directions, and the joined vectors."""
        p = self.p
        x = np.zeros((len(v.words), 2 * VECTOR), np.float32)
        x[:, :VECTOR] = p["word"][v.words]
        if len(v.words):
            sums = np.add.reduceat(p["char"][v.characters], v.cuts[:-1], axis=0)
            x[:, VECTOR:] = sums / np.diff(v.cuts)[:, None]
        gates = x @ p["input"] + p["bias"]
        return np.concatenate([gates, np.zeros((1, gates.shape[1]), np.float32)]), x

    def run(self, gates: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Logits of windows. Each gate has arrays of its own, so every step is contiguous."""
        p, h, (n, steps) = self.p, HIDDEN, rows.shape
        columns = np.ascontiguousarray(rows.T)
        states: list[list] = [[None] * steps, [None] * steps]
        with np.errstate(over="ignore"):
            for side, name in enumerate(("forward", "backward")):
                own = [np.ascontiguousarray(gates[:, h * k : h * (k + 1)]) for k in range(3 * side, 3 * side + 3)]
                own[0][-1] = -1e4  # an empty place leaves the state as it is
                recurrent = [np.ascontiguousarray(p[name][:, h * k : h * (k + 1)]) for k in range(3)]
                state = np.zeros((n, h), np.float32)
                for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
                    z, r, c = (table.take(columns[t], axis=0) for table in own)
                    z += state @ recurrent[0]
                    r += state @ recurrent[1]
                    _sigmoid(z)
                    _sigmoid(r)
                    r *= state @ recurrent[2]
                    c += r
                    np.tanh(c, out=c)
                    c -= state
                    c *= z
                    c += state
                    states[side][t] = state = c
        score, out = np.empty((steps, n), np.float32), np.empty((steps, n), np.float32)
        for t in range(steps):
            ahead, back = states[0][t], states[1][t]
            seen = ahead @ p["look"][:h] + back @ p["look"][h:]
            score[t] = np.tanh(seen) @ p["see"]
            out[t] = ahead @ p["out"][:h] + back @ p["out"][h:]
        score[columns == len(gates) - 1] = -1e4
        weight = np.exp(score - score.max(0))
        weight[columns == len(gates) - 1] = 0
        return (weight * out).sum(0) / np.maximum(weight.sum(0), 1e-9) + p["base"][0]

    def traced(self, gates: np.ndarray, rows: np.ndarray):
        """The same logits with all that the gradient needs."""
        p, h, (n, steps) = self.p, HIDDEN, rows.shape
        mask = (rows != len(gates) - 1).astype(np.float32)
        states = np.zeros((n, steps, 2 * h), np.float32)
        trace = {}
        with np.errstate(over="ignore"):
            for side, name in enumerate(("forward", "backward")):
                recurrent, own = p[name], gates[:, 3 * h * side : 3 * h * (side + 1)]
                state = np.zeros((n, h), np.float32)
                for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
                    x = own[rows[:, t]]
                    g = state @ recurrent
                    zr = 1 / (1 + np.exp(-(x[:, : 2 * h] + g[:, : 2 * h])))
                    z, r = zr[:, :h], zr[:, h:]
                    c = np.tanh(x[:, 2 * h :] + r * g[:, 2 * h :])
                    trace[side, t] = (state, z, r, c, g[:, 2 * h :])
                    state = state + (z * mask[:, t : t + 1]) * (c - state)
                    states[:, t, h * side : h * (side + 1)] = state
        seen = np.tanh(states @ p["look"])
        weight = seen @ p["see"] - 1e4 * (1 - mask)
        weight = np.exp(weight - weight.max(1, keepdims=True)) * mask
        weight /= np.maximum(weight.sum(1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nth->nh", weight, states)
        return pooled @ p["out"] + p["base"][0], (mask, states, seen, weight, pooled, trace)

    def gradient(self, v: Vocabulary, rows: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """Loss gradient over windows ``rows`` with labels ``y``; tables as (slots, rows)."""
        p, h = self.p, HIDDEN
        gates, x = self.project(v)
        logits, (mask, states, seen, att, pooled, trace) = self.traced(gates, rows)
        n, steps = rows.shape
        error = ((sigmoid(logits) - y) * weight).astype(np.float32)
        g = {"out": error @ pooled, "base": error.sum(keepdims=True)}
        d_pooled = error[:, None] * p["out"]
        d_states = att[:, :, None] * d_pooled[:, None, :]
        d_att = np.einsum("nth,nh->nt", states, d_pooled)
        d_score = att * (d_att - (att * d_att).sum(1, keepdims=True))
        g["see"] = np.einsum("nta,nt->a", seen, d_score)
        d_seen = d_score[:, :, None] * p["see"] * (1 - seen * seen)
        g["look"] = np.einsum("nth,nta->ha", states, d_seen)
        d_states += d_seen @ p["look"].T
        d_gates = np.zeros_like(gates)
        for side, name in enumerate(("forward", "backward")):
            recurrent = p[name]
            carry = np.zeros((n, h), np.float32)
            g[name] = np.zeros_like(recurrent)
            for t in range(steps - 1, -1, -1) if side == 0 else range(steps):
                state, z, r, c, q = trace[side, t]
                up = carry + d_states[:, t, h * side : h * (side + 1)]
                live = mask[:, t : t + 1]
                dz, dc = up * live * (c - state) * z * (1 - z), up * live * z * (1 - c * c)
                dr, dq = dc * q * r * (1 - r), dc * r
                dg = np.concatenate([dz, dr, dq], 1)
                g[name] += state.T @ dg
                carry = up * (1 - z * live) + dg @ recurrent.T
                np.add.at(d_gates[:, 3 * h * side : 3 * h * (side + 1)], rows[:, t],
                          np.concatenate([dz, dr, dc], 1))
        d_gates = d_gates[:-1]
        g["input"], g["bias"] = x.T @ d_gates, d_gates.sum(0)
        dx = d_gates @ p["input"].T
        sizes = np.diff(v.cuts)
        slots = {"word": (v.words, dx[:, :VECTOR]), "char": (
            v.characters, np.repeat(dx[:, VECTOR:] / sizes[:, None], sizes, axis=0))}
        for name, (index, values) in slots.items():
            own, inverse = np.unique(index, return_inverse=True)
            total = np.zeros((len(own), VECTOR), np.float32)
            np.add.at(total, inverse, values)
            g[name] = (own, total)
        return g

    def raw(self, column: pa.Array) -> np.ndarray:
        """The logit of the worst window of each whole text."""
        out = np.full(len(column), self.p["base"][0], np.float64)
        for first, last, texts in chunks(column):
            v, number, cuts = read(texts)
            gates, _ = self.project(v)
            worst = np.full(last - first, -np.inf)
            rows, text = windows(number, cuts, len(gates) - 1)
            for a in range(0, len(rows), BLOCK):
                np.maximum.at(worst, text[a : a + BLOCK], self.run(gates, rows[a : a + BLOCK]))
            out[first:last] = np.where(np.isfinite(worst), worst, out[first:last])
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        return sigmoid(self.slope * self.raw(column) + self.offset)


def _part(v: Vocabulary, rows: np.ndarray, empty: int) -> tuple[Vocabulary, np.ndarray]:
    """The vocabulary of some windows alone, and the windows in its numbers."""
    own, number = np.unique(rows, return_inverse=True)
    number = number.reshape(rows.shape)
    if own[-1] == empty:
        own = own[:-1]
    sizes = np.diff(v.cuts)[own]
    cuts = np.append(0, np.cumsum(sizes))
    at = np.repeat(v.cuts[:-1][own] - cuts[:-1], sizes) + np.arange(cuts[-1])
    return Vocabulary(v.words[own], v.characters[at], cuts), number


def learn(column: pa.Array, y: np.ndarray, updates: int = UPDATES, seed: int = SEED) -> Network:
    """Fit by adaptive steps over batches of as many texts of either label.

    Of each text the worst window counts, and while the network knows little, in the first
    half, also one drawn at random.
    """
    network, rng = Network.fresh(seed), np.random.default_rng(seed)
    sides = [np.flatnonzero(y == k) for k in (0, 1)]
    parts = {}
    m = {k: np.zeros_like(a) for k, a in network.p.items()}
    s = {k: np.zeros_like(a) for k, a in network.p.items()}
    for step in range(1, updates + 1):
        pick = np.concatenate([rng.choice(side, HALF_BATCH) for side in sides]).tolist()
        for i in pick:
            if i not in parts:
                _, _, texts = next(chunks(column[i : i + 1]))
                v, number, cuts = read(texts)
                parts[i] = v, windows(number, cuts, len(v.words))[0]
        v, rows = _joined([parts[i] for i in pick])
        if not len(rows):
            continue
        gates, _ = network.project(v)
        logits = np.concatenate([network.run(gates, rows[a : a + BLOCK])
                                 for a in range(0, len(rows), BLOCK)])
        chosen, labels, weight, at = [], [], [], 0
        for i in pick:
            many = len(parts[i][1])
            if many:
                own = [at + int(np.argmax(logits[at : at + many]))]
                if step <= updates // 2:
                    own.append(at + int(rng.integers(many)))
                chosen += own
                labels += [y[i]] * len(own)
                weight += [1 / len(own)] * len(own)
                at += many
        v, rows = _part(v, rows[chosen], len(v.words))
        g = network.gradient(v, rows, np.array(labels), np.array(weight) / len(pick))
        rate = RATE * min(1.0, 2.0 * (1 - step / (updates + 1)))
        rate *= np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        for k, a in network.p.items():
            at, d = g[k] if isinstance(g[k], tuple) else (slice(None), g[k])
            m[k][at] = 0.9 * m[k][at] + 0.1 * d
            s[k][at] = 0.99 * s[k][at] + 0.01 * d * d
            a[at] -= (rate * m[k][at] / (np.sqrt(s[k][at]) + 1e-6)).astype(np.float32)
    return network


def _joined(parts: list[tuple[Vocabulary, np.ndarray]]) -> tuple[Vocabulary, np.ndarray]:
    """One vocabulary over several texts (their words are kept apart), and all windows."""
    words = np.concatenate([v.words for v, _ in parts])
    characters = np.concatenate([v.characters for v, _ in parts])
    sizes = np.concatenate([np.diff(v.cuts) for v, _ in parts])
    rows, shift = [], 0
    for v, own in parts:
        rows.append(np.where(own == len(v.words), len(words), own + shift))
        shift += len(v.words)
    return Vocabulary(words, characters, np.append(0, np.cumsum(sizes))), np.concatenate(rows)


def train(
    documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, updates: int = UPDATES,
    seed: int = SEED,
) -> Network:
    """Fit on four fifths of the sample outside the held-out fold, calibrate on the rest.

    The sample is bounded by ``per_class``, so one task takes it; a lost one runs again.
    """
    known = labelled.one_label(labels, "toxic")
    known = known.where(labelled.fold(F.col("doc_id"), FOLDS) != 0)
    clean, toxic = labelled.class_counts(known)
    network = Network.fresh(seed)
    if not clean or not toxic:
        network.slope, network.offset = 0.0, float(logit(float(bool(toxic))))
        return network
    chosen = labelled.choose(known, per_class, seed)

    def run(batches):
        tables = [pa.Table.from_batches([b]) for b in batches]
        if tables:
            fitted = _fitted(pa.concat_tables(tables), clean, toxic, updates, seed)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fitted)], pa.binary())], ["network"])

    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # one row an id, so that copies of a chosen one do not meet in the task
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
    row = sample.repartition(1).mapInArrow(run, "network binary").first()
    if row is None:
        network.slope, network.offset = 0.0, float(logit(toxic / (clean + toxic)))
        return network
    return pickle.loads(row["network"])


def _fitted(sample: pa.Table, clean: int, toxic: int, updates: int, seed: int) -> Network:
    """The network for a sample of (doc_id, text, y) out of so many labels of each kind."""
    sample = sample.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    ids, first = np.unique(sample.column("doc_id").to_numpy(), return_index=True)
    sample = sample.take(pa.array(first))
    y = sample.column("y").to_numpy().astype(np.float64)
    column = sample.column("text").cast(pa.large_string()).combine_chunks()
    if y.min() == y.max():
        return Network(Network.fresh(seed).p, 0.0, float(logit(toxic / (clean + toxic))))
    held = mix(ids.astype(np.uint64)) % np.uint64(5) == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    network = learn(column.filter(pa.array(~held)), y[~held], updates, seed)
    on = held if held.any() else ~held
    rate = np.where(y > 0, toxic / y.sum(), clean / (1 - y).sum())[on]
    network.slope, network.offset = platt(
        network.raw(column.filter(pa.array(on))), y[on], rate / rate.mean()
    )
    return network


def score(documents: DataFrame, network: Network) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per document."""
    shared = documents.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in batches:
            scores = shared.value.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores),
                 pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    doc_id = F.col("doc_id").cast("long")
    return documents.select(
        doc_id.alias("doc_id"), (labelled.fold(doc_id, FOLDS) == 0).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
