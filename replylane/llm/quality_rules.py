"""Quality rules: counts over whole texts, and a calibrated n-gram classifier.

The classifier is a logistic regression over hashed words, word pairs and byte triples. It is
fitted on at most ``PER_CLASS`` labelled documents of each class and calibrated on a part of
them that it did not see; every document is then scored over its whole text in Arrow batches.

Defined results: a null text is an empty one; a text without words has no counts and fails
the base rules; repeated rows give repeated results; other columns are ignored. Without labels
of both classes the classifier passes every text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from replylane.llm import labelled, linear
from replylane.llm.words import Texts, chunks, mix

PER_CLASS = 1_500
SEED = 10
KEEP_AT = 0.5
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(flags, dtype=np.int64))
    return sums[cuts[1:]] - sums[cuts[:-1]]


def _repeated_words(texts: Texts) -> np.ndarray:
    """Per text, how many words lie in an 8-word window that occurs there twice or more."""
    size = REPEAT_WINDOW
    windows, at = texts.windows(texts.word_hashes(), size)
    if not len(windows):
        return np.zeros(texts.count, np.int64)
    key = mix(windows + texts.text_of[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(len(texts.starts) + size + 1, np.int64)
    np.add.at(steps, at[twice], 1)
    np.add.at(steps, at[twice] + size, -1)
    covered = np.cumsum(steps)[: len(texts.starts)] > 0
    return _per_text(covered, texts.bounds)


def _repeated_lines(data: bytes) -> int:
    seen: set[bytes] = set()
    repeated = 0
    for line in data.split(b"\n"):
        if line.strip(b"\x20\x09\x0a\x0b\x0c\x0d"):
            if line in seen:
                repeated += 1
            else:
                seen.add(line)
    return repeated


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of whole texts."""
    out = {name: np.zeros(len(column), np.int64) for name in _COUNTS}
    for first, last, texts in chunks(column):
        part = slice(first, last)
        whole = texts.data.tobytes()
        out["n_words"][part] = np.diff(texts.bounds)
        # code points of words: bytes that begin a character and are no space
        begins = (texts.data & 0xC0) != 0x80
        spaces = np.zeros(len(texts.data), bool)
        for space in (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D):
            spaces |= texts.data == space
        out["word_chars"][part] = _per_text(begins & ~spaces, texts.offsets)
        out["n_symbols"][part] = _per_text(_SYMBOL[texts.data], texts.offsets)
        out["n_repeat_words"][part] = _repeated_words(texts)
        out["n_dup_lines"][part] = [
            _repeated_lines(whole[a:b])
            for a, b in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist())
        ]
    return out


def train(
    documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: int = SEED
) -> linear.Logistic:
    """Fit on four fifths of the sample, calibrate on the rest at the labels' own rates."""
    known = labelled.one_label(labels, "quality")
    low, high = labelled.class_counts(known)
    if not low or not high:
        return linear.Logistic(np.zeros(linear.WIDTH), 20.0)
    chosen = labelled.choose(known, per_class, seed)
    rows = labelled.features(
        documents, chosen, lambda b: linear.vectors(b.column("text")), ["text"]
    )
    model = labelled.fit_in_task(rows, lambda ids, y, x: _fitted(ids, y, x, low, high))
    return model or linear.Logistic(np.zeros(linear.WIDTH), 20.0)


def _fitted(ids: np.ndarray, y: np.ndarray, x: np.ndarray, low: int, high: int) -> linear.Logistic:
    """The model of a sample out of ``low`` and ``high`` documents of either label."""
    if y.min() == y.max():
        return linear.Logistic(np.zeros(linear.WIDTH), 20.0)
    rate = np.where(y > 0, high / y.sum(), low / (1 - y).sum())
    held = mix(ids.astype(np.uint64)) % np.uint64(5) == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    model = linear.fit(x[~held], y[~held])
    on = held if held.any() else ~held
    model.slope, model.offset = linear.platt(model.raw(x[on]), y[on], rate[on] / rate[on].mean())
    return model


def apply_rules(documents: DataFrame, model: linear.Logistic, keep_at: float = KEEP_AT) -> DataFrame:
    """doc_id, the base counts, base_failed, p_quality and kept, one row per document."""
    def run(batches):
        for batch in batches:
            text = batch.column("text")
            counts = measure(text)
            score = model.calibrated(model.raw_texts(text))
            failed = (counts["n_words"] < MIN_WORDS) | (
                100 * counts["n_repeat_words"] > MAX_REPEATED_PERCENT * counts["n_words"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(counts[c]) for c in _COUNTS],
                 pa.array(failed), pa.array(score), pa.array(~failed & (score >= keep_at))],
                ["doc_id", *_COUNTS, "base_failed", "p_quality", "kept"],
            )

    kinds = ", ".join(f"{c} long" for c in _COUNTS)
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, f"doc_id long, {kinds}, base_failed boolean, p_quality double, kept boolean"
    )
