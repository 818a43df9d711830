"""Words, word hashes and word shingles of a column of texts, as numpy arrays.

Texts stay in their UTF-8 buffer; nothing here makes a Python string per word. A word is a
maximal run of characters other than space and the controls 09 to 0D. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

CHUNK_BYTES = 1 << 18
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IN_WORD = np.ones(256, bool)
IN_WORD[list(SPACES)] = False

_PRIME = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BYTES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = np.random.default_rng(21).integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    z = values ^ (values >> np.uint64(30))
    z = z * np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z = z * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return powers(_PRIME), powers(pow(_PRIME, -1, 1 << 64))


class Texts:
    """A run of texts of one column: bytes, text offsets, and the words in them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.count = len(offsets) - 1
        mask = IN_WORD[data]
        if len(data):
            firsts, lasts = offsets[:-1], offsets[1:]
            filled = lasts > firsts
            before = np.empty_like(mask)
            before[0], before[1:] = False, mask[:-1]
            before[firsts[filled]] = False
            after = np.empty_like(mask)
            after[-1], after[:-1] = False, mask[1:]
            after[lasts[filled] - 1] = False
            self.starts = np.flatnonzero(mask & ~before)
            self.ends = np.flatnonzero(mask & ~after) + 1
        else:
            self.starts = self.ends = np.zeros(0, np.int64)
        self.text_of = np.searchsorted(offsets, self.starts, "right") - 1
        #: of each text, where its words begin and end in ``starts``
        self.bounds = np.searchsorted(self.text_of, np.arange(self.count + 1))

    def word_hashes(self) -> np.ndarray:
        """A 64-bit hash per word, the same wherever the word stands."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        size = max(CHUNK_BYTES, 1 << int(len(self.data) - 1).bit_length())
        up, down = _powers(size)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTES[self.data] * up[: len(self.data)], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def windows(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words inside one text, and their first words."""
        if len(hashes) < size:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        last = len(hashes) - size + 1
        total = np.zeros(last, np.uint64)
        for k in range(size):
            total += hashes[k : k + last] * _STEPS[k]
        inside = np.flatnonzero(self.text_of[:last] == self.text_of[size - 1 :])
        return mix(total[inside]), inside

    def shingle_sets(self, size: int = 5) -> list[np.ndarray]:
        """Per text the sorted distinct hashes of its word shingles.

        A text of fewer words has one shingle, all of its words; one without words has none.
        """
        hashes = self.word_hashes()
        shingles, at = self.windows(hashes, size)
        cuts = np.searchsorted(at, self.bounds)
        out = []
        for i in range(self.count):
            a, b = self.bounds[i], self.bounds[i + 1]
            if b - a >= size:
                out.append(np.unique(shingles[cuts[i] : cuts[i + 1]]))
            elif b > a:
                whole = (hashes[a:b] * _STEPS[: b - a]).sum(dtype=np.uint64)
                out.append(mix(np.array([whole + np.uint64(b - a)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def as_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and its offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Cut a column into runs of whole texts of about ``limit`` bytes: (first, last, texts)."""
    data, offsets = as_bytes(column)
    first, count = 0, len(offsets) - 1
    while first < count:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, count)
        part = offsets[first : last + 1]
        yield first, last, Texts(data[part[0] : part[-1]], part - part[0])
        first = last


def bound_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Whole texts are large rows: fewer of them at a time cross to Python and back."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def segment_sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments; each depends on its own values alone."""
    out = np.zeros(len(cuts) - 1, np.float64)
    filled = np.flatnonzero(cuts[1:] > cuts[:-1])
    if len(filled):
        edges = np.stack([cuts[filled], cuts[filled + 1]], 1).ravel()
        padded = np.append(values.astype(np.float64), 0.0)
        out[filled] = np.add.reduceat(padded, edges)[::2]
    return out
