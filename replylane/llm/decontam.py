"""Benchmark decontamination by the q-gram lemma, banded counting and banded alignment.

An item of m bytes occurs in a text with at most k edits only if m + 1 - q - k*q of its
q-grams occur in order inside a band of diagonals. Shared q-grams are counted per (text, item,
band) over bands that overlap by half, so that any alignment lies whole in one of them; a band
that meets the bound is verified by an alignment confined to it. Texts and items are compared
as UTF-8 bytes with ASCII letters in lower case and blanks alike; k is ``RATE`` of the item's
length, less where a short item would leave no q-gram to require.

Every occurrence of an item counts. Of those of one item that overlap, the one of least
distance stands, then the first, then the shortest. An item under ``Q`` bytes has no q-gram
and is searched as it is, as whole words.

Defined results: null texts and items are empty, and an empty item matches nothing; items of
equal text each match; repeated rows of a document each give their matches; other columns are
ignored; an empty benchmark matches nothing.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType

from replylane.llm.words import as_bytes

Q = 8
RATE = 0.1
BLOCK_BYTES = 4 << 20
BLOCK_ITEMS = 20_000
_PIECE = 512 << 10
_FILTER_BITS = 20
_COUNT_BITS = 20
_ALIGNED = 256

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
#: bytes of letters, digits and of characters outside ASCII
_LETTER = np.arange(256) >= 128
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def _grams(data: np.ndarray) -> np.ndarray:
    """Every run of eight bytes as one number."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    return np.lib.stride_tricks.sliding_window_view(data, Q).copy().view("<u8").ravel()


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)


@dataclass
class Items:
    """A block of benchmark items and the sorted table of their q-grams."""

    ids: np.ndarray
    texts: list[np.ndarray]
    budget: np.ndarray
    need: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    seen: np.ndarray
    #: items of fewer bytes than a gram: (id, bytes)
    short: list[tuple[object, bytes]]

    @classmethod
    def build(cls, ids: list[int | None], column: pa.Array, rate: float = RATE) -> Items:
        data, offsets = as_bytes(column)
        texts = [_FOLD[data[a:b]] for a, b in zip(offsets[:-1], offsets[1:])]
        long_enough = [i for i, t in enumerate(texts) if len(t) >= Q]
        short = [(ids[i], t.tobytes()) for i, t in enumerate(texts) if 0 < len(t) < Q]
        texts = [texts[i] for i in long_enough]
        sizes = np.array([len(t) for t in texts], np.int64)
        budget = np.minimum((sizes * rate).astype(np.int64), (sizes - Q) // Q)
        grams = [_grams(t) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else owner
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        distinct, first = np.unique(every[order], return_index=True)
        seen = np.zeros(1 << _FILTER_BITS, bool)
        seen[_slot(every)] = True
        return cls(np.array([ids[i] for i in long_enough], object), texts, budget,
                   sizes + 1 - Q - budget * Q, distinct, np.append(first, len(every)),
                   owner[order], place[order], seen, short)

    def hits(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in data, item, place in item) of every shared q-gram."""
        grams = _grams(data)
        at = np.flatnonzero(self.seen[_slot(grams)])
        if not len(at) or not len(self.grams):
            return (np.zeros(0, np.int64),) * 3
        found = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        same = self.grams[found] == grams[at]
        at, found = at[same], found[same]
        low, many = self.first[found], self.first[found + 1] - self.first[found]
        pick = np.repeat(low - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
        return np.repeat(at, many), self.owner[pick], self.place[pick]


def _bands(items: Items, data: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
    """(text, item, first diagonal) of the bands that hold enough shared q-grams.

    Bands of an item are 2*w diagonals wide and begin at multiples of w = budget + 1, so each
    hit counts in two. A gram of the item counts once in a band however often the text has it.
    """
    none = [np.zeros(0, np.int64)] * 3
    at, item, place = items.hits(data)
    if not len(at):
        return none
    # Plain numbers first, in hashed counters: they may be too high, never too low.
    slot = (at - place) // (items.budget[item] + 1) + item * 1_000_003
    mask = (1 << _COUNT_BITS) - 1
    counted = np.bincount(slot & mask, minlength=mask + 1)
    near = np.maximum(counted[(slot - 1) & mask], counted[(slot + 1) & mask])
    on = counted[slot & mask] + near >= items.need[item]
    at, item, place = at[on], item[on], place[on]
    text = np.searchsorted(cuts, at, "right") - 1
    whole = at + Q <= cuts[text + 1]
    at, item, place, text = at[whole], item[whole], place[whole], text[whole]
    if not len(at):
        return none
    half = (at - place) // (items.budget[item] + 1)
    rows = np.stack([np.tile(text, 2), np.tile(item, 2), np.append(half, half - 1), np.tile(place, 2)])
    rows = rows[:, np.lexsort(rows[::-1])]
    rows = rows[:3, np.append(True, (rows[:, 1:] != rows[:, :-1]).any(0))]
    edges = np.flatnonzero(np.append(True, (rows[:, 1:] != rows[:, :-1]).any(0)))
    count = np.diff(np.append(edges, rows.shape[1]))
    of, what, band = rows[:, edges]
    keep = count >= items.need[what]
    return [of[keep], what[keep], band[keep] * (items.budget[what[keep]] + 1)]


def align(
    items: list[np.ndarray], data: np.ndarray, first: np.ndarray, width: np.ndarray,
    low: np.ndarray, high: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distance, start, end) of each item inside its part low..high of ``data``.

    Only ``width`` diagonals from ``first`` on are used. Column b of row i stands for the place
    first + b + i in data; a step along the item keeps the diagonal, a skipped byte of the
    item lowers it, a skipped byte of the data raises it. All items advance together.
    """
    n, sizes, wide = len(items), np.array([len(t) for t in items]), int(width.max())
    steps = np.arange(wide)
    big = 1 << 20
    letters = np.full((n, int(sizes.max())), -2, np.int16)
    for i, item in enumerate(items):
        letters[i, : len(item)] = item
    places = first[:, None] + np.arange(letters.shape[1] + wide)
    inside = (places >= low[:, None]) & (places < high[:, None])
    source = np.where(inside, data[np.clip(places, 0, len(data) - 1)].astype(np.int16), -1)
    begin = first[:, None] + steps
    closed = steps >= width[:, None]
    before = np.where((begin < low[:, None]) | (begin > high[:, None]) | closed, big, 0)
    ended = (np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64))
    for i in range(letters.shape[1]):
        part = source[:, i : i + wide]
        cost = before + np.where(part == letters[:, i : i + 1], 0, np.where(part < 0, big, 1))
        start = begin.copy()
        drop = before[:, 1:] + 1
        better = drop < cost[:, :-1]
        cost[:, :-1][better] = drop[better]
        start[:, :-1][better] = begin[:, 1:][better]
        end = places[:, i + 1 : i + 1 + wide]
        cost[(end < low[:, None]) | (end > high[:, None]) | closed] = big
        # skipped bytes of the data: the best column to the left, one more for each step
        base = cost - steps
        best = np.minimum.accumulate(base, axis=1)
        column = np.maximum.accumulate(np.where(base == best, steps, 0), axis=1)
        before, begin = best + steps, np.take_along_axis(start, column, 1)
        before[closed] = big
        done = np.flatnonzero(sizes == i + 1)
        if len(done):
            last = np.argmin(before[done], axis=1)
            ended[0][done] = before[done, last]
            ended[1][done] = begin[done, last]
            ended[2][done] = first[done] + last + i + 1
    return ended


def _pieces(offsets: np.ndarray, reach: int):
    """Runs of (text, begin, end) of about ``_PIECE`` bytes; long texts in overlapping pieces."""
    run, size = [], 0
    for text, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for begin in range(a, max(b, a + 1), _PIECE):
            end = min(b, begin + _PIECE + reach)
            if size and size + end - begin > _PIECE:
                yield run
                run, size = [], 0
            run.append((text, begin, end))
            size += end - begin
    if run:
        yield run


def _whole_words(short: list[tuple[object, bytes]], data: np.ndarray, cuts: np.ndarray):
    """(part, index, start, end) of exact occurrences of short items that no letter touches."""
    lengths = sorted({len(t) for _, t in short})
    if not lengths or not len(data):
        return
    part = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    letter = _LETTER[data]
    # the ends of a part are no letters
    before = np.append(False, letter[:-1] & (part[1:] == part[:-1]))
    after = np.append(letter[1:] & (part[1:] == part[:-1]), False)
    for length in lengths:
        if len(data) < length:
            continue
        code = np.zeros(len(data) - length + 1, np.uint64)
        for k in range(length):
            code = code << np.uint64(8) | data[k : k + len(code)]
        free = ~before[: len(code)] & ~after[length - 1 :] & (part[: len(code)] == part[length - 1 :])
        for index, (_, item) in enumerate(short):
            if len(item) == length:
                for at in np.flatnonzero(free & (code == np.uint64(int.from_bytes(item)))).tolist():
                    yield int(part[at]), index, at, at + length


def matches(items: Items, column: pa.Array) -> list[tuple[int, object, int, int, int]]:
    """(row, item id, start, end, distance) of every occurrence of each item in each text.

    Of occurrences of one item that overlap, the nearest stands, then the first, then the
    shortest. Pieces of long texts overlap by more than the longest occurrence.
    """
    raw, offsets = as_bytes(column)
    reach = 2 * max((len(t) + int(k) + 1 for t, k in zip(items.texts, items.budget)), default=Q)
    found: dict[tuple[int, int], set[tuple[int, int, int]]] = {}
    for run in _pieces(offsets, reach):
        cuts = np.append(0, np.cumsum([end - begin for _, begin, end in run]))
        data = _FOLD[np.concatenate([raw[begin:end] for _, begin, end in run])]

        def add(row: int, k: int, start: int, end: int, distance: int) -> None:
            text, begin, _ = run[row]
            shift = begin - int(offsets[text]) - int(cuts[row])
            found.setdefault((text, k), set()).add((distance, start + shift, end + shift))

        part, item, first = _bands(items, data, cuts)
        for a in range(0, len(part), _ALIGNED):
            i, p, f = item[a : a + _ALIGNED], part[a : a + _ALIGNED], first[a : a + _ALIGNED]
            aligned = align([items.texts[k] for k in i], data, f, 2 * (items.budget[i] + 1),
                            cuts[p], cuts[p + 1])
            for k, row, distance, start, end in zip(i.tolist(), p.tolist(), *map(np.ndarray.tolist, aligned)):
                if distance <= items.budget[k]:
                    add(row, k, start, end, distance)
        for row, k, start, end in _whole_words(items.short, data, cuts):
            # a cut inside a text is no border of a word
            text, begin, stop = run[row]
            if (start > cuts[row] or begin == offsets[text] or not _LETTER[raw[begin - 1]]) and (
                end < cuts[row + 1] or stop == offsets[text + 1] or not _LETTER[raw[stop]]
            ):
                add(row, ~k, start, end, 0)
    out = []
    for (text, k), regions in sorted(found.items()):
        item_id = items.ids[k] if k >= 0 else items.short[~k][0]
        kept: list[tuple[int, int]] = []  # by start, apart from each other
        chosen = []
        for distance, start, end in sorted(regions):
            at = bisect.bisect_left(kept, (start, end))
            if (at and kept[at - 1][1] > start) or (at < len(kept) and kept[at][0] < end):
                continue
            kept.insert(at, (start, end))
            chosen.append((text, item_id, start, end, distance))
        out += sorted(chosen, key=lambda m: m[2])
    return out


def _blocks(benchmark: DataFrame):
    """The items in blocks of bounded size, streamed to the driver one partition at a time."""
    rows, size = [], 0
    slim = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                            F.col("text").cast("string").alias("text"))
    for row in slim.toLocalIterator():
        rows.append(row)
        size += len(row["text"] or "")
        if size >= BLOCK_BYTES or len(rows) >= BLOCK_ITEMS:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def find_items(documents: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, start, end (bytes of the UTF-8 text) and distance of every match."""
    schema = "doc_id long, item_id long, start long, end long, distance long"
    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("text").cast("string").alias("text"))
    found = None
    for rows in _blocks(benchmark):
        column = pa.array([r["text"] for r in rows], pa.string())
        ids = [r["item_id"] for r in rows]
        items = documents.sparkSession.sparkContext.broadcast(Items.build(ids, column, rate))

        def run(batches, items=items):
            for batch in batches:
                ids = batch.column("doc_id")
                out = [(ids[row].as_py(), *match)
                       for row, *match in matches(items.value, batch.column("text"))]
                columns = list(zip(*out)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    ["doc_id", "item_id", "start", "end", "distance"],
                )

        part = slim.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return documents.sparkSession.createDataFrame([], schema)
    return found


def decontaminate(documents: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows in whose text no item occurs; each row is judged by itself, without a join."""
    kept = documents
    for rows in _blocks(benchmark):
        column = pa.array([r["text"] for r in rows], pa.string())
        ids = [r["item_id"] for r in rows]
        items = documents.sparkSession.sparkContext.broadcast(Items.build(ids, column, rate))
        kept = kept.where(_is_clean(items)(F.col("text").cast("string")))
    return kept


def _is_clean(items):
    """Whether no item occurs: only texts go to Python, and one bit a row comes back."""
    @F.arrow_udf(BooleanType())
    def is_clean(texts: pa.Array) -> pa.Array:
        clean = np.ones(len(texts), bool)
        clean[[row for row, *_ in matches(items.value, texts)]] = False
        return pa.array(clean)

    return is_clean
