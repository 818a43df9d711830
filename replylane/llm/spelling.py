"""Spelling variants: words one edit apart, and the form that each word stands for.

Two words are near if they differ by exactly one inserted, deleted or replaced character. The
form of a word is its most frequent near word (ties: the least), if that is ``RATIO`` times as
frequent; following forms to the last gives its root.

Blocking is exact. If a pair's shorter word has L characters and the first difference lies at p
with lo <= p < hi, both share their first lo and, the shorter being of L, their last L - hi
characters. So every word stands in a block for each of two ranges, the halves of L, for L its
own length and one less, and a pair meets in the one block whose range holds its p. Blocks of
more than ``BLOCK`` words split their range in two, again and again, down to one place, where
the alphabet bounds them; no block is cut, and a prefix that a third of all words share only
makes its ranges shorter.

Inside a block the words are sorted, and the banded rows of the edit matrix (three cells, as
one edit allows no more) are computed down the list: words that share a prefix, by the common
prefixes of neighbours in the list, share its rows, and a range of the list whose prefix is
more than one edit from a word is skipped for it as a whole. All words of all blocks of a task
go down the list together, one character at a time, as flat arrays.

Defined results: a null text has no words; a null doc_id counts as the empty string in the
check sums; texts of any length and repeated rows count as they are; an empty table gives no
rows; other columns are ignored. Words are compared as given: by code points, with case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from replylane.staging import stage

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
#: words of a block before its range is split
BLOCK = 2_048
#: words, and states of the scan, that a task holds at a time
CHUNK_WORDS, CHUNK_STATES = 1 << 14, 1 << 20

#: words of the vocabulary for each task of the scan
TASK_WORDS = 50_000

_FAR = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def misspelt_words(documents: DataFrame, every: int = 31) -> DataFrame:
    """One row (word) per run of letters of the texts that is long enough.

    Runs are lower-cased in A-Z only. Where ``every`` divides the check sum h of
    "<doc_id>:<run>", the character at h modulo the run's length is left out.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # Shorter runs cannot become long enough, and no such match begins inside one.
    pattern = F.lit(rf"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}")
    runs = documents.select(name.alias("name"), F.explode(
        F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), pattern, F.lit(0))
    ).alias("run"))
    h = F.crc32(F.concat("name", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(
        F.col("h") % every == 0,
        F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))),
    ).otherwise(F.col("run"))
    return runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= MIN_LENGTH)


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Distinct words with their number of occurrences n; counted before the shuffle."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _keyed(words: DataFrame) -> DataFrame:
    """Rows of blocks: word, n, the range (size, lo, hi), and the key of what the block shares."""
    head = F.substring(F.col("word"), F.lit(1), F.col("lo"))
    shared = F.col("size") - F.col("hi")
    tail = F.when(shared > 0, F.expr("right(word, size - hi)")).otherwise(F.lit(""))
    return words.withColumn("key", F.concat_ws("\0", "size", "lo", "hi", head, tail))


def _halves(low: Column, high: Column) -> Column:
    middle = F.floor((low + high) / 2).cast("int")
    return F.explode(F.array(
        F.struct(low.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), high.alias("hi"))
    ))


def _split(words: DataFrame) -> DataFrame:
    kept = words.select("word", "n", "size", _halves(F.col("lo"), F.col("hi")).alias("range"))
    return _keyed(kept.select("word", "n", "size", "range.lo", "range.hi"))


def blocks(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """All rows (key, size, lo, hi, word, n) of blocks in which pairs can meet."""
    longest = words.agg(F.max(F.length("word"))).first()[0] or 1
    sizes = F.explode(F.array(F.length("word"), F.length("word") - 1))
    # p = size is the place behind the last character
    whole = words.select("word", "n", sizes.alias("size")).where("size > 0")
    todo = _split(whole.withColumn("lo", F.lit(0)).withColumn("hi", F.col("size") + 1))
    done = []
    for _ in range(longest.bit_length() + 1):
        todo = stage(todo, "spelling-rows")
        counts = stage(
            todo.groupBy("key", "size", "lo", "hi").agg(
                F.count("*").alias("m"), F.max(F.length("word")).alias("most"),
                F.min(F.length("word")).alias("least"),
            ).where("m > 1 and least = size"), "spelling-blocks",
        )
        large = (F.col("m") > block) & (F.col("hi") - F.col("lo") > 1)
        done.append(todo.join(counts.where(~large).select("key"), "key", "left_semi"))
        if counts.where(large).isEmpty():
            break
        todo = _split(todo.join(counts.where(large).select("key"), "key", "left_semi").drop("key"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


class SortedList:
    """Words of whole blocks, sorted by block and word, as padded code points."""

    def __init__(self, words: list[str], block: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        self.block, self.size, self.lo, self.hi = block, size, lo, hi
        self.length = np.array([len(w) for w in words], np.int32)
        self.width = int(self.length.max()) + 3
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int32)
        self.points = np.zeros((len(words), self.width), np.int32)
        self.points[np.arange(self.width) < self.length[:, None]] = points
        # how many characters each word shares with the one before it in its block
        unequal = self.points[1:] != self.points[:-1]
        self.common = np.append(-1, np.where(block[1:] == block[:-1], unequal.argmax(1), -1))
        self.starts: dict[int, np.ndarray] = {}

    def ranges(self, depth: int) -> np.ndarray:
        """Where the runs of words of a block with equal first ``depth`` characters begin."""
        if depth not in self.starts:
            self.starts[depth] = np.flatnonzero(self.common < depth)
        return self.starts[depth]

    def near(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All ordered pairs (word, near word) that meet in their block."""
        for low in np.unique(self.lo):
            # a block's words share their first lo characters: all rows begin there, alike
            words = np.flatnonzero(self.lo == low)
            starts = self.ranges(int(low))
            nodes = starts[np.searchsorted(starts, words, "right") - 1]
            rows = np.tile(np.array([1 if low else _FAR, 0, 1], np.int8), (len(words), 1))
            work = [(int(low), words, nodes, rows)]
            while work:
                state = work.pop()
                first, counts = self._children(*state[:3])
                if counts.sum() > CHUNK_STATES and len(state[1]) > 1:
                    half = len(state[1]) // 2
                    work += [(state[0], *(a[part] for a in state[1:]))
                             for part in (slice(half, None), slice(None, half))]
                    continue
                yield self._ended(*state)
                if counts.any():
                    work.append(self._down(*state, first, counts))

    def _children(self, depth: int, words: np.ndarray, nodes: np.ndarray):
        """Of each range, the first among the ranges of one more character, and their number."""
        starts, longer = self.ranges(depth), self.ranges(depth + 1)
        stops = np.append(starts[1:], len(self.length))[np.searchsorted(starts, nodes)]
        # a word that ends here is the first of its range, and has no longer prefix
        first = np.searchsorted(longer, nodes) + (self.length[nodes] == depth)
        return first, np.searchsorted(longer, stops) - first

    def _ended(self, depth: int, words: np.ndarray, nodes: np.ndarray, rows: np.ndarray):
        """Pairs one edit apart whose second word ends at this depth."""
        step = self.length[words] - depth
        hit = np.flatnonzero((self.length[nodes] == depth) & (np.abs(step) <= 1))
        hit = hit[rows[hit, step[hit] + 1] == 1]
        x, y = words[hit], nodes[hit]
        # the shorter one has the block's size, and the first difference lies in its range
        place = (self.points[x] != self.points[y]).argmax(1)
        here = np.minimum(self.length[x], self.length[y]) == self.size[x]
        here &= (place >= self.lo[x]) & (place < self.hi[x])
        return x[here], y[here]

    def _down(self, depth, words, nodes, rows, first, counts):
        """The ranges of one more character, without those more than one edit away.

        A row holds the edits between a range's prefix of ``depth`` characters and the first
        depth - 1, depth and depth + 1 characters of a word.
        """
        parent = np.repeat(np.arange(len(words)), counts)
        offsets = np.cumsum(counts) - counts
        child = self.ranges(depth + 1)[(first - offsets)[parent] + np.arange(len(parent))]
        word, old = words[parent], rows[parent]
        char = self.points[child, depth]
        new = np.empty_like(old)
        left = np.full(len(parent), _FAR, np.int8)
        for cell in range(3):
            at = depth + cell - 1  # the last character of the word that the cell takes in
            best = left + 1
            if at >= 0:
                best = np.minimum(best, old[:, cell] + (self.points[word, at] != char))
            if cell < 2:
                best = np.minimum(best, old[:, cell + 1] + 1)
            left = new[:, cell] = np.where(at < self.length[word], np.minimum(best, _FAR), _FAR)
        live = new.min(1) < _FAR
        return depth + 1, word[live], child[live], new[live]


def _scan(words: pa.Table) -> pa.RecordBatch:
    """Per word with near ones in these whole blocks: their number and the most frequent."""
    names = words.column("word").to_pylist()
    key = words.column("key").to_pylist()
    block = np.cumsum([0, *(a != b for a, b in zip(key, key[1:]))])
    size, lo, hi, n = (words.column(c).to_numpy() for c in ("size", "lo", "hi", "n"))
    found = [*SortedList(names, block, size, lo, hi).near()]
    x, y = (np.concatenate(side) for side in zip(*found))
    order = np.lexsort((y, -n[y], x))  # words of a block stand in order
    x, y = x[order], y[order]
    firsts = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else x
    best = y[firsts]
    return pa.RecordBatch.from_arrays(
        [pa.array([names[i] for i in x[firsts]], pa.string()),
         pa.array(np.diff(np.append(firsts, len(x))), pa.int64()),
         pa.array(n[best], pa.int64()), pa.array([names[i] for i in best], pa.string())],
        ["word", "n_near", "form_n", "form"],
    )


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < CHUNK_WORDS:
            continue
        table = pa.Table.from_batches(held)
        key = table.column("key").to_pylist()
        cut = next((i for i in range(len(key) - 1, 0, -1) if key[i] != key[i - 1]), 0)
        if cut:
            yield _scan(table.slice(0, cut).combine_chunks())
        rest = table.slice(cut).combine_chunks()
        held, size = rest.to_batches(), rest.num_rows
    if size:
        yield _scan(pa.Table.from_batches(held).combine_chunks())


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per word (word, n) with near ones: n_near, and the most frequent one, form with form_n."""
    rows = blocks(words, block).select("key", "size", "lo", "hi", "word", "n")
    # a few bytes of words are much work, so the tasks are set by rows
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), words.count() // TASK_WORDS)
    sorted_list = rows.repartition(tasks, "key").sortWithinPartitions("key", "word")
    part = sorted_list.mapInArrow(_scan_batches, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), "form")).alias("best")
    return part.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.n")).alias("form_n"), "best.form"
    )


def follow(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form) without circles: each round doubles the steps taken."""
    current = stage(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = current.join(further, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
        )
        current = stage(joined, "spelling-roots")
        if current.where("moved").isEmpty():
            return current.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """Of a vocabulary (word, n) of distinct words: word, form, root, n, n_near, form_n."""
    words = stage(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = near_words(words, block)
    enough = F.col("form_n") >= ratio * F.col("n")
    found = stage(words.join(near, "word", "left").select(
        "word", F.when(enough, F.col("form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("form_n")).alias("form_n"),
    ), "spelling-forms")
    roots = follow(found.where("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
