"""Tokens of two tokenizers over the same bytes: aligned groups, links, and counts of links.

Each text is encoded by a byte-level vocabulary (A, with a blank before the text) and by a
vocabulary of pieces (B, which adds that blank). Where tokens of both end at the same byte, a
group ends; an A and a B token whose bytes overlap are linked. How often each pair of ids is
linked in the whole corpus is counted outside memory, and each document gets back what its
links count:

1. *Spill.* A task aggregates the pairs of each document to records (pair, document, links),
   radix-partitions and sorts them, and writes them as runs of zstd blocks, beside the run's
   own counts by pair and its documents. Runs hold whole documents.
2. *Merge.* The counts of the runs, one record per pair and run, are merged with a heap over
   the runs' blocks, ``FAN_IN`` runs at a time, until ``FAN_IN`` runs are left; these are
   merged partition by partition. Records stand in the order of B ids, so the highest count of
   a B id is known when its records end. A pair that all documents hold is one record per run.
3. *Stream back.* The runs' records and the merged counts stand in the same order, so each
   task joins its runs to the counts block by block and adds up each document's share.

Only lists of files are shuffled. Files lie in the shared folder under names of the task
attempt, and lists of finished attempts say which are read.

Defined results: null and empty texts, and texts that one of the vocabularies does not give
back byte by byte, have no tokens: counts of zero and empty groups; special tokens' strings
are plain text; a null doc_id stays null; repeated rows are documents of their own; texts of
any length are encoded whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from replylane.llm import files
from replylane.llm.bpe import BYTE_CHARS, VOCABULARY_BYTES
from replylane.staging import new_path, stage

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: partitions by the low digits of the B id
RADIX = 64
#: runs that one merge takes, or one task streams back together
FAN_IN = 64
TOGETHER = 8
#: records, documents and bytes of texts after which a run is written
RUN_RECORDS, RUN_DOCUMENTS = 1 << 20, 1 << 20
SLICE_BYTES = 1 << 20
BLOCK_RECORDS = 1 << 14
#: parts of texts that a task remembers, and the longest of them
KNOWN_PARTS, KNOWN_LENGTH = 200_000, 64

_APART = re.compile(r"(?<=\S) (?=\S)")
_INNER_BLANK = re.compile("[^▁]▁")

DOCUMENTS = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups", pa.large_string()), ("place", pa.int64()),
])


class Runs:
    """Files of records (key, value), sorted by key: zstd blocks, then an index of them."""

    @staticmethod
    def write(out, keys_and_values: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> int:
        """Write records given as (partition, keys, values) in order; returns their number."""
        pack = zstandard.ZstdCompressor(level=1).compress
        index, place, total = [], 0, 0
        for part, keys, values in keys_and_values:
            for at in range(0, len(keys), BLOCK_RECORDS):
                k, v = keys[at : at + BLOCK_RECORDS], values[at : at + BLOCK_RECORDS]
                wide = np.int64 if v.max() >= 1 << 31 else np.int32
                steps = np.diff(k, prepend=np.int64(0))
                data = pack(steps.tobytes() + v.astype(wide).tobytes())
                out.write(data)
                index.append((part, place, len(data), len(k)))
                place += len(data)
                total += len(k)
        listed = np.array(index, np.int64).tobytes()
        out.write(listed + np.int64(len(listed)).tobytes())
        return total

    def __init__(self, path: str):
        filesystem, place = files.at(path)
        self.file = filesystem.open_input_file(place)
        size = self.file.size()
        listed = int(np.frombuffer(self.file.read_at(8, size - 8), np.int64)[0])
        self.index = np.frombuffer(self.file.read_at(listed, size - 8 - listed), np.int64).reshape(-1, 4)

    def blocks(self, part: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        unpack = zstandard.ZstdDecompressor().decompress
        for _, place, length, count in self.index[self.index[:, 0] == part].tolist():
            data = unpack(self.file.read_at(length, place))
            wide = np.int64 if len(data) == 16 * count else np.int32
            yield np.cumsum(np.frombuffer(data, np.int64, count)), np.frombuffer(data, wide, count, 8 * count).astype(np.int64)

    def close(self) -> None:
        self.file.close()


def merged(sources: list[Iterator[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Merge sorted blocks of (keys, counts); counts of equal keys are added up.

    The heap holds each source's block under its last key: up to the least of these, nothing
    more can come, so these records are merged and given out.
    """
    heap: list[tuple[int, int]] = []
    block: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def load(i: int) -> None:
        found = next(sources[i], None)
        if found is not None:
            block[i] = found
            heapq.heappush(heap, (int(found[0][-1]), i))

    for i in range(len(sources)):
        load(i)
    while heap:
        bound, ready = heap[0][0], []
        while heap and heap[0][0] == bound:
            ready.append(heapq.heappop(heap)[1])
        taken = []
        for i in list(block):
            keys, values = block[i]
            cut = len(keys) if i in ready else int(np.searchsorted(keys, bound, "right"))
            if cut:
                taken.append((keys[:cut], values[:cut]))
                block[i] = (keys[cut:], values[cut:])
        for i in ready:
            del block[i]
            load(i)
        keys = np.concatenate([k for k, _ in taken])
        values = np.concatenate([v for _, v in taken])
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        yield keys[first], np.add.reduceat(values, first)


class Pairs:
    """Numbers of pairs (a, b), in the order of partitions, B ids and A ids."""

    def __init__(self, size_a: int, size_b: int, radix: int = RADIX):
        self.size_a, self.radix = size_a, radix
        self.per_part = -(-size_b // radix)
        bits = (radix * self.per_part * size_a).bit_length()
        self.shift = (RUN_DOCUMENTS - 1).bit_length()
        if bits + self.shift > 63:
            raise ValueError("the vocabularies are too large for pairs of 64 bits")

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((b % self.radix) * self.per_part + b // self.radix) * self.size_a + a

    def by_part(self, pairs: np.ndarray, keys: np.ndarray, values: np.ndarray):
        edges = np.searchsorted(pairs, np.arange(self.radix + 1) * self.per_part * self.size_a)
        for part in range(self.radix):
            here = slice(edges[part], edges[part + 1])
            if edges[part] < edges[part + 1]:
                yield part, keys[here], values[here]


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of so many values."""
    ends = np.cumsum(counts)
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return total[ends] - total[ends - counts]


def _mark(text: str) -> pa.Scalar:
    return pa.scalar(text, pa.large_string())


class Tokens:
    """The bytes of a vocabulary's entries, and of runs of ids."""

    def __init__(self, entries: list[bytes]):
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(entries) + b"\0", np.uint8)
        self.decimal = pa.array([str(i) for i in range(len(entries))], pa.large_string())

    def spell(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ids) else 0)
        return self.data[at]


def _byte_entries(file: str) -> list[bytes]:
    content = json.loads(file)
    byte_of = {c: b for b, c in enumerate(BYTE_CHARS)}
    found = {i: bytes(map(byte_of.__getitem__, e)) for e, i in content["model"]["vocab"].items()}
    size = 1 + max([*found, *(t["id"] for t in content["added_tokens"])])
    return [found.get(i, b"") for i in range(size)]


def _piece_entries(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(
            bytes([int(piece[3:5], 16)]) if model.is_byte(i)
            else b"" if model.is_control(i) or model.is_unknown(i)
            else piece.replace("▁", " ").encode()
        )
    return out


class Aligner:
    """Encodes texts with both vocabularies and aligns the tokens."""

    def __init__(self, file_a: str, file_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.encode_a = Tokenizer.from_str(file_a)
        self.encode_a.encode_special_tokens = True
        self.encode_b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        self.a, self.b = Tokens(_byte_entries(file_a)), Tokens(_piece_entries(self.encode_b))
        self.pairs = Pairs(len(self.a.lengths), len(self.b.lengths))

    def encode(self, texts: list[str]):
        """Which texts both give back, and for these: flat A and B ids, and how many of each."""
        filled = np.array([bool(text) for text in texts], bool)
        spaced = [" " + text for text in texts if text]
        ids_a = [e.ids for e in self.encode_a.encode_batch_fast(spaced, add_special_tokens=False)]
        ids_b = self.encode_b.encode([text for text in texts if text], num_threads=1)
        written = [text.encode() for text in spaced]
        size = np.array([len(w) for w in written], np.int64)
        flat, count, whole = [], [], np.ones(len(spaced), bool)
        for side, ids in ((self.a, ids_a), (self.b, ids_b)):
            flat.append(np.fromiter(chain.from_iterable(ids), np.int64))
            count.append(np.array([len(i) for i in ids], np.int64))
            whole &= _sums(side.lengths[flat[-1]], count[-1]) == size
        data = np.frombuffer(b"".join(w for w, k in zip(written, whole.tolist()) if k), np.uint8)
        for side, ids, n in zip((self.a, self.b), flat, count):
            same = side.spell(ids[np.repeat(whole, n)]) == data
            whole[whole] = _sums(~same, size[whole]) == 0
            if not whole.all():
                # compare the other side with what is left
                data = np.frombuffer(b"".join(w for w, k in zip(written, whole.tolist()) if k), np.uint8)
        flat = [ids[np.repeat(whole, n)] for ids, n in zip(flat, count)]
        filled[filled] = whole
        return filled, *flat, *(n[whole] for n in count)

    def align(self, texts: list[str]) -> Aligned:
        """The tokens of texts, each encoded as a whole."""
        count = len(texts)
        whole, a, b, many_a, many_b = self.encode(texts)
        last_a, last_b = np.cumsum(many_a), np.cumsum(many_b)
        held = int(whole.sum())
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        stops = ends_a[last_a - 1]  # where each document ends, in bytes
        # between two neighbouring ends, of either side, lies what one A and one B token share
        cuts = np.union1d(ends_a, ends_b)
        link_a, link_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        document = np.searchsorted(stops, cuts)
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_of = np.searchsorted(stops, both)

        def spread(values):
            out = np.zeros(count, np.int64)
            out[whole] = values
            return out

        def written(side, ids, ends):
            offsets = np.append(0, np.searchsorted(ends, both) + 1)
            return pc.binary_join(
                pa.LargeListArray.from_arrays(offsets, side.decimal.take(pa.array(ids))), _mark(",")
            )

        groups = pc.binary_join_element_wise(written(self.a, a, ends_a), written(self.b, b, ends_b), _mark("|"))
        per_document = spread(np.bincount(group_of, minlength=held))
        joined = pc.binary_join(
            pa.LargeListArray.from_arrays(np.append(0, np.cumsum(per_document)), groups), _mark(";")
        )
        return Aligned(
            whole, spread(many_a), spread(many_b), per_document, joined,
            spread(np.bincount(document, minlength=held)), self.pairs.number(a[link_a], b[link_b]),
        )


@dataclass
class Aligned:
    """Of texts: whether both vocabularies give them back, and if so what their tokens are."""

    whole: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: pa.Array
    n_links: np.ndarray
    #: the pair numbers of all links, text by text
    links: np.ndarray


class Parts:
    """Texts aligned part by part, with the parts remembered.

    A blank between two characters that are not white space always begins a token of either
    vocabulary, whatever stands around: A splits there before it merges, and no piece of B
    holds a blank behind another character, which is checked. So a group ends there too, and
    what stands between two such blanks can be encoded and aligned by itself.
    """

    def __init__(self, aligner: Aligner):
        pieces = map(aligner.encode_b.id_to_piece, range(aligner.encode_b.get_piece_size()))
        if any(_INNER_BLANK.search(piece) for piece in pieces):
            raise ValueError("pieces with a blank inside cannot be aligned part by part")
        self.aligner = aligner
        self.known: dict[str, tuple] = {}

    def _learn(self, parts: list[str]) -> Iterator[tuple[str, tuple]]:
        found = self.aligner.align(parts)
        links = found.links.tobytes()
        ends = (8 * np.cumsum(found.n_links)).tolist()
        yield from zip(parts, zip(
            found.whole.tolist(), found.n_a.tolist(), found.n_b.tolist(), found.n_groups.tolist(),
            found.groups.to_pylist(), found.n_links.tolist(),
            [links[a:b] for a, b in zip([0, *ends], ends)],
        ))

    def align(self, texts: list[str]) -> Aligned:
        split = [_APART.split(text) if text else [] for text in texts]
        counts = np.array([len(parts) for parts in split], np.int64)
        if len(self.known) > KNOWN_PARTS:
            self.known.clear()
        place = {part: i for i, part in enumerate(dict.fromkeys(p for parts in split for p in parts))}
        fresh = dict(self._learn([p for p in place if p not in self.known]))
        self.known.update((p, row) for p, row in fresh.items() if len(p) <= KNOWN_LENGTH)
        rows = [fresh[p] if p in fresh else self.known[p] for p in place]
        whole, n_a, n_b, n_groups, groups, n_links, links = zip(*rows) if rows else [()] * 7
        of = np.array([place[p] for parts in split for p in parts], np.int64)
        text_of = np.repeat(np.arange(len(texts)), counts)
        good = counts > 0
        good[text_of[~np.array(whole, bool)[of]]] = False
        of, text_of = of[good[text_of]], text_of[good[text_of]]

        def total(values) -> np.ndarray:
            return np.bincount(text_of, np.array(values, np.int64)[of], len(texts)).astype(np.int64)

        each = np.array(n_links, np.int64)
        starts, many = (np.cumsum(each) - each)[of], each[of]
        ends = np.cumsum(many)
        at = np.repeat(starts - (ends - many), many) + np.arange(ends[-1] if len(of) else 0)
        per_text = np.bincount(text_of, minlength=len(texts))
        joined = pc.binary_join(pa.LargeListArray.from_arrays(
            np.append(0, np.cumsum(per_text)), pa.array(groups, pa.large_string()).take(pa.array(of))
        ), _mark(";"))
        return Aligned(
            good, total(n_a), total(n_b), total(n_groups), joined, total(n_links),
            np.frombuffer(b"".join(links), np.int64)[at],
        )


class Spill:
    """Collects the records of whole documents and writes them as runs."""

    def __init__(self, folder: str, pairs: Pairs):
        self.filesystem, self.root = files.at(folder)
        self.filesystem.create_dir(self.root, recursive=True)
        self.folder, self.stem, self.pairs = folder, files.attempt_stem(), pairs
        self.number = 0
        self._open()

    def _open(self) -> None:
        self.name = f"{self.stem}-{self.number:06d}"
        self.number += 1
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.records = self.documents = self.rows = 0
        self.sink = self.filesystem.open_output_stream(f"{self.root}/{self.name}.docs")
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        self.stream = pa.ipc.new_stream(self.sink, DOCUMENTS, options=options)

    def add(self, doc_ids: pa.Array, found: Aligned) -> None:
        place = np.where(found.whole, self.documents + np.cumsum(found.whole) - 1, -1)
        self.stream.write_batch(pa.RecordBatch.from_pydict({
            "doc_id": doc_ids, "n_a": found.n_a, "n_b": found.n_b, "n_groups": found.n_groups,
            "n_links": found.n_links, "groups": found.groups, "place": place,
        }, DOCUMENTS))
        of = np.repeat(place, found.n_links)
        keys = np.sort((found.links << self.pairs.shift) + of)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else keys
        keys, counts = keys[first], np.diff(np.append(first, len(keys)))
        self.keys.append(keys)
        self.counts.append(counts)
        self.records += len(keys)
        self.documents += int(found.whole.sum())
        self.rows += len(doc_ids)

    def full(self) -> bool:
        return self.records >= RUN_RECORDS or self.documents >= RUN_DOCUMENTS // 2

    def close(self) -> tuple[str, int]:
        """Write the run; returns its path and rows, and begins the next."""
        self.stream.close()
        self.sink.close()
        keys = np.concatenate([np.zeros(0, np.int64), *self.keys])
        counts = np.concatenate([np.zeros(0, np.int64), *self.counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        numbers = keys >> self.pairs.shift
        with self.filesystem.open_output_stream(f"{self.root}/{self.name}.pairs") as out:
            Runs.write(out, self.pairs.by_part(numbers, keys, counts))
        first = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])) if len(numbers) else order
        sums = np.add.reduceat(counts, first) if len(first) else counts
        with self.filesystem.open_output_stream(f"{self.root}/{self.name}.counts") as out:
            Runs.write(out, self.pairs.by_part(numbers[first], numbers[first], sums))
        done = f"{self.folder}/{self.name}", self.rows
        self._open()
        return done

    def abandon(self) -> None:
        self.stream.close()
        self.sink.close()


def _shipped(spark: SparkSession, path_a: str, path_b: str):
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        found = a.read(), b.read()
    if sum(map(len, found)) > VOCABULARY_BYTES:
        raise ValueError(f"the vocabularies have more than {VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(found)


def spill(documents: DataFrame, folder: str, shipped) -> DataFrame:
    """Align all documents and write runs to ``folder``; the list (path, rows) of them."""

    def run(batches):
        parts = Parts(Aligner(*shipped.value))
        out = Spill(folder, parts.aligner.pairs)
        done: list[tuple[str, int]] = []
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
            first = 0
            while first < len(texts):
                before = sizes[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, "right")))
                part = slice(first, last)
                out.add(batch.column("doc_id")[part], parts.align(texts[part].to_pylist()))
                first = last
                if out.full():
                    done.append(out.close())
        if out.rows:
            done.append(out.close())
        out.abandon()
        yield pa.RecordBatch.from_pydict({
            "path": pa.array([p for p, _ in done], pa.string()), "rows": pa.array([n for _, n in done], pa.int64()),
        })

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("text").cast("string").alias("text"))
    return stage(slim.mapInArrow(run, "path string, rows long"), "alignment-runs")


def _merge_to(out_folder: str, paths: list[str], name: str, parts, change: Callable) -> str:
    """Merge the counts of runs, partition by partition, into one file."""
    filesystem, root = files.at(out_folder)
    filesystem.create_dir(root, recursive=True)
    runs = [Runs(path) for path in paths]
    target = f"{files.attempt_stem()}-{name}.counts"
    with filesystem.open_output_stream(f"{root}/{target}") as out:
        Runs.write(out, (
            (part, *block) for part in parts
            for block in change(merged([run.blocks(part) for run in runs]))
        ))
    for run in runs:
        run.close()
    return f"{out_folder}/{target}"


def _with_maxima(size_a: int):
    """Marks pairs whose count is their B id's highest: twice the count, and 1 for these."""

    def change(blocks):
        held_keys, held_counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def marked(keys, counts):
            side = keys // size_a
            first = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
            highest = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(keys))))
            return keys, 2 * counts + (counts == highest)

        for keys, counts in blocks:
            keys, counts = np.concatenate([held_keys, keys]), np.concatenate([held_counts, counts])
            cut = int(np.searchsorted(keys, keys[-1] // size_a * size_a))  # where the last B id begins
            if cut:
                yield marked(keys[:cut], counts[:cut])
            held_keys, held_counts = keys[cut:], counts[cut:]
        if len(held_keys):
            yield marked(held_keys, held_counts)

    return change


def merge_counts(runs: DataFrame, folder: str, size_a: int, fan_in: int = FAN_IN) -> dict[int, str]:
    """The file of merged and marked counts of each partition, at most ``RADIX`` files."""
    spark = runs.sparkSession
    paths = runs.select(F.concat("path", F.lit(".counts")).alias("path"))
    count = paths.count()
    while count > fan_in:
        groups = -(-count // fan_in)
        dealt = paths.withColumn("group", F.pmod(F.xxhash64("path"), F.lit(groups)))

        def merge_group(table: pa.Table) -> pa.Table:
            names = sorted(table.column("path").to_pylist())
            path = _merge_to(folder, names, str(table.column("group")[0]), range(RADIX), lambda blocks: blocks)
            return pa.table({"path": [path]})

        paths = stage(dealt.groupBy("group").applyInArrow(merge_group, "path string"), "alignment-merged")
        before, count = count, paths.count()
        if count >= before:
            raise RuntimeError("merging did not lower the number of runs")
    last = [row["path"] for row in paths.collect()]  # at most fan_in

    def merge_part(batches):
        for batch in batches:
            for part in batch.column("id").to_pylist():
                path = _merge_to(folder, last, f"part{part}", [part], _with_maxima(size_a))
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "path": [path]})

    parts = spark.range(0, RADIX, 1, RADIX).mapInArrow(merge_part, "part long, path string")
    return {row["part"]: row["path"] for row in stage(parts, "alignment-counts").collect()}


class Shares:
    """What the links of a run's documents count, added up as merged counts stream by."""

    def __init__(self, path: str, rows: int, shift: int):
        self.path, self.shift = path, shift
        self.file = Runs(f"{path}.pairs")
        self.best, self.total = np.zeros(rows, np.int64), np.zeros(rows, np.int64)

    def begin(self, part: int) -> None:
        self.source = self.file.blocks(part)
        self.block = next(self.source, None)

    def take(self, pairs: np.ndarray, marked: np.ndarray) -> None:
        """Use up all records of pairs up to the last of these."""
        while self.block is not None:
            keys, links = self.block
            numbers = keys >> self.shift
            cut = int(np.searchsorted(numbers, pairs[-1], "right"))
            place = np.searchsorted(pairs, numbers[:cut])
            if not np.array_equal(pairs[place], numbers[:cut]):
                raise RuntimeError(f"{self.path} holds a pair that was not counted")
            document = keys[:cut] & ((1 << self.shift) - 1)
            np.add.at(self.best, document, links[:cut] * (marked[place] & 1))
            np.add.at(self.total, document, links[:cut] * (marked[place] >> 1))
            if cut < len(keys):
                self.block = keys[cut:], links[cut:]
                return
            self.block = next(self.source, None)

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.file.close()
        filesystem, root = files.at(self.path)
        with filesystem.open_input_stream(f"{root}.docs") as source:
            for batch in pa.ipc.open_stream(source):
                place = batch.column("place").to_numpy()
                has = place >= 0
                shares = [np.where(has, values[place], 0) if len(values) else 0 * place
                          for values in (self.best, self.total)]
                columns = {n: batch.column(n) for n in DOCUMENTS.names if n not in ("place", "groups")}
                yield pa.RecordBatch.from_pydict({
                    **columns, "n_best": shares[0], "count_sum": shares[1],
                    "groups": batch.column("groups").cast(pa.string()),
                })


RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups string"
)


def align(documents: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """Per document: numbers of tokens, groups and links, what its links count, and its groups.

    ``groups`` reads "a1,a2|b1;a3|b2,b3": ids of A and B by group, in order. ``n_best`` is the
    number of links whose count is the highest of their B id, ``count_sum`` the sum of counts.
    """
    spark = documents.sparkSession
    shipped = _shipped(spark, byte_bpe, piece_bpe)
    size_a = len(_byte_entries(shipped.value[0]))
    size_b = sentencepiece.SentencePieceProcessor(model_proto=shipped.value[1]).get_piece_size()
    shift = Pairs(size_a, size_b).shift
    runs = spill(documents, new_path(spark, "alignment-runs"), shipped)
    counted = merge_counts(runs, new_path(spark, "alignment-counts"), size_a)

    def stream_back(batches):
        listed = [(p, n) for batch in batches for p, n in zip(*(batch.column(c).to_pylist() for c in ("path", "rows")))]
        for first in range(0, len(listed), TOGETHER):
            runs_here = [Shares(path, rows, shift) for path, rows in listed[first : first + TOGETHER]]
            for part, path in sorted(counted.items()):
                counts = Runs(path)
                for run in runs_here:
                    run.begin(part)
                for pairs, marked in counts.blocks(part):
                    for run in runs_here:
                        run.take(pairs, marked)
                counts.close()
            for run in runs_here:
                yield from run.rows()

    tasks = max(1, -(-runs.count() // 2))
    return runs.repartition(tasks).mapInArrow(stream_back, RESULT)
