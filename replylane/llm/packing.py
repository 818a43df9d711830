"""Token ids packed into rows of fixed length, written as binary matrices.

Every document is tokenised whole and ends with the end token. A document longer than the
context is cut into pieces without losing a token; full pieces are rows of their own, and the
rests are packed by best fit in decreasing order: a segment tree over the capacities finds the
open row with the least room that is still enough. Packing goes on inside blocks of
``BLOCK_TOKENS`` tokens of a partition, so memory is bounded and nothing is shuffled.

Per partition two files are written: ``.ids``, the matrix of ids (little-endian, one row after
the other, padded), and ``.segments``, an Arrow stream with, per row, the documents, the first
token of each piece in its document, the cumulative segment lengths (``cu_seqlens``) and the
places at which positions start again at 0 (``resets``). They are listed by the attempt that
finished.

Defined results: a null text is an empty one, whose only token is the end token; a null
doc_id stays null; repeated rows are packed as documents of their own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from replylane.llm import files
from replylane.staging import new_path, stage

# Fixed value: the split pattern that the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256
CONTEXT = 2048
BLOCK_TOKENS = 2 << 20
#: parts that a task remembers, and the longest of them
KNOWN_PARTS, KNOWN_LENGTH = 100_000, 32
_APART = re.compile(r"(?<=\S) (?=\S)")

SEGMENTS = pa.schema([
    ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
    ("piece_starts", pa.list_(pa.int64())), ("cu_seqlens", pa.list_(pa.int32())),
    ("resets", pa.list_(pa.int32())),
])


class Tokeniser(dict):
    """Ids of a text as bytes of 16-bit numbers, remembering the parts between blanks.

    A blank between two characters that are not white space always begins a piece of the
    pattern, so the parts between such blanks can be encoded one by one; all other white space
    stays inside a part.
    """

    def __init__(self, vocabulary: str):
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        if max(ranks.values()) >= END:
            raise ValueError("the end token is taken by the vocabulary")
        self.encoding = tiktoken.Encoding(
            "packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def whole(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), np.uint16).tobytes()

    def __missing__(self, part: str) -> bytes:
        if len(self) >= KNOWN_PARTS:
            self.clear()
        ids = self.whole(" " + part)
        if len(part) <= KNOWN_LENGTH:
            self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        first, *rest = _APART.split(text)
        return self.whole(first) + b"".join(map(self.__getitem__, rest))


class OpenRows:
    """Rows with room, under a segment tree that counts them by the room they have left."""

    def __init__(self, context: int):
        self.size = 1 << context.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(context + 1)]

    def _change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, room: int, row: int) -> None:
        if room:
            self.rows[room].append(row)
            self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of a row with the least room of at least ``need``."""
        node = need + self.size
        while not self.count[node]:
            while node & 1:  # a right child: go up until there is something to the right
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.size:
            node <<= 1
            node += not self.count[node]
        room = node - self.size
        self._change(room, -1)
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], context: int) -> list[list[int]]:
    """Rows of piece numbers, by best fit over decreasing lengths; ties in order."""
    open_rows, rows = OpenRows(context), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = open_rows.take(lengths[i])
        room, row = found if found else (context, len(rows))
        if found is None:
            rows.append([])
        rows[row].append(i)
        open_rows.add(room - lengths[i], row)
    return rows


def pack(
    documents: Iterator[tuple[int | None, bytes]], context: int, block: int = BLOCK_TOKENS
) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """Matrices of rows with their segments, for documents given as 16-bit ids."""
    held: list[tuple[int | None, int, np.ndarray]] = []
    size = 0

    def flush():
        rows = best_fit([len(ids) for _, _, ids in held], context)
        matrix = np.full((len(rows), context), END, np.uint16)
        columns = {name: [] for name in SEGMENTS.names}
        for line, row in zip(matrix, rows):
            ends = np.cumsum([0, *[len(held[i][2]) for i in row]])
            line[: ends[-1]] = np.concatenate([held[i][2] for i in row])
            columns["n_tokens"].append(int(ends[-1]))
            columns["doc_ids"].append([held[i][0] for i in row])
            columns["piece_starts"].append([held[i][1] for i in row])
            columns["cu_seqlens"].append(ends.tolist())
            columns["resets"].append(ends[:-1].tolist())
        return matrix, pa.RecordBatch.from_pydict(columns, SEGMENTS)

    for doc_id, data in documents:
        ids = np.frombuffer(data, np.uint16)
        for start in range(0, len(ids), context):
            held.append((doc_id, start, ids[start : start + context]))
            size += len(held[-1][2])
            if size >= block:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def write_packs(
    documents: DataFrame, folder: str | None = None, vocabulary: str = VOCABULARY,
    context: int = CONTEXT,
) -> DataFrame:
    """Tokenise, pack and write; returns the list (path, rows, tokens) of the files."""
    folder = folder or new_path(documents.sparkSession, "packs")

    def run(batches):
        tokeniser = Tokeniser(vocabulary)
        end = np.array([END], np.uint16).tobytes()

        def encoded():
            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                    yield doc_id.as_py(), tokeniser.encode(text.as_py() or "") + end

        filesystem, root = files.at(folder)
        filesystem.create_dir(root, recursive=True)
        stem, rows, tokens = files.attempt_stem(), 0, 0
        with filesystem.open_output_stream(f"{root}/{stem}.ids") as ids, \
                filesystem.open_output_stream(f"{root}/{stem}.segments") as segments, \
                pa.ipc.new_stream(segments, SEGMENTS) as stream:
            for matrix, batch in pack(encoded(), context):
                ids.write(matrix.astype("<u2").tobytes())
                stream.write_batch(batch)
                rows += len(matrix)
                tokens += int(np.sum(batch.column("n_tokens").to_numpy()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{stem}"]), pa.array([rows]), pa.array([tokens])],
            ["path", "rows", "tokens"],
        )

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("text").cast("string").alias("text"))
    return stage(slim.mapInArrow(run, "path string, rows long, tokens long"), "pack-list")


def read_packs(listing: DataFrame, context: int = CONTEXT) -> DataFrame:
    """One row per packed row: pack, ids (16-bit, little-endian), and its segments."""
    schema = (
        "pack string, ids binary, n_tokens int, doc_ids array<long>, piece_starts array<long>, "
        "cu_seqlens array<int>, resets array<int>"
    )
    step = 256

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                filesystem, root = files.at(path)
                name, row = root.rpartition("/")[2].split("-")[0], 0
                with filesystem.open_input_stream(f"{root}.ids") as ids, \
                        filesystem.open_input_stream(f"{root}.segments") as segments:
                    for found in pa.ipc.open_stream(segments):
                        for first in range(0, found.num_rows, step):
                            part = found.slice(first, step)
                            data = ids.read(part.num_rows * context * 2)
                            if len(data) != part.num_rows * context * 2:
                                raise ValueError(f"{path} has fewer rows than segments")
                            lines = [data[i : i + context * 2] for i in range(0, len(data), context * 2)]
                            packs = [f"{name}/{row + i}" for i in range(part.num_rows)]
                            row += part.num_rows
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(packs), pa.array(lines, pa.binary()), *part.columns],
                                ["pack", "ids", *SEGMENTS.names],
                            )

    return listing.where("rows > 0").select("path").repartition(max(1, listing.count())).mapInArrow(run, schema)
