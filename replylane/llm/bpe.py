"""Byte-pair encoding and decoding with a vocabulary of words, by batched merge rounds.

Encoding takes a text apart as the vocabulary's file says (special tokens, normaliser, split
pattern, bytes) and then merges the symbols of many words together: all symbols stand in one
flat array; in each round the ranks of all neighbouring pairs are found by binary search over
the sorted pair keys, each word picks its lowest rank, and that pair is merged wherever it
stands in the word, from left to right. Words without a pair left leave the array. Parts of
texts between blanks are remembered, so a word is merged once per task, or so.

Decoding looks up the symbols of ids. Both are one pass over the rows: no shuffle, no limit on
the length of a text or a word. The vocabulary file is read by the driver and sent to the
executors as it is; its size is checked against ``VOCABULARY_BYTES``.

Defined results: a null text is an empty one and has no ids; null ids decode to an empty text;
an id that the vocabulary does not have raises ValueError; repeated rows give repeated results;
an empty table gives no rows; other columns are passed on, and a column that has the name of a
result is replaced by it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from tokenizers import Tokenizer

# Fixed value: how the vocabulary splits texts.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
VOCABULARY_BYTES = 64 << 20
#: parts of texts, and words, that a task remembers, and the longest of them
KNOWN_PARTS, KNOWN_LENGTH = 200_000, 64
#: characters of unknown parts that are merged together
ROUND_CHARS = 1 << 18
#: rows that are encoded or decoded together
ROWS = 256

_NO_PAIR = np.iinfo(np.int32).max
_BLANKS = re.compile(r"[\t\n\x0B\f\r]")


def _byte_chars() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if it can be
    seen in Latin-1, else one of those from U+0100 on, in order."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in seen else next(others)) for b in range(256)]


BYTE_CHARS = _byte_chars()
# In Latin letters and signs up to U+024F nothing is composed, and what is a letter or a number
# has long been settled; parts of anything else are left to the library's own components.
_PLAIN = re.compile(r"[!-\x7E\xA1-\u024F]*")
_PLAIN_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\w\s]|_)+"
)


class MergeTable:
    """The merges of a vocabulary: sorted keys of symbol pairs, their ranks and results."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        self.size = max(vocabulary.values()) + 1
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in merges]
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int32)
        self.results = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        self.inner = np.array([vocabulary[c] for c in BYTE_CHARS], np.int32)
        self.last = np.array([vocabulary[c + suffix] for c in BYTE_CHARS], np.int32)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as bytes of 32-bit numbers."""
        lengths = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[points]
        filled = np.flatnonzero(lengths)
        ends = np.cumsum(lengths)
        symbols[ends[filled] - 1] = self.last[points[ends[filled] - 1]]
        word_of = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []
        while len(symbols):
            ranks = self._ranks(symbols, word_of)
            starts = np.flatnonzero(np.append(True, word_of[1:] != word_of[:-1]))
            sizes = np.diff(np.append(starts, len(symbols)))
            lowest = np.repeat(np.minimum.reduceat(ranks, starts), sizes)
            merging = lowest != _NO_PAIR
            if not merging.all():
                done_symbols.append(symbols[~merging])
                done_words.append(word_of[~merging])
                symbols, word_of, ranks, lowest = (
                    a[merging] for a in (symbols, word_of, ranks, lowest)
                )
                if not len(symbols):
                    break
            chosen = ranks == lowest
            # of pairs that overlap, as in "aaa", every second one from the left
            at = np.arange(len(chosen))
            first = chosen & ~np.append(False, chosen[:-1])
            chosen &= (at - np.maximum.accumulate(np.where(first, at, 0))) % 2 == 0
            symbols[chosen] = self.results[ranks[chosen]]
            keep = ~np.append(False, chosen[:-1])
            symbols, word_of = symbols[keep], word_of[keep]
        if not done_symbols:
            return [b""] * len(words)
        symbols, word_of = np.concatenate(done_symbols), np.concatenate(done_words)
        ids = symbols[np.argsort(word_of, kind="stable")].tobytes()
        ends = (4 * np.cumsum(np.bincount(word_of, minlength=len(words)))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _ranks(self, symbols: np.ndarray, word_of: np.ndarray) -> np.ndarray:
        """The rank of each symbol with the next one of its word."""
        out = np.full(len(symbols), _NO_PAIR, np.int32)
        left = np.flatnonzero(word_of[1:] == word_of[:-1])
        keys = symbols[left].astype(np.int64) * self.size + symbols[left + 1]
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[place] == keys
        out[left[found]] = self.ranks[place[found]]
        return out


class Encoder:
    """Ids of texts, for a vocabulary file of the tokenizers library with word ends."""

    def __init__(self, file: str):
        content = json.loads(file)
        model = content["model"]
        self.table = MergeTable(model["vocab"], model["merges"], model["end_of_word_suffix"])
        library = Tokenizer.from_str(file)
        self.normalise = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.special_at = re.compile("(" + "|".join(map(re.escape, names)) + ")")
        split = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        steps = [n["type"] for n in content["normalizer"]["normalizers"]]
        #: whether plain parts can be taken apart here, in the same way
        self.plain = split == SPLIT and steps == ["NFC", "Replace", "Lowercase"]
        self.byte_of = {c: b for b, c in enumerate(BYTE_CHARS)}
        self.parts: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def _take_apart(self, part: str) -> list[int | bytes]:
        """Special ids, and words as bytes, of a part of a text."""
        pieces = self.special_at.split(part)
        if len(pieces) == 1 and self.plain and _PLAIN.fullmatch(part):
            return [w.encode() for w in _PLAIN_WORDS.findall(part.lower())]
        out: list[int | bytes] = []
        for i, piece in enumerate(pieces):
            if i % 2:
                out.append(self.special[piece])
            elif piece:
                for word, _ in self.split(self.normalise(piece)):
                    out.append(bytes(map(self.byte_of.__getitem__, word)))
        return out

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        taken = [self._take_apart(part) for part in parts]
        words = list({w for items in taken for w in items if isinstance(w, bytes)} - self.words.keys())
        found = dict(zip(words, self.table.encode(words)))
        ids = {w: self.words[w] for items in taken for w in items if w in self.words} | found
        self.words.update((w, i) for w, i in found.items() if len(w) <= KNOWN_LENGTH)
        return {
            part: b"".join([
                ids[w] if isinstance(w, bytes) else np.int32(w).tobytes() for w in items
            ]) for part, items in zip(parts, taken)
        }

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Blanks belong to no token and change none beside them."""
        for known in (self.parts, self.words):
            if len(known) > KNOWN_PARTS:
                known.clear()
        split = [_BLANKS.sub(" ", text).split(" ") for text in texts]
        long: dict[str, bytes] = {}
        unknown: list[str] = []
        size = 0

        def learn():
            for part, ids in self._learn(unknown).items():
                (self.parts if len(part) <= KNOWN_LENGTH else long)[part] = ids

        for part in set().union(*split) - self.parts.keys():
            unknown.append(part)
            size += len(part)
            if size >= ROUND_CHARS:
                learn()
                unknown, size = [], 0
        learn()
        of = {**self.parts, **long} if long else self.parts
        return [np.frombuffer(b"".join([of[p] for p in parts]), np.int32) for parts in split]


def _broadcast_file(spark: SparkSession, vocabulary: str):
    with open(vocabulary, encoding="utf-8") as lines:
        file = lines.read()
    if len(file) > VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary} has more than {VOCABULARY_BYTES} characters")
    return spark.sparkContext.broadcast(file)


def _with(schema: StructType, name: str, kind) -> StructType:
    return StructType([f for f in schema if f.name != name] + [StructField(name, kind)])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def _replace(batch: pa.RecordBatch, names: list[str], name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [column if n == name else batch.column(n) for n in names], names
    )


def encode(
    documents: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str = WORD_BPE
) -> DataFrame:
    """The rows with a column ``ids`` (array of int) in place of their text."""
    shipped = _broadcast_file(documents.sparkSession, vocabulary)
    wanted = documents.drop(*[c for c in documents.columns if c == ids and c != text])
    schema = _with(StructType([f for f in wanted.schema if f.name != text]), ids, ArrayType(IntegerType()))
    names = schema.names

    def run(batches):
        encoder = Encoder(shipped.value)
        for batch in _slices(batches):
            found = encoder.encode(pc.fill_null(batch.column(text), "").to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int32), *found])
            yield _replace(batch, names, ids, pa.ListArray.from_arrays(offsets, flat))

    return wanted.withColumn(text, wanted[text].cast("string")).mapInArrow(run, schema)


def decode(
    documents: DataFrame, ids: str = "ids", text: str = "decoded", vocabulary: str = WORD_BPE
) -> DataFrame:
    """The rows with a column ``text``: the symbols of their ids, one blank between them."""
    shipped = _broadcast_file(documents.sparkSession, vocabulary)
    wanted = documents.drop(*[c for c in documents.columns if c == text and c != ids])
    schema = _with(wanted.schema, text, StringType())
    names = schema.names

    def run(batches):
        content = json.loads(shipped.value)
        names_of = content["model"]["vocab"] | {t["content"]: t["id"] for t in content["added_tokens"]}
        symbols = [None] * (max(names_of.values()) + 1)
        for token, i in names_of.items():
            symbols[i] = token
        table = pa.array(symbols, pa.large_string())
        for batch in _slices(batches):
            column = batch.column(ids)
            column = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())])
                .astype(np.int32),
                column.flatten(),
            )
            flat = column.values.to_numpy(zero_copy_only=False)
            if len(flat) and not 0 <= flat.min() <= flat.max() < len(table):
                raise ValueError("an id is not in the vocabulary")
            joined = pc.binary_join(
                pa.LargeListArray.from_arrays(
                    column.offsets.cast(pa.int64()), table.take(pa.array(flat))
                ), pa.scalar(" ", pa.large_string()),
            )
            if joined.null_count:
                raise ValueError("an id is not in the vocabulary")
            yield _replace(batch, names, text, joined.cast(pa.string()))

    return wanted.mapInArrow(run, schema)
