import random

import pytest
from tokenizers import Tokenizer

from replylane.llm import bpe

SPECIAL = ["<|endoftext|>", "<|startoftext|>", "<|", "|>"]
POOL = [*SPECIAL, " ", "\n", "\x1c", "\u2003", "'s", "'RE", "'", "aaaa", "aa", "The", "ΣΑΣ", "é", "e\u0301", "İ", "1",
        "12", "²", "-", "...", "_", "ª", "漢字", "😀", "\u200d", "ﬁ", "א", "\x00", "internationalisation"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.WORD_BPE)


@pytest.fixture(scope="module")
def encoder():
    with open(bpe.WORD_BPE, encoding="utf-8") as file:
        return bpe.Encoder(file.read())


def compare(library, encoder, texts):
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == want


def test_ids_are_those_of_the_library(library, encoder):
    rng = random.Random(3)
    draw = lambda top: "".join(chr(c) for c in (rng.randrange(top) for _ in range(rng.randrange(24))) if not 0xD800 <= c < 0xE000)
    for _ in range(2):
        compare(library, encoder, ["".join(rng.choice(POOL) for _ in range(rng.randrange(12))) for _ in range(3000)])
        compare(library, encoder, [draw(rng.choice([128, 0x250, 0x3000, 0x110000])) for _ in range(3000)])
    compare(library, encoder, ["x" + chr(c) + "'S" + chr(c) + "y1 " for c in range(0x300)])


def test_long_words_and_repeats(library, encoder):
    rng = random.Random(4)
    compare(library, encoder, ["a" * 20_000, "".join(rng.choice("abcde") for _ in range(20_000)), "", "é" * 3_000, "a a a"])


def test_the_memory_of_parts_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PARTS", 5)
    monkeypatch.setattr(bpe, "ROUND_CHARS", 40)
    with open(bpe.WORD_BPE, encoding="utf-8") as file:
        small = bpe.Encoder(file.read())
    texts = [" ".join(f"word{i * j}" for j in range(9)) + "z" * 70 for i in range(30)]
    for i in range(0, 30, 3):
        compare(library, small, texts[i : i + 3])


def test_rows_in_spark(spark, library):
    rows = [(1, "Hello wörld <|endoftext|> it's", 7, "x"), (None, None, 8, "y"), (2, "", 9, None), (1, "Hello", 1, "x"), (1, "Hello", 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    coded = bpe.encode(df)
    assert coded.columns == ["doc_id", "decoded", "ids"]
    back = bpe.decode(coded)
    assert back.columns == ["doc_id", "ids", "decoded"]
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(want, key=str)
    assert bpe.decode(bpe.encode(df.limit(0))).count() == 0
    nulls = spark.createDataFrame([(None,), ([3, 4],)], "ids array<int>")
    assert {r.decoded for r in bpe.decode(nulls).collect()} == {"", "$ %"}
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([([10**6],)], "ids array<int>")).collect()
