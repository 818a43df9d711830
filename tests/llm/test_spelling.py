import random
import re
import zlib
from collections import Counter

import pytest

from replylane.llm import queries, spelling


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def brute_force(counts):
    form, out = {}, {}
    for word, n in counts.items():
        close = [w for w in counts if near(word, w)]
        best = min(close, key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best is not None and counts[best] >= 10 * n else None
        out[word] = len(close)
    rows = set()
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        rows.add((word, form[word], root, n, out[word], counts.get(form[word])))
    return rows


@pytest.mark.parametrize("block", [2048, 3])
def test_variants_match_brute_force(spark, block):
    rng = random.Random(block)
    counts = {}
    for _ in range(500):
        counts["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 10)))] = rng.choice([1, 2, 3, 30, 31, 400, 5000])
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variants(df, block=block).collect()} == brute_force(counts)


def test_states_are_halved_without_loss(monkeypatch):
    import numpy as np
    words = sorted({"".join(c) for c in __import__("itertools").product("abcd", repeat=4)})
    monkeypatch.setattr(spelling, "CHUNK_STATES", 50)
    same = np.zeros(len(words), np.int64)
    found = spelling.SortedList(words, same, same + 4, same, same + 5)
    pairs = {(int(a), int(b)) for x, y in found.near() for a, b in zip(x, y)}
    assert pairs == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b)}


def test_whole_query_on_awkward_texts(spark, tmp_path):
    rng = random.Random(2)
    words = ["abcdefgh", "ABCDEFGH", "abcdefg", "Überfahrt", "überfahrt", "straßeneck", "abcdefghi", "short", "ÿÿÿÿÿÿÿÿ", "ab×cdefgh"]
    rows = [(i % 150, " ".join(rng.choice(words) + rng.choice(["", ".", "7"]) for _ in range(rng.randrange(30)))) for i in range(300)]
    rows += [(None, "abcdefgh " * 9), (5, None), (6, ""), (7, "abcdefgh," * 4000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    want = brute_force({w: n for w, n in counts.items() if n >= 2})
    got = queries.op11_spelling(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == want and len(want) > 8


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, word string, n int")
    assert spelling.variants(spelling.vocabulary(spelling.misspelt_words(df))).count() == 0
