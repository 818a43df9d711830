import random

import numpy as np
import pytest

from replylane.llm import packing


@pytest.fixture(scope="module")
def tokeniser():
    return packing.Tokeniser(packing.VOCABULARY)


def test_remembered_parts_change_nothing(tokeniser):
    rng = random.Random(1)
    parts = ["word", "Über", "it's", "12,5", "\n", "\t", " ", "  ", "###", "don't", "x\ny", "\n\n", "é", "\u00a0", "\u2003", "\r", "\x1c", "\x85", "\u3000", "<|endoftext|>"]
    for _ in range(2):
        for _ in range(500):
            text = "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 12)))
            assert tokeniser.encode(text) == tokeniser.whole(text)
            ids = np.frombuffer(tokeniser.encode(text), np.uint16).tolist()
            assert tokeniser.encoding.decode(ids) == text


def test_best_fit_matches_a_plain_search():
    rng = random.Random(2)
    for _ in range(50):
        context = rng.choice([7, 8, 50])
        lengths = [rng.randint(1, context) for _ in range(rng.randint(0, 60))]
        rooms = []
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fits = [r for r in rooms if r >= lengths[i]]
            if fits:
                rooms[rooms.index(min(fits))] -= lengths[i]
            else:
                rooms.append(context - lengths[i])
        rows = packing.best_fit(lengths, context)
        assert sorted(i for row in rows for i in row) == list(range(len(lengths)))
        assert sorted(context - sum(lengths[i] for i in row) for row in rows) == sorted(rooms)


def test_every_token_comes_back(spark, tokeniser):
    rng = random.Random(3)
    texts = ["", None, "a", "long words " * 400] + [
        " ".join(rng.choice(["alpha", "beta", "gamma,", "x  y"]) for _ in range(rng.randint(1, 200))) for _ in range(60)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "no id", "c"), (2, "a", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    context = 64
    got = packing.read_packs(packing.write_packs(df, context=context), context).collect()
    assert len({r.pack for r in got}) == len(got)
    pieces = {}
    for r in got:
        line = np.frombuffer(bytes(r.ids), np.uint16)
        assert len(line) == context and r.cu_seqlens[-1] == r.n_tokens and r.resets == r.cu_seqlens[:-1]
        assert (line[r.n_tokens:] == packing.END).all()
        for doc, start, a, b in zip(r.doc_ids, r.piece_starts, r.cu_seqlens[:-1], r.cu_seqlens[1:]):
            pieces.setdefault(doc, []).append((start, line[a:b].tolist()))
    want = {}
    for doc, text, _ in rows:
        want.setdefault(doc, []).append(np.frombuffer(tokeniser.encode(text or ""), np.uint16).tolist() + [packing.END])
    for doc, wholes in want.items():
        if len(wholes) == 1:
            assert [t for _, ids in sorted(pieces[doc]) for t in ids] == wholes[0]
        assert sum(len(ids) for _, ids in pieces[doc]) == sum(map(len, wholes))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.read_packs(packing.write_packs(df)).count() == 0
