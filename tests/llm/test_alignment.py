import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from replylane.llm import alignment

POOL = ["the", "The", " ", " ", " ", "  ", "\n", "\r", "\x1c", "\x85", "\u00a0", "\u2003", "é", "ß", "▁", "<|endoftext|>", "<s>", "漢字",
        "😀", "\x00", "ing", "Hello", "123", "=====", "\t", "ﬁ", "א", "a\u0301"]


def brute_force(rows):
    a_side = Tokenizer.from_file(alignment.BYTE_BPE)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)
    with open(alignment.BYTE_BPE, encoding="utf-8") as file:
        a_bytes, b_bytes = alignment._byte_entries(file.read()), alignment._piece_entries(b_side)

    def spans(ids, entries):
        ends = np.cumsum([0, *(len(entries[i]) for i in ids)]).tolist()
        return list(zip(ends, ends[1:], ids))

    documents, counts = [], Counter()
    for doc_id, text in rows:
        data = (" " + (text or "")).encode()
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        if b"".join(a_bytes[i] for i in a) != data or b"".join(b_bytes[i] for i in b) != data:
            a = b = []
        a, b = spans(a, a_bytes), spans(b, b_bytes)
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
        counts.update(links)
        ends = sorted({x[1] for x in a} & {y[1] for y in b})
        groups = ";".join(
            ",".join(str(x[2]) for x in a if low < x[1] <= high) + "|" + ",".join(str(y[2]) for y in b if low < y[1] <= high)
            for low, high in zip([0, *ends], ends))
        documents.append((doc_id, len(a), len(b), len(ends), links, groups))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(((d, n_a, n_b, n, len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), groups) for d, n_a, n_b, n, links, groups in documents), key=str)


def rows():
    rng = random.Random(1)
    found = [(i, "".join(rng.choice(POOL) for _ in range(rng.randrange(16)))) for i in range(250)]
    return found + [(None, "the end"), (1, None), (2, ""), (3, "the the " * 150), (3, "the the " * 150)]


@pytest.mark.parametrize("fan_in, records", [(64, 1 << 20), (2, 300)])
def test_counts_match_brute_force(spark, monkeypatch, fan_in, records):
    monkeypatch.setattr(alignment, "RUN_RECORDS", records)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 2_000)
    plain = alignment.merge_counts
    monkeypatch.setattr(alignment, "merge_counts", lambda runs, folder, size: plain(runs, folder, size, fan_in))
    df = spark.createDataFrame(rows(), "doc_id long, text string").repartition(3).selectExpr("*", "1 as place", "'x' as groups")
    assert sorted(map(tuple, alignment.align(df).collect()), key=str) == brute_force(rows())


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_merging_adds_equal_keys_of_any_blocks():
    rng = np.random.default_rng(5)
    sources, want = [], Counter()
    for _ in range(7):
        keys = np.unique(rng.integers(0, 200, rng.integers(0, 150)))
        counts = rng.integers(1, 9, len(keys))
        want.update(dict(zip(keys.tolist(), counts.tolist())))
        cuts = sorted(rng.integers(0, len(keys) + 1, 4).tolist())
        blocks = [(k, c) for k, c in zip(np.split(keys, cuts), np.split(counts, cuts)) if len(k)]
        sources.append(iter(blocks))
    got = list(alignment.merged(sources))
    keys = np.concatenate([k for k, _ in got])
    assert (np.diff(keys) > 0).all() and dict(zip(keys.tolist(), np.concatenate([c for _, c in got]).tolist())) == want


def test_the_highest_count_of_a_side_spans_blocks():
    blocks = [(np.array([10, 11]), np.array([3, 5])), (np.array([12, 20]), np.array([5, 1])), (np.array([21]), np.array([1]))]
    got = [np.concatenate(c) for c in zip(*alignment._with_maxima(10)(iter(blocks)))]
    assert got[0].tolist() == [10, 11, 12, 20, 21] and got[1].tolist() == [6, 11, 11, 3, 3]


def test_runs_are_read_as_written(tmp_path):
    keys, values = np.arange(0, 90_000, 3), np.full(30_000, 1 << 33)
    values[:20_000] = 7
    with open(tmp_path / "run", "wb") as out:
        alignment.Runs.write(out, [(2, keys[:25_000], values[:25_000]), (5, keys[25_000:], values[25_000:])])
    run = alignment.Runs(str(tmp_path / "run"))
    for part, here in ((2, slice(0, 25_000)), (5, slice(25_000, None))):
        found = [np.concatenate(c) for c in zip(*run.blocks(part))]
        assert np.array_equal(found[0], keys[here]) and np.array_equal(found[1], values[here])
    assert not list(run.blocks(3))
