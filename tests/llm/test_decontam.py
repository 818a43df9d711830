import random

import numpy as np
import pyarrow as pa

from replylane.llm import decontam


def distance(item, text):
    """Least edits of the item inside the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_matches_are_those_of_the_plain_table():
    rng = random.Random(7)
    draw = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    items = [draw(rng.randint(20, 90)) for _ in range(12)] + ["short", "", None, draw(9)]
    texts = [None, "", "short"]
    for _ in range(60):
        item, text = rng.choice(items[:12] + items[15:]), draw(rng.randint(0, 200))
        item = list(item)
        for _ in range(rng.randint(0, 1 + len(item) // 8)):
            k = rng.randrange(len(item))
            item[k:k + 1] = rng.choice([[], [rng.choice("abcdefgh")], [item[k], "x"]])
        at = rng.randint(0, len(text))
        texts.append(text[:at] + "".join(item).upper() + text[at:])
    built = decontam.Items.build(list(range(len(items))), pa.array(items))
    got = {}
    for t, i, _, _, d in decontam.matches(built, pa.array(texts)):
        got[t, i] = min(d, got.get((t, i), d))
    want = {}
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            if item and len(item) >= decontam.Q:
                k = min(int(len(item) * decontam.RATE), (len(item) - decontam.Q) // decontam.Q)
                d = distance(item, (text or "").lower())
                if d <= k:
                    want[t, i] = d
    assert {k: d for k, d in got.items() if len(items[k[1]]) >= decontam.Q} == want and any(want.values())
    assert {k for k in got if items[k[1]] == "short"} == {(2, 12)}


def test_every_occurrence_counts():
    item = "the quick brown fox jumps over it"
    near = item.replace("brown", "brwn")
    text = f"{item} {near}. {item}"
    built = decontam.Items.build([1, 2, 3], pa.array([item, "fox", "o"]))
    found = decontam.matches(built, pa.array([text, "a foxy box, FOX: o", None]))
    assert [m[2:] for m in found if m[:2] == (0, 1)] == [
        (0, len(item), 0), (len(item) + 1, len(item) + 1 + len(near), 1),
        (len(text) - len(item), len(text), 0)]
    assert [m[2:] for m in found if m[1] == 2] == [(i, i + 3, 0) for i in range(len(text)) if text.startswith("fox", i)] + [(12, 15, 0)]
    assert [m for m in found if m[1] == 3] == [(1, 3, 17, 18, 0)]


def test_short_items_at_cuts_of_long_texts(monkeypatch):
    monkeypatch.setattr(decontam, "_PIECE", 64)
    built = decontam.Items.build([1], pa.array(["ab"]))
    text = "xab ab " * 100
    assert [m[2] for m in decontam.matches(built, pa.array([text]))] == [7 * i + 4 for i in range(100)]


def test_spans_hold_the_item_in_long_texts(monkeypatch):
    monkeypatch.setattr(decontam, "_PIECE", 500)
    item = "the quick brown fox jumps over the lazy dog again"
    text = "z " * 1000 + item + " y" * 700
    built = decontam.Items.build([4], pa.array([item]))
    assert decontam.matches(built, pa.array([text])) == [(0, 4, 2000, 2000 + len(item), 0)]
    assert len(decontam.matches(built, pa.array(["x" + item] * 30))) == 30


def test_rows_in_spark(spark):
    item = "an item of the benchmark that is long enough"
    docs = spark.createDataFrame([(1, f"so {item} it is", 5), (None, f"{item}", 6), (2, "clean", 7), (3, None, 8), (1, "clean too", 9)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(10, item), (None, None), (11, item)], "item_id long, text string")
    found = decontam.find_items(docs, bench).collect()
    assert sorted((str(r.doc_id), r.item_id, r.distance) for r in found) == [("1", 10, 0), ("1", 11, 0), ("None", 10, 0), ("None", 11, 0)]
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r.item_id for r in kept.collect()) == [7, 8, 9]
    assert decontam.find_items(docs, bench.limit(0)).count() == 0 and decontam.decontaminate(docs, bench.limit(0)).count() == 5
    assert decontam.find_items(docs.limit(0), bench).count() == 0
    assert np.array_equal(decontam._FOLD[[65, 10]], [97, 32])
