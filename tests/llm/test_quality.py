import random
import re

import numpy as np

from replylane.llm import quality, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(n, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdef") for _ in range(4)) for _ in range(rng.randint(25, 80))]
        good = rng.random() < 0.7
        if not good:
            words = [w + rng.choice(["###", "$$$", "%%%"]) for w in words]
        rows.append((i, " ".join(words), "en", "a" if good else rng.choice("ab"), len(words)))
        labels.append((i, int(good)))
    return rows, labels


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_co_training_keeps_good_documents(spark):
    rows, labels = documents(300)
    extra = [(1000, None, None, None, None), (1001, "", "", "", 0), (1002, rows[0][1], "en", "a", 5), (None, "x", None, "a", 1)]
    docs = spark.createDataFrame(rows + extra, SCHEMA)
    model = quality.train(docs, spark.createDataFrame(labels[:150], "doc_id long, quality int"))
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    truth = dict(labels)
    right = [got[i].kept == bool(truth[i]) for i in range(150, 300)]
    assert sum(right) >= 145 and len(got) == len(rows) + len(extra)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in quality.score(docs, model).collect())


def test_views_teach_each_other_from_all_unlabelled_documents(spark):
    from pyspark.sql import functions as F

    order = spark.range(1400).orderBy(F.xxhash64(F.lit(quality.SEED + 1), "id"), "id").collect()
    ids = [r.id for r in order]
    rng = random.Random(6)

    def text(letters):
        return " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(30))

    # words of the unlabelled documents, last in the hash, occur in no labelled one; sources do
    rows = [(i, text("abc" if i % 2 else "def"), "en", "ab"[i % 2], 150) for i in ids[:1200]]
    rows += [(i, text("uvw" if i % 2 else "xyz"), "en", "ab"[i % 2], 150) for i in ids[1200:]]
    labels = spark.createDataFrame([(i, i % 2) for i in ids[:1200]], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.doc_id: r.p_text for r in quality.score(docs, quality.train(docs, labels)).collect()}
    assert all((got[i] >= 0.5) == bool(i % 2) for i in ids[1200:])


def test_the_surest_are_those_of_a_full_sort(spark):
    rows, labels = documents(400)
    docs = spark.createDataFrame(rows + rows[300:350] * 3 + [(None, "x", None, "a", 1)], SCHEMA).repartition(6)
    known = spark.createDataFrame(labels[:150], "doc_id long, y int")
    model = quality.train(docs, known.withColumnRenamed("y", "quality"))
    taken = [{160: 1, 170: 0}, {i: 1 for i in range(200, 230)}]
    scores = {r.doc_id: (r.p_text, r.p_meta) for r in quality.score(docs, model).collect() if r.doc_id is not None}
    hashed = dict(zip(range(400), quality.mix(np.arange(400).astype(np.uint64)).tolist()))
    want = [{}, {}]
    for giver in (0, 1):
        for label in (1, 0):
            sure = {i: p[giver] if label else 1 - p[giver] for i, p in scores.items()}
            free = [i for i in sure if i >= 150 and i not in taken[1 - giver] and sure[i] >= quality.SURE]
            free.sort(key=lambda i: (-sure[i], hashed[i], i))
            want[1 - giver] |= {i: label for i in free[:20]}
    assert want[1] and quality._surest(docs, known, model, taken, 20) == want


def test_sparse_rows_fit_as_dense_ones():
    from replylane.llm import linear

    rng = np.random.default_rng(4)
    x = (rng.random((90, 40)) * (rng.random((90, 40)) < 0.2)).astype(np.float16)
    x[7] = 0
    y = (x[:, 0] + x[:, 1] > 0.1).astype(float)
    sparse = linear.Sparse.of([(np.flatnonzero(r), r[np.flatnonzero(r)]) for r in x], 40)
    sparse.BLOCK = 50
    a, b = linear.fit(x.astype(np.float32), y), linear.fit(sparse, y)
    assert np.allclose(a.weights, b.weights, atol=1e-3) and np.allclose(a.raw(x.astype(np.float32)), b.raw(sparse), atol=1e-2)


def test_without_labels_all_stay(spark):
    docs = spark.createDataFrame(documents(5)[0], SCHEMA)
    for labels in ([], [(1, 1)], [(None, 0), (2, None)]):
        known = spark.createDataFrame(labels, "doc_id long, quality int")
        assert quality.keep_good(docs, quality.train(docs, known)).count() == 5
        rules = quality_rules.apply_rules(docs, quality_rules.train(docs, known)).collect()
        assert all(r.kept != r.base_failed for r in rules)
    assert quality.keep_good(docs.limit(0), quality.train(docs.limit(0), known)).count() == 0


def naive(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)]


def test_rule_counts_match_a_plain_count(spark):
    rng = random.Random(3)
    parts = ["a b c d e f g h", "x", "é# *", "\n", "\n", " ", "a b c d e f g h i\n", "|<>", "\t\x0b", "a b c d e f g h"]
    texts = ["", None, "\n\n", " "] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(200)]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    model = quality_rules.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    for r in quality_rules.apply_rules(docs, model).collect():
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == naive(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def test_rules_learn_and_are_calibrated(spark):
    rows, labels = documents(400, 5)
    docs = spark.createDataFrame(rows, SCHEMA)
    model = quality_rules.train(docs, spark.createDataFrame(labels[:200], "doc_id long, quality int"))
    got = {r.doc_id: r.p_quality for r in quality_rules.apply_rules(docs, model).collect()}
    p, truth = np.array([got[i] for i in range(200, 400)]), np.array([dict(labels)[i] for i in range(200, 400)])
    assert ((p >= 0.5) == truth).mean() > 0.95 and abs(p.mean() - truth.mean()) < 0.1
