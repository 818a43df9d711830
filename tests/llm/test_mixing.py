import hashlib
import random

from pyspark.sql import functions as F

from replylane.llm import mixing

TARGET = mixing.Target(domains={"x": 3, "y": 1}, languages={"en": 2}, sources={"s1": 4}, percent=90, max_epochs=2, seed=5)


def share(total, children):
    """Plain water filling: children is {name: (capacity, weight)}."""
    out, open_, left = {}, dict(children), total
    while open_:
        weight = sum(w for _, w in open_.values())
        full = {k: c for k, (c, w) in open_.items() if c <= left / weight * w}
        if not full:
            return out | {k: int(left / weight * w) for k, (_, w) in open_.items()}
        out |= full
        left -= sum(full.values())
        open_ = {k: v for k, v in open_.items() if k not in full}
    return out


def weight(table, name):
    return dict(table).get(name, 1)


def brute_force(rows):
    leaves = {}
    for doc, text, lang, source, domain in rows:
        leaves.setdefault((domain or "", lang or "", source or ""), []).append((doc, len((text or "").split())))
    tokens = {k: sum(n for _, n in v) for k, v in leaves.items()}
    cap = {k: 2 * n for k, n in tokens.items()}
    total = sum(tokens.values()) * 90 // 100
    domains = {k[0] for k in leaves}
    top = share(total, {d: (sum(c for k, c in cap.items() if k[0] == d), weight(TARGET.domains, d)) for d in domains})
    taken = {}
    for d, budget in top.items():
        langs = {k[1] for k in leaves if k[0] == d}
        mid = share(budget, {x: (sum(c for k, c in cap.items() if k[:2] == (d, x)), weight(TARGET.languages, x)) for x in langs})
        for x, rest in mid.items():
            low = share(rest, {k[2]: (cap[k], weight(TARGET.sources, k[2])) for k in leaves if k[:2] == (d, x)})
            for s, own in low.items():
                key = (d, x, s)
                if not tokens[key]:
                    continue
                full, left = divmod(own, tokens[key])
                order = sorted(leaves[key], key=lambda r: hashlib.md5(f"5:{full + 1}:{'' if r[0] is None else r[0]}".encode()).hexdigest())
                for doc, n in order:
                    left -= n
                    taken[doc] = full + (left >= 0)
    return {k: v for k, v in taken.items() if v}


def test_documents_match_a_plain_mix(spark):
    rng = random.Random(6)
    rows = [(i, " ".join("w" * rng.randint(1, 60)), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None]), rng.choice("xxxxy")) for i in range(400)]
    rows += [(1000, None, "en", "s1", "x"), (1001, "", "fr", "only", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, domain string")
    got = mixing.mix(df, TARGET, F.col("domain"))
    assert got.columns == [*df.columns, "epoch", "n_tokens", "_domain"]
    counts = {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert counts == brute_force(rows)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, "a b", "en", "s", 0)] * 6 + [(None, "c d", None, None, 1)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, epoch int")
    got = mixing.mix(df, mixing.Target(percent=50))
    assert "_epoch" in got.columns and 0 < got.count() <= 8
    assert mixing.mix(df.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None, "en", "s", 0)], df.schema)
    assert mixing.mix(blank).count() == 0


def test_weight_zero_leaves_out(spark):
    rows = [(i, "a b c", lang, src) for i, (lang, src) in enumerate([("en", "s1"), ("en", "s2"), ("de", "s1"), ("de", "s3")] * 5)]
    rows.append((99, "word " * 60_000, "en", "s2"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    zero = mixing.Target(sources={"s1": 0}, languages={"fr": 0}, max_epochs=1)
    assert {r.source for r in mixing.mix(df, zero).collect()} == {"s2", "s3"}
    assert {r.lang for r in mixing.mix(df, mixing.Target(languages={"de": 0})).collect()} == {"en"}
    assert mixing.mix(df, mixing.Target(other=0)).count() == 0
    # what is left out is not taken from the others
    assert mixing.mix(df, mixing.Target(languages={"de": 0}, max_epochs=1)).count() == 11
