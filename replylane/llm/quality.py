"""Quality by co-training a text view and a page-metadata view.

Both views start from the same labelled documents. In every round each view scores all
unlabelled documents in Spark and labels the ``PER_ROUND`` it is surest of on either side, and
the other view learns from them. At the end each view is calibrated on labelled documents
neither saw, and the two calibrated log odds are added, the prior taken out once. All documents
are scored over their whole texts.

The labelled sample has at most ``PER_CLASS`` documents of each class, chosen by a seeded hash.
Only it and the documents passed on reach the task that fits.

Defined results: documents without an id are scored but not passed on; a null text is empty and a null source, language or length has a value of its
own; repeated rows give repeated results; other columns are ignored or, by ``keep_good``,
passed on; without labels of both classes every document is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType

from replylane.llm import labelled, linear
from replylane.llm.linear import Logistic, logit, sigmoid
from replylane.llm.words import chunks, mix

PER_CLASS = 1_000
ROUNDS = 4
#: how sure a view must be, and how many documents of each label it passes on in a round
SURE = 0.95
PER_ROUND = 100
KEEP_AT = 0.5
SEED = 3
COLUMNS = ["text", "source", "lang", "n_chars"]
#: tasks that thin out the surest documents of all others
TOP_TASKS = 8
_TOPS = pa.schema([("kind", pa.int64()), ("doc_id", pa.int64()), ("sure", pa.float64())])

_SOURCES, _LANGUAGES, _LENGTHS = 256, 32, 32
META_WIDTH = _SOURCES + _LANGUAGES + _LENGTHS


def _buckets(column: pa.Array, size: int) -> np.ndarray:
    """A hashed slot per value; null has slot 0, which no value shares."""
    out = np.zeros(len(column), np.int64)
    for first, last, texts in chunks(column):
        # the whole value, blanks included, is one word here
        data = np.where(texts.data <= 0x20, texts.data + np.uint8(0x80), texts.data)
        whole = type(texts)(data, texts.offsets)
        hashes = np.zeros(texts.count, np.uint64)
        hashes[whole.text_of] = whole.word_hashes()
        out[first:last] = 1 + (hashes % np.uint64(size - 1)).astype(np.int64)
    out[column.is_null().to_numpy(zero_copy_only=False)] = 0
    return out


def metadata(batch: pa.RecordBatch) -> np.ndarray:
    """(n, 3) slots of source, language and length class."""
    length = pc.fill_null(batch.column("n_chars").cast(pa.int64()), -1).to_numpy(zero_copy_only=False)
    steps = np.where(length < 0, 0, 1 + np.log2(np.maximum(length, 0) + 1.0).astype(np.int64))
    return np.stack([
        _buckets(batch.column("source").cast(pa.string()), _SOURCES),
        _SOURCES + _buckets(batch.column("lang").cast(pa.string()), _LANGUAGES),
        _SOURCES + _LANGUAGES + np.minimum(steps, _LENGTHS - 1),
    ], 1)


def features(batch: pa.RecordBatch) -> np.ndarray:
    """Text vector, then metadata vector."""
    out = np.zeros((batch.num_rows, linear.WIDTH + META_WIDTH), np.float32)
    out[:, : linear.WIDTH] = linear.vectors(batch.column("text"))
    np.put_along_axis(out[:, linear.WIDTH :], metadata(batch), 1.0, 1)
    return out


@dataclass
class CoTrained:
    text: Logistic
    meta: Logistic
    prior: float

    def views(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of each view, and of both together."""
        a = self.text.calibrated(self.text.raw_texts(batch.column("text")))
        b = self.meta.calibrated(self.meta.weights[metadata(batch)].sum(1) + self.meta.bias)
        return a, b, sigmoid(logit(a) + logit(b) - logit(self.prior))


#: (view that gives, label), in the order of ``_surest``'s kinds; the other view takes
_GIVES = [(0, 1), (0, 0), (1, 1), (1, 0)]


def _top(ids: np.ndarray, sure: np.ndarray, each: int) -> np.ndarray:
    """Where the surest are, ties in a hashed order of the ids."""
    return np.lexsort((ids, mix(ids.astype(np.uint64)), -sure))[:each]


def _surest(
    documents: DataFrame, known: DataFrame, model: CoTrained, taken: list[dict[int, int]],
    each: int = PER_ROUND,
) -> list[dict[int, int]]:
    """Labels that each view takes from the other, by document: of all documents that are not
    ``known`` nor ``taken`` by the view before, those the other view is surest of.

    Scores, not texts, are shuffled, and only those of which a view is sure.
    """
    old = [np.array(sorted(t), np.int64) for t in taken]

    def scores(batches):
        for batch in batches:
            a, b, _ = model.views(batch)
            some = (np.abs(a - 0.5) >= SURE - 0.5) | (np.abs(b - 0.5) >= SURE - 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(a), pa.array(b)], ["doc_id", "a", "b"]
            ).filter(pa.array(some))

    def top(batches):
        best = [(np.zeros(0, np.int64), np.zeros(0))] * len(_GIVES)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for kind, (giver, label) in enumerate(_GIVES):
                sure = batch.column(f"s{kind}").to_numpy()
                new = np.flatnonzero((sure >= SURE) & ~np.isin(ids, old[1 - giver]))
                own = np.append(best[kind][0], ids[new])
                sure = np.append(best[kind][1], sure[new])
                chosen = _top(own, sure, each)
                best[kind] = own[chosen], sure[chosen]
        kinds = np.repeat(np.arange(len(_GIVES)), [len(ids) for ids, _ in best])
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds), *[pa.array(np.concatenate(x)) for x in zip(*best)]],
            ["kind", "doc_id", "sure"],
        )

    scored = documents.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), *COLUMNS
    ).mapInArrow(scores, "doc_id long, a double, b double")
    # one row per id before the join: a copied id meets its label once
    scored = scored.groupBy("doc_id").agg(*[
        (F.max(view) if label else 1 - F.min(view)).alias(f"s{kind}")
        for kind, (view, label) in enumerate(("ab"[giver], label) for giver, label in _GIVES)
    ])
    def top_of_tops(batches):
        table = pa.Table.from_batches(list(batches), schema=_TOPS)
        kinds, ids, sure = (table.column(c).to_numpy() for c in _TOPS.names)
        chosen = [own[_top(ids[own], sure[own], each)] for own in (np.flatnonzero(kinds == k) for k in range(len(_GIVES)))]
        yield from table.take(pa.array(np.concatenate(chosen))).to_batches()

    # a few rows of each task, thinned out once more before they reach the driver
    schema = "kind long, doc_id long, sure double"
    tops = scored.join(known.select("doc_id"), "doc_id", "left_anti").mapInArrow(top, schema)
    found = tops.repartition(TOP_TASKS).mapInArrow(top_of_tops, schema).toArrow()
    kinds, ids, sure = (found.column(c).to_numpy() for c in ("kind", "doc_id", "sure"))
    out: list[dict[int, int]] = [{}, {}]
    for kind, (giver, label) in enumerate(_GIVES):
        own = np.flatnonzero(kinds == kind)
        for i in ids[own[_top(ids[own], sure[own], each)]].tolist():
            out[1 - giver][i] = label
    return out


def _keep_all() -> CoTrained:
    return CoTrained(
        Logistic(np.zeros(linear.WIDTH), 20.0), Logistic(np.zeros(META_WIDTH), 0.0), 0.5
    )


def train(
    documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, rounds: int = ROUNDS,
    seed: int = SEED,
) -> CoTrained:
    known = labelled.one_label(labels, "quality")
    low, high = labelled.class_counts(known)
    if not low or not high:
        return _keep_all()
    sample = {r["doc_id"]: r["y"] for r in labelled.choose(known, per_class, seed).collect()}
    taken: list[dict[int, int]] = [{}, {}]
    for turn in range(rounds + 1):
        model = _fit(documents, sample, taken, low, high)
        if model is None:
            return _keep_all()
        new = _surest(documents, known, model, taken) if turn < rounds else [{}, {}]
        if not any(new):
            return model
        taken = [a | b for a, b in zip(taken, new)]


def _fit(
    documents: DataFrame, sample: dict[int, int], taken: list[dict[int, int]], low: int, high: int,
) -> CoTrained | None:
    """Both views fitted on the labelled sample and on what each has taken, in one task."""
    others = sorted((taken[0].keys() | taken[1].keys()) - sample.keys())
    chosen = documents.sparkSession.createDataFrame(
        [*sample.items(), *[(i, -1) for i in others]], "doc_id long, y int"
    )
    rows = labelled.features(documents, chosen, features, COLUMNS, sparse=True)
    return labelled.fit_in_task(
        rows, lambda ids, y, x: _fitted(ids, y, x, taken, low, high), linear.WIDTH + META_WIDTH
    )


def _fitted(
    ids: np.ndarray, y: np.ndarray, x: linear.Sparse, taken: list[dict[int, int]], low: int, high: int,
) -> CoTrained | None:
    """The model of a sample out of ``low`` and ``high`` documents of either label.

    ``y`` is -1 for the documents that have a label only from the other view.
    """
    has = y >= 0
    if set(y[has]) != {0.0, 1.0}:
        return None
    held = has & (mix(ids.astype(np.uint64)) % np.uint64(4) == 0)
    if set(y[held]) != {0.0, 1.0} or set(y[has & ~held]) != {0.0, 1.0}:
        # too few to set any apart but one of each label
        held = np.zeros(len(y), bool)
        held[[np.flatnonzero(y == k)[0] for k in (0, 1)]] = True
        if set(y[has & ~held]) != {0.0, 1.0}:
            return None
    # how many documents a held one stands for
    share = np.where(y > 0, high / (y > 0).sum(), low / (y == 0).sum())[held]
    share /= share.mean()
    models = []
    for view, own in zip(_views(x), taken):
        given = np.array([-1 if k else own.get(i, -1) for i, k in zip(ids.tolist(), has)], np.float64)
        labels = np.where(has, y, given)
        rows = np.flatnonzero((labels >= 0) & ~held)
        model = linear.fit(view[rows], labels[rows])
        raw = model.raw(view[np.flatnonzero(held)])
        model.slope, model.offset = linear.platt(raw, y[held], share)
        models.append(model)
    return CoTrained(*models, float((share * y[held]).sum() / share.sum()))


def _views(x: linear.Sparse) -> tuple[linear.Sparse, linear.Sparse]:
    """The text part and the metadata part of ``features``."""
    of_text = x.slots < linear.WIDTH
    cuts = np.append(0, np.cumsum(of_text))[x.cuts]
    return (
        linear.Sparse(x.slots[of_text], x.values[of_text], cuts, linear.WIDTH),
        linear.Sparse(
            x.slots[~of_text] - np.uint16(linear.WIDTH), x.values[~of_text], x.cuts - cuts, META_WIDTH
        ),
    )


def score(documents: DataFrame, model: CoTrained, keep_at: float = KEEP_AT) -> DataFrame:
    """doc_id, p_text, p_meta, score and kept, one row per document."""
    def run(batches):
        for batch in batches:
            a, b, both = model.views(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(a), pa.array(b), pa.array(both),
                 pa.array(both >= keep_at)],
                ["doc_id", "p_text", "p_meta", "score", "kept"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), *COLUMNS).mapInArrow(
        run, "doc_id long, p_text double, p_meta double, score double, kept boolean"
    )


def keep_good(documents: DataFrame, model: CoTrained, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows the model keeps, with all their columns.

    Only what the model reads goes to Python, and one bit a row comes back.
    """
    @F.arrow_udf(BooleanType())
    def is_good(text: pa.Array, source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text, source, lang, n_chars], COLUMNS)
        return pa.array(model.views(batch)[2] >= keep_at)

    return documents.where(is_good(*[F.col(c) for c in COLUMNS]))
