"""A bounded, seeded sample of labelled documents, and models fitted on it in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from replylane.llm.linear import Sparse


def one_label(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y): 1 if any row of the document says 1; null ids and labels are left out."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("y"))
    )


def fold(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def choose(labels: DataFrame, per_class: int, seed: int) -> DataFrame:
    """At most ``per_class`` documents of each label, in the order of a seeded hash."""
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    one = [
        labels.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class) for y in (0, 1)
    ]
    return one[0].unionByName(one[1])


def class_counts(labels: DataFrame) -> tuple[int, int]:
    row = labels.agg(
        F.sum((F.col("y") == 0).cast("long")), F.sum((F.col("y") == 1).cast("long"))
    ).first()
    return int(row[0] or 0), int(row[1] or 0)


def features(
    documents: DataFrame, chosen: DataFrame, encode: Callable[[pa.RecordBatch], np.ndarray],
    columns: list[str], sparse: bool = False,
) -> DataFrame:
    """(doc_id, y, vector) of the chosen documents, one row an id, vectors with 16 bits a number.

    Rows that repeat an id are thinned before the shuffle: the least vector stands.
    ``chosen`` is bounded by its limits, so it is broadcast. Sparse vectors are the slots that
    are not zero, with 16 bits each, then their numbers.
    """
    def packed(row: np.ndarray) -> bytes:
        slots = np.flatnonzero(row)
        return slots.astype(np.uint16).tobytes() + row[slots].tobytes()

    def run(batches):
        for batch in batches:
            rows = np.ascontiguousarray(encode(batch), np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"),
                 pa.array([packed(r) if sparse else r.tobytes() for r in rows], pa.binary())],
                ["doc_id", "y", "vector"],
            )

    picked = documents.select("doc_id", *columns).join(F.broadcast(chosen), "doc_id")
    coded = picked.mapInArrow(run, "doc_id long, y int, vector binary")
    return coded.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("vector").alias("vector"))


def matrix(
    found: pa.Table, width: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray | Sparse]:
    """(doc_id, y, float32 rows) in the order of the ids; of repeated ids one row stands.

    With a ``width`` the vectors are sparse ones of so many slots, and stay so.
    """
    ids, y = found.column("doc_id").to_numpy(), found.column("y").to_numpy()
    column = found.column("vector")
    if len(set(ids.tolist())) < len(ids):
        keys = [v.as_py() for v in column]
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], keys[i])))
    else:
        order = np.argsort(ids)
    order = order[np.append(True, ids[order][1:] != ids[order][:-1])]
    if width is not None:
        rows = []
        for k in order.tolist():
            data = np.frombuffer(column[k].as_buffer(), np.uint16)
            rows.append((data[: len(data) // 2], data[len(data) // 2 :].view(np.float16)))
        return ids[order], y[order].astype(np.float64), Sparse.of(rows, width)
    x = np.empty((len(order), len(column[0].as_py()) // 2), np.float32)
    for i, k in enumerate(order.tolist()):
        x[i] = np.frombuffer(column[k].as_buffer(), np.float16)
    return ids[order], y[order].astype(np.float64), x


def fit_in_task(
    rows: DataFrame, fit: Callable[[np.ndarray, np.ndarray, np.ndarray | Sparse], object],
    width: int | None = None,
):
    """What ``fit`` makes of the matrix of a bounded sample, in one task; None without rows."""
    def run(batches):
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if tables:
            sample = matrix(pa.concat_tables(tables), width)
            tables.clear()
            made = pickle.dumps(fit(*sample))
            yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["made"])

    row = rows.repartition(1).mapInArrow(run, "made binary").first()
    return None if row is None else pickle.loads(row["made"])
