"""Multinomial logistic regression over sparse vectors, fitted in few passes over the rows.

The penalised loss is strictly convex in the weights, so any descent ends at the same model;
what counts is the number of passes, and what a pass takes. The vectors are written once, in
files that tasks read piece by piece without Spark's reader, and dealt to tasks by their entries.
Each pass is one job: the tasks sum loss and gradient over their rows, the sums meet in slices,
and one sum comes to the driver. So what is shuffled and sent goes by tasks, at most
``TASKS_A_CORE`` for each core, and by the size of the model, not by rows. The driver takes steps by limited
memory BFGS, scaled by the diagonal of the second derivative, which is summed along with the
gradient now and then; without that scale frequent and rare terms need several times the steps.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.ml.linalg import DenseMatrix, DenseVector, Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from replylane.staging import new_path, scope

#: entries worked on at once, numbers of a slice, remembered steps, passes between scales
PIECE, SLICE, MEMORY, RESCALE = 200_000, 8_192, 30, 10
#: entries that a task of a pass has at least, if it is not the only one, and tasks at most
ENTRIES_PER_TASK, TASKS_A_CORE = 250_000, 2
#: steps whose joint gain has to fall below the tolerance
WINDOW = 10


@dataclass(frozen=True)
class Regression:
    """Weights by label and term, and an offset for each label."""

    weights: np.ndarray
    offsets: np.ndarray

    @property
    def coefficientMatrix(self) -> DenseMatrix:  # noqa: N802 - named as in pyspark.ml
        return DenseMatrix(*self.weights.shape, self.weights.ravel(), isTransposed=True)

    @property
    def interceptVector(self) -> DenseVector:  # noqa: N802
        return Vectors.dense(self.offsets)

    def probabilities(self, vector: Column) -> Column:
        """Probabilities by label of a column of sparse vectors; row-local."""
        weights, offsets = self.weights, self.offsets
        pieces, likelihood, _ = _work()

        @F.arrow_udf(ArrayType(DoubleType()))
        def score(indices: pa.Array, values: pa.Array) -> pa.Array:
            lengths = np.diff(indices.offsets.to_numpy())
            at = indices.flatten().to_numpy(zero_copy_only=False)
            value = values.flatten().to_numpy(zero_copy_only=False)
            p = np.empty((len(lengths), len(offsets)))
            for rows, entries in pieces(lengths):
                p[rows] = likelihood(lengths[rows], at[entries], value[entries], weights, offsets)[0]
            ends = np.arange(len(lengths) + 1, dtype="int32") * len(offsets)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(p.ravel()))

        raw = F.unwrap_udt(vector)
        return score(raw["indices"], raw["values"])

    def save(self, spark: SparkSession, path: str) -> None:
        row = {"weights": [self.weights.ravel()], "offsets": [self.offsets]}
        spark.createDataFrame(pa.table(row)).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Regression":
        row = spark.read.parquet(path).first()
        offsets = np.array(row["offsets"])
        return cls(np.array(row["weights"]).reshape(len(offsets), -1), offsets)


def _work():
    """What the tasks do. Functions of a function travel with the job, modules do not."""

    def pieces(lengths: np.ndarray) -> Iterator[tuple[slice, slice]]:
        """(rows, entries) of runs of rows with about ``PIECE`` entries."""
        ends = np.concatenate([[0], np.cumsum(lengths)])
        row = 0
        while row < len(lengths):
            last = max(row + 1, int(np.searchsorted(ends, ends[row] + PIECE, "right")) - 1)
            yield slice(row, last), slice(ends[row], ends[last])
            row = last

    def likelihood(lengths, at, value, weights, offsets) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities by row and label, and their logarithms."""
        filled = np.flatnonzero(lengths)
        starts = (np.cumsum(lengths) - lengths)[filled]
        at = at.astype(np.intp, copy=False)
        scores = np.zeros((len(lengths), len(offsets)))
        for k, own in enumerate(weights if len(filled) else ()):
            scores[filled, k] = np.add.reduceat(own[at] * value, starts)
        scores += offsets
        scores -= scores.max(axis=1, keepdims=True)
        p = np.exp(scores)
        total = p.sum(axis=1, keepdims=True)
        return p / total, scores - np.log(total)

    def numbers(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
        """Row lengths and all numbers of a column of bytes."""
        ends = np.frombuffer(column.buffers()[1], "int32")[column.offset:column.offset + len(column) + 1]
        held = np.frombuffer(column.buffers()[2], "uint8")[ends[0]:ends[-1]] if len(column) else np.empty(0, "uint8")
        numbers = held.view(kind) if held.ctypes.data % 8 == 0 else held.copy().view(kind)
        return np.diff(ends) // numbers.itemsize, numbers

    def summed(batches, weights: np.ndarray, offsets: np.ndarray, scale: bool) -> np.ndarray:
        """Loss, gradient and, if asked for, the diagonal of the second derivative, in one line."""
        labels, size = weights.shape
        loss, parts = 0.0, np.zeros((2 if scale else 1, labels, size + 1))
        for batch in batches:
            lengths, at = numbers(batch["ids"], "int32")
            _, value = numbers(batch["values"], "float64")
            label, weight = batch["label"].to_numpy(), batch["weight"].to_numpy()
            for rows, entries in pieces(lengths):
                n, ids, x = lengths[rows], at[entries].astype(np.intp), value[entries]
                p, logs = likelihood(n, ids, x, weights, offsets)
                w, own = weight[rows, None], (np.arange(len(n)), label[rows])
                loss -= (weight[rows] * logs[own]).sum()
                curved = w * p * (1 - p) if scale else None
                p[own] -= 1
                for out, each, powers in zip(parts, (w * p, curved), (x, x * x if scale else None)):
                    out[:, size] += each.sum(axis=0)
                    for k in range(labels):
                        out[k, :size] += np.bincount(ids, np.repeat(each[:, k], n) * powers, minlength=size)
        return np.concatenate([[loss], parts.ravel()])

    return pieces, likelihood, summed


def packed(rows: DataFrame, features: str, label: str, weight: str) -> DataFrame:
    """(label, weight, ids, values): the entries of each vector as bytes, read without a copy."""

    def as_bytes(lists: pa.Array, kind: str) -> pa.Array:
        numbers = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=kind)
        ends = lists.offsets.to_numpy().astype("int64")
        ends = ((ends - ends[0]) * numbers.itemsize).astype("int32")
        return pa.Array.from_buffers(
            pa.binary(), len(lists), [None, pa.py_buffer(ends), pa.py_buffer(numbers)]
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                batch["label"], batch["weight"], as_bytes(batch["ids"], "int32"), as_bytes(batch["values"], "float64"),
            ], names=["label", "weight", "ids", "values"])

    raw = F.unwrap_udt(features)
    each = rows.select(
        F.col(label).cast("int").alias("label"), F.col(weight).alias("weight"),
        raw["indices"].alias("ids"), raw["values"].alias("values"),
    )
    return each.mapInArrow(pack, "label int, weight double, ids binary, values binary")


@dataclass(frozen=True)
class Blocks:
    """Written vectors: for each task of a pass the batches (path, first, last) it reads."""

    spark: SparkSession
    tasks: list[list[tuple[str, int, int]]]


def written(rows: DataFrame) -> Blocks:
    """``packed`` rows in files of batches of about ``PIECE`` entries, dealt to tasks."""
    folder, (pieces, *_) = new_path(rows.sparkSession, "vectors"), _work()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, counts = TaskContext.get(), []
        path = f"{folder}/{context.partitionId():06d}-{context.taskAttemptId()}.arrow"
        filesystem, place = fs.FileSystem.from_uri(path)
        filesystem.create_dir(place.rpartition("/")[0], recursive=True)
        out = None
        with filesystem.open_output_stream(place) as file:
            for batch in batches:
                out = out or pa.ipc.new_file(file, batch.schema)
                lengths = np.diff(np.frombuffer(batch["ids"].buffers()[1], "int32")[
                    batch["ids"].offset:batch["ids"].offset + batch.num_rows + 1]) // 4
                for rows, entries in pieces(lengths):
                    out.write_batch(batch.slice(rows.start, rows.stop - rows.start))
                    counts.append(int(entries.stop - entries.start) + rows.stop - rows.start)
            if out:
                out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([path]), pa.array([counts], pa.list_(pa.int64()))], names=["path", "counts"]
        )

    found = rows.mapInArrow(write, "path string, counts array<long>").collect()
    each = [(r["path"], i, n) for r in sorted(found, key=lambda r: r["path"]) for i, n in enumerate(r["counts"])]
    total = sum(n for *_, n in each)
    most = TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism
    tasks = [[] for _ in range(max(1, min(most, -(-total // ENTRIES_PER_TASK))))]
    before = 0
    for path, i, n in each:
        own = tasks[before * len(tasks) // total]
        if own and own[-1][0] == path:
            own[-1] = (path, own[-1][1], i + 1)
        else:
            own.append((path, i, i + 1))
        before += n
    return Blocks(rows.sparkSession, [own for own in tasks if own])


def _pass(blocks: Blocks, weights: np.ndarray, offsets: np.ndarray, scale: bool) -> np.ndarray:
    *_, summed = _work()
    if not blocks.tasks:
        return summed([], weights, offsets, scale)
    context = blocks.spark.sparkContext
    sent = context.broadcast((weights, offsets))

    def read(runs: Iterator[list[tuple[str, int, int]]]) -> Iterator[pa.RecordBatch]:
        for path, first, last in (run for own in runs for run in own):
            filesystem, place = fs.FileSystem.from_uri(path)
            with filesystem.open_input_file(place) as file:
                held = pa.ipc.open_file(file)
                for i in range(first, last):
                    yield held.get_batch(i)

    def partial(runs: Iterator[list[tuple[str, int, int]]]) -> Iterator[tuple[int, np.ndarray]]:
        sums = summed(read(runs), *sent.value, scale)
        for i in range(0, len(sums), SLICE):
            yield i, sums[i:i + SLICE]

    try:
        parts = context.parallelize(blocks.tasks, len(blocks.tasks)).mapPartitions(partial)
        found = parts.reduceByKey(operator.add, min(len(blocks.tasks), context.defaultParallelism)).collect()
    finally:
        sent.destroy()
    return np.concatenate([x for _, x in sorted(found, key=lambda part: part[0])])


def fit(
    rows: DataFrame, labels: int, size: int, total: float, penalty: float, max_iter: int, tolerance: float
) -> Regression:
    """Least weighted log loss of ``packed`` rows, over ``total``, and ``penalty`` / 2 * |W|^2.

    Offsets are not penalised. It ends when ``WINDOW`` steps together gain less than
    ``tolerance`` of the loss at the start.
    """
    with scope(rows.sparkSession):
        return _fitted(written(rows), labels, size, total, penalty, max_iter, tolerance)


def _fitted(
    rows: Blocks, labels: int, size: int, total: float, penalty: float, max_iter: int, tolerance: float
) -> Regression:
    def at(x: np.ndarray, scale: bool):
        grid = x.reshape(labels, size + 1)
        sums = _pass(rows, grid[:, :size].copy(), grid[:, size].copy(), scale) / total
        held = grid.copy()
        held[:, size] = 0.0
        cut = 1 + x.size
        diagonal = None
        if scale:
            diagonal = sums[cut:].reshape(grid.shape).copy()
            diagonal[:, :size] += penalty
            diagonal = np.maximum(diagonal, 1e-12).ravel()
        return sums[0] + penalty / 2 * (held * held).sum(), sums[1:cut] + penalty * held.ravel(), diagonal

    x = descend(at, np.zeros(labels * (size + 1)), max_iter, tolerance).reshape(labels, size + 1)
    offsets = x[:, size] - x[:, size].mean()
    return Regression(x[:, :size].copy(), offsets)


def descend(at: Callable, x: np.ndarray, max_iter: int, tolerance: float) -> np.ndarray:
    """Where ``at(x, scale)``, of a value, a gradient and a diagonal, is least."""
    value, slope, scale = at(x, True)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    values = [value]
    for turn in range(max_iter):
        way, taken = slope.copy(), []
        for s, y in reversed(steps):
            taken.append(s @ way / (s @ y))
            way -= taken[-1] * y
        way /= scale
        if steps:
            s, y = steps[-1]
            way *= (s @ y) / (y @ (y / scale))
        for (s, y), a in zip(steps, reversed(taken)):
            way += s * (a - y @ way / (s @ y))
        fall, length = slope @ way, 1.0
        if fall <= 0:
            break
        rescale = turn % RESCALE == RESCALE - 1
        while True:
            after, next_slope, next_scale = at(x - length * way, rescale)
            if after <= value - 1e-4 * length * fall or length < 1e-10:
                break
            length /= 2
        if after > value:
            break
        s, y = -length * way, next_slope - slope
        if s @ y > 0:
            steps = [*steps, (s, y)][-MEMORY:]
        x, value, slope = x + s, after, next_slope
        scale = scale if next_scale is None else next_scale
        values.append(value)
        if len(values) > WINDOW and values[-1 - WINDOW] - value <= tolerance * abs(values[0]):
            break
    return x
