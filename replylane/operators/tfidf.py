"""TF-IDF: a relational fit, and a row-local transform that needs no shuffle.

The vocabulary is the only thing that ever reaches the driver. It holds at most
``max_features`` terms, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import (
    CountVectorizer, CountVectorizerModel, ElementwiseProduct, Normalizer,
)
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from replylane.functions.text import tokens, with_terms
from replylane.staging import scope, stage

MAX_FEATURES = 20_000
#: tokens that a task numbers at once to count their n-grams
TOKENS_AT_ONCE = 1_000_000


def term_statistics(df: DataFrame, text_col: str, ngrams: tuple[int, int] = (1, 2)) -> DataFrame:
    """Corpus and document frequency of every n-gram, and of the empty term: the row count.

    Tasks number the tokens of ``TOKENS_AT_ONCE`` and count n-grams as pairs of numbers, so a
    term is spelled out and grouped once for each of these stretches of rows it occurs in.
    """
    words = df.select(tokens(F.coalesce(F.col(text_col), F.lit(""))).alias("words"))
    each = words.mapInArrow(_counter(*ngrams), "term string, cf long, df long")
    return each.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def _counter(low: int, high: int):
    at_once = TOKENS_AT_ONCE

    def counted(ids: np.ndarray, row: np.ndarray, size: int, names: pa.Array) -> pa.RecordBatch:
        cf = np.bincount(ids, minlength=size)
        places = np.sort(ids * (int(row[-1]) + 1 if len(row) else 1) + row)
        first = np.ones(len(places), bool)
        first[1:] = places[1:] != places[:-1]
        df = np.bincount(places[first] // (int(row[-1]) + 1 if len(row) else 1), minlength=size)
        return pa.RecordBatch.from_arrays(
            [names, pa.array(cf.astype("int64")), pa.array(df.astype("int64"))], names=["term", "cf", "df"]
        )

    def count(lists: pa.Array) -> Iterator[pa.RecordBatch]:
        """The counts of some rows: of the empty term, then of the n-grams of each length."""
        n = pa.array([len(lists)], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([""]), n, n], names=["term", "cf", "df"])
        words = lists.flatten().dictionary_encode()
        code = words.indices.to_numpy(zero_copy_only=False).astype("int64")
        row = np.repeat(np.arange(len(lists), dtype="int64"), np.diff(lists.offsets.to_numpy()))
        ids, names = code, words.dictionary
        for length in range(1, high + 1):
            if length > 1:
                behind = length - 1
                inside = row[:max(0, len(row) - behind)] == row[behind:]
                # ids holds the shorter n-grams by their place, -1 where a row has none left
                pairs = (ids[:len(inside)] * len(words.dictionary) + code[behind:])[inside]
                found, numbers = np.unique(pairs, return_inverse=True)
                names = pc.binary_join_element_wise(
                    names.take(pa.array(found // max(1, len(words.dictionary)))),
                    words.dictionary.take(pa.array(found % max(1, len(words.dictionary)))), " ",
                )
                ids = np.full(len(inside), -1, "int64")
                ids[inside] = numbers
            if length >= low and len(names):
                here = ids >= 0
                yield counted(ids[here], row[:len(ids)][here], len(names), names)

    def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["words"]
            ends = lists.offsets.to_numpy().astype("int64") - lists.offsets[0].as_py()
            start = 0
            while start < len(lists):
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + at_once, "right")) - 1)
                yield from count(lists.slice(start, stop - start))
                start = stop

    return count_batches


def vocabulary(
    df: DataFrame, text_col: str, max_features: int = MAX_FEATURES, min_df: int = 1,
    ngrams: tuple[int, int] = (1, 2),
) -> DataFrame:
    """The ``max_features`` most frequent terms with their idf; ties go to the lower term."""
    stats = stage(term_statistics(df, text_col, ngrams), "term-statistics")
    is_total = F.col("term") == ""
    rows = stats.where(is_total).select("cf").scalar()
    kept = stats.where(~is_total & (F.col("df") >= min_df))
    top = most_frequent(kept, "cf", "term", max_features)
    idf = F.log((F.lit(1.0) + rows) / (F.lit(1.0) + F.col("df"))) + 1.0
    return top.withColumn("idf", idf)


def _cut(rows: DataFrame, key: Column, wanted: int, ascending: bool = False) -> tuple[object, int]:
    """The key with which the running number of rows, in order, reaches ``wanted``.

    With it, the rows before it. Each key has a row at least, so no more than ``wanted`` keys
    are ever looked at.
    """
    order = F.asc("key") if ascending else F.desc("key")
    counts = rows.groupBy(key.alias("key")).agg(F.count("*").alias("rows")).orderBy(order).limit(wanted)
    before = 0
    for row in counts.toLocalIterator():
        if before + row["rows"] >= wanted:
            return row["key"], before
        before += row["rows"]
    return None, before


def most_frequent(df: DataFrame, count: str, tie: str, n: int) -> DataFrame:
    """The ``n`` rows of the highest counts; equal counts go by the lower text ``tie``.

    A histogram of the counts, with steps of an eighth of a power of two, tells which steps are
    taken whole; a second one, of the exact counts of the step on the edge, the counts; and
    more, of longer and longer beginnings of ``tie``, the rows of the count on the edge. Only
    rows that agree in all that are sorted.
    """
    step_of = F.floor(F.log2(F.col(count)) * 8)
    step, before = _cut(df, step_of, n)
    if step is None:
        return df
    n -= before
    level, before = _cut(df.where(step_of == step), F.col(count), n)
    n -= before
    taken = df.where(F.col(count) > level)
    edge = df.where(F.col(count) == level)
    for length in (2, 4, 8, 16):
        start = F.substring(tie, 1, length)
        last, before = _cut(edge, start, n, ascending=True)
        n -= before
        taken = taken.unionByName(edge.where(start < last))
        edge = edge.where(start == last)
    return taken.unionByName(edge.orderBy(tie).limit(n))


def _vectors(size: int, idf: np.ndarray):
    """Counts to damped, idf-weighted, unit-length vectors, one Arrow batch at a time."""

    @F.arrow_udf(VectorUDT())
    def build(indices: pa.Array, counts: pa.Array) -> pa.Array:
        at = indices.flatten().to_numpy(zero_copy_only=False)
        values = (1.0 + np.log(counts.flatten().to_numpy(zero_copy_only=False))) * idf[at]
        lengths = np.diff(indices.offsets.to_numpy())
        row = np.repeat(np.arange(len(lengths)), lengths)
        norms = np.sqrt(np.bincount(row, values * values, minlength=len(lengths)))
        values = values / norms[row]
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype("int32"))
        n = len(lengths)
        return pa.StructArray.from_arrays(
            [
                pa.array(np.zeros(n, "int8")),
                pa.array(np.full(n, size, "int32")),
                pa.ListArray.from_arrays(offsets, pa.array(at.astype("int32"))),
                pa.ListArray.from_arrays(offsets, pa.array(values)),
            ],
            names=["type", "size", "indices", "values"],
        )

    return build


@dataclass(frozen=True)
class TfidfModel:
    """A term counter with the idf of each of its terms.

    ``sublinear`` damps a count c to 1 + ln(c).
    """

    counter: CountVectorizerModel
    idf: tuple[float, ...]
    sublinear: bool
    ngrams: tuple[int, int] = (1, 2)

    @classmethod
    def fit(
        cls, df: DataFrame, text_col: str, max_features: int = MAX_FEATURES, min_df: int = 1,
        sublinear: bool = False, ngrams: tuple[int, int] = (1, 2),
    ) -> "TfidfModel":
        with scope(df.sparkSession):
            rows = vocabulary(df, text_col, max_features, min_df, ngrams).collect()
        if not rows:
            raise ValueError("no term is frequent enough to enter the vocabulary")
        idf = {r["term"]: r["idf"] for r in rows}
        # Fitted on the chosen terms, one per row, the counter holds exactly these.
        chosen = df.sparkSession.createDataFrame(pa.table({"term": list(idf)}))
        counter = CountVectorizer(
            inputCol="_terms", outputCol="_counts", vocabSize=len(idf), minDF=1.0
        ).fit(chosen.select(F.array("term").alias("_terms")))
        return cls(counter, tuple(idf[t] for t in counter.vocabulary), sublinear, ngrams)

    @property
    def terms(self) -> list[str]:
        return self.counter.vocabulary

    def with_vector(self, df: DataFrame, text_col: str, out: str = "features") -> DataFrame:
        """Add the unit-length sparse vector of each row's text; needs no shuffle."""
        counted = self.counter.transform(with_terms(df, text_col, "_terms", self.ngrams))
        if self.sublinear:
            build = _vectors(len(self.idf), np.array(self.idf))
            raw = F.unwrap_udt("_counts")
            vectors = counted.withColumn(out, build(raw["indices"], raw["values"]))
        else:
            weigh = ElementwiseProduct(
                scalingVec=Vectors.dense(self.idf), inputCol="_counts", outputCol="_weighted"
            )
            unit = Normalizer(p=2.0, inputCol="_weighted", outputCol=out)
            vectors = unit.transform(weigh.transform(counted)).drop("_weighted")
        return vectors.drop("_terms", "_counts")

    def with_arrays(self, df: DataFrame, text_col: str) -> DataFrame:
        """Add the same vector as ``term_ids`` and ``weights`` arrays, by ascending id."""
        raw = F.unwrap_udt("_vector")
        return (
            self.with_vector(df, text_col, "_vector")
            .withColumns({"term_ids": raw["indices"], "weights": raw["values"]})
            .drop("_vector")
        )

    def table(self, spark: SparkSession) -> DataFrame:
        """The vocabulary as rows of (term_id, term, idf)."""
        return spark.createDataFrame(
            pa.table({
                "term_id": pa.array(range(len(self.idf)), pa.int32()),
                "term": pa.array(self.terms, pa.string()),
                "idf": pa.array(self.idf, pa.float64()),
            })
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.counter.write().overwrite().save(f"{path}/counter")
        row = {"idf": [list(self.idf)], "sublinear": [self.sublinear], "ngrams": [list(self.ngrams)]}
        spark.createDataFrame(pa.table(row)).write.mode("overwrite").parquet(f"{path}/weights")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TfidfModel":
        row = spark.read.parquet(f"{path}/weights").first()
        counter = CountVectorizerModel.load(f"{path}/counter")
        return cls(counter, tuple(row["idf"]), row["sublinear"], tuple(row["ngrams"]))


def term_weights(model: TfidfModel, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document and term with its weight.

    The vocabulary is broadcast; it has at most ``max_features`` rows.
    """
    arrays = model.with_arrays(df.select(id_col, text_col), text_col)
    pairs = F.arrays_zip("term_ids", "weights")
    each = arrays.select(id_col, F.explode(pairs).alias("_p"))
    each = each.select(id_col, F.col("_p.term_ids").alias("term_id"), F.col("_p.weights").alias("weight"))
    names = F.broadcast(model.table(df.sparkSession).select("term_id", "term"))
    return each.join(names, "term_id").select(id_col, "term", "weight")
