"""Skew-proof building blocks: keyed dedup, joins to a unique side, exact group quotas."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from replylane.staging import stage

HOT_KEYS = 1_000
SMALL_ROWS = 100_000
SALTS = 64


def keep_first(df: DataFrame, key: str, ordinal: Column) -> DataFrame:
    """One row per key, the one with the lowest ordinal.

    An aggregate and not a window: copies of a hot key collapse before the shuffle.
    """
    others = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*others), ordinal).alias("_first")
    return df.groupBy(key).agg(first).select(key, *[F.col(f"_first.{c}").alias(c) for c in others])


def lowest_rows(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """The row of each key with the lowest ``ordinal``, a number that no two rows of a key share.

    Only keys and numbers are aggregated, by hash; wide columns are fetched once it is known
    which rows stand.
    """
    first = df.where(F.col(ordinal).isNotNull()).groupBy(key).agg(F.min(ordinal).alias(ordinal))
    return df.join(first, [key, ordinal], "left_semi")


def join_unique(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot_rows: int = 1_000_000
) -> DataFrame:
    """Inner join to a side that holds each key once, with any number of hot keys on the left.

    The at most ``HOT_KEYS`` most frequent keys with ``hot_rows`` rows or more meet their
    single partner by broadcast; everything else joins by shuffle. They are looked for first,
    so both sides should be written tables; when no key is hot, each is read once more.
    """
    hot = stage(
        left.where(F.col(left_key).isNotNull())
        .groupBy(F.col(left_key).alias("_hot"))
        .count()
        .where(F.col("count") >= hot_rows)
        .orderBy(F.desc("count"), "_hot")
        .limit(HOT_KEYS)
        .select("_hot"),
        "hot-keys",
    )
    matches = F.col(left_key) == F.col(right_key)
    if hot.isEmpty():
        return left.join(right, matches)
    few = F.broadcast(hot)
    partners = F.broadcast(right.join(few, F.col(right_key) == F.col("_hot"), "left_semi"))
    hot_rows_joined = left.join(few, F.col(left_key) == F.col("_hot"), "left_semi").join(
        partners, matches
    )
    rest = left.join(few, F.col(left_key) == F.col("_hot"), "left_anti").join(right, matches)
    return rest.unionByName(hot_rows_joined)


def join_small(
    left: DataFrame, small: DataFrame, keys: list[str], how: str = "inner"
) -> DataFrame:
    """Join to a staged table that is expected, but not known, to be small.

    Its rows are counted first. Up to ``SMALL_ROWS`` it is broadcast; beyond, the left rows
    are salted and the right rows repeated per salt, so that no key meets in one task.
    """
    if small.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        return left.join(F.broadcast(small), keys, how)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)))
    salts = F.transform(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: i.cast("long"))
    repeated = small.withColumn("_salt", F.explode(salts))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


#: bits of the filter of ``may_hold``, in maps of 32,768
FILTER_MAPS, MAP_BITS = 2_048, 32_768


def may_hold(df: DataFrame, key: str, keys: DataFrame, its_key: str) -> DataFrame:
    """The rows of ``df`` whose key may be among the given ones: a Bloom filter of fixed size.

    Two bits a key, at most ``FILTER_MAPS`` maps of 4 KiB, which are broadcast. No row that an
    inner or semi join would keep is lost; of the others most go while the keys are few beside
    the bits. Rows without a key go.
    """
    def places(column: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(i), column.cast("string")), F.lit(FILTER_MAPS * MAP_BITS)) for i in (1, 2)]

    each = keys.where(F.col(its_key).isNotNull()).select(F.explode(F.array(*places(F.col(its_key)))).alias("at"))
    maps = each.groupBy(F.floor(F.col("at") / MAP_BITS).cast("int").alias("map")).agg(
        F.bitmap_construct_agg((F.col("at") % MAP_BITS).cast("long")).alias("bits")
    )
    maps = stage(maps, "filter-maps")
    kept = df.where(F.col(key).isNotNull())
    for i, at in enumerate(places(F.col(key))):
        number, place = f"_map{i}", F.col(f"_place{i}")
        kept = kept.withColumn(number, F.floor(at / MAP_BITS).cast("int")).withColumn(
            f"_place{i}", (at % MAP_BITS).cast("int")
        ).join(F.broadcast(maps.select(F.col("map").alias(number), F.col("bits").alias("_bits"))), number)
        byte = F.conv(F.hex(F.substring("_bits", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.call_function("shiftright", byte, place.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1))
        kept = kept.where(bit == 1).drop("_bits", number, f"_place{i}")
    return kept.select(*df.columns)


def mark_lowest(
    df: DataFrame, group: str, order_hash: Column, tie: Column,
    quota_of: Callable[[DataFrame], DataFrame], out: str, digits: int = 4,
) -> DataFrame:
    """Flag, in each group, exactly ``quota`` rows: those with the lowest hash.

    ``order_hash`` is a hex digest of a unique id, ``group`` a text column without nulls, and
    ``quota_of`` turns the (group, size) table into (group, quota). Rows are counted by their
    leading hex digits, which tells at which prefix each group's quota runs out: rows below
    it are in, rows above it are out, and only rows on that prefix are ranked. So no task
    ever sorts a whole group, and rows off that prefix are not shuffled.
    """
    hashed = df.withColumn("_hash", order_hash).withColumn(
        "_cell", F.conv(F.substring("_hash", 1, digits), 16, 10).cast("long")
    )
    cells = stage(hashed.groupBy(group, "_cell").agg(F.count(F.lit(1)).alias("_n")), "cells")
    quotas = quota_of(cells.groupBy(group).agg(F.sum("_n").alias("size")))
    running = W.partitionBy(group).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    cuts = (
        cells.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
        .join(quotas.select(group, "quota"), group)
        .where(F.col("_before") < F.col("quota"))
        .groupBy(group)
        .agg(
            F.max("_cell").alias("_last"),
            (F.max("quota") - F.max("_before")).alias("_room"),
        )
    )
    placed = join_small(hashed, stage(cuts, "cuts"), [group], "left")
    on_edge = F.coalesce(F.col("_cell") == F.col("_last"), F.lit(False))
    off = placed.where(~on_edge).withColumn(
        out, F.coalesce(F.col("_cell") < F.col("_last"), F.lit(False))
    )
    rank = F.row_number().over(W.partitionBy(group).orderBy("_hash", tie))
    edge = placed.where(on_edge).withColumn("_rank", rank)
    edge = edge.withColumn(out, F.col("_rank") <= F.col("_room")).drop("_rank")
    return off.unionByName(edge).select(*df.columns, out)


def dense_index(df: DataFrame, keys: list[Column], out: str) -> DataFrame:
    """Zero-based running number in key order, without a single-task window.

    The range-sorted rows are written with their position inside their partition; the
    partition sizes, one row per partition, turn it into a global position.
    """
    position = F.monotonically_increasing_id()
    ordered = stage(df.orderBy(*keys).withColumn("_at", position), "ordered")
    part = F.shiftright("_at", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    running = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_start"))
    offset = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = join_small(ordered.withColumn("_part", part), stage(starts, "starts"), ["_part"])
    return placed.withColumn(out, F.col("_start") + offset).drop("_at", "_part", "_start")


def inline(df: DataFrame, rows: list[tuple], names: list[str]) -> DataFrame:
    """A literal table of parameters (labels, quotas) in the session of ``df``."""
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return df.sparkSession.createDataFrame(
        pa.table({name: list(values) for name, values in zip(names, columns)})
    )
