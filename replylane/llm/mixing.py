"""Mixing sources to target weights by hierarchical budgets, in DataFrame operations alone.

A token budget runs down a tree of domain, language and source. At every node it is shared
among the children in proportion to their weights; a child that cannot use its share, because
its whole subtree holds fewer tokens even when repeated ``max_epochs`` times, leaves the rest
to its siblings, and only what no sibling can use stays with the ancestor. A leaf then takes
its documents in seeded orders, one order an epoch: all of them as often as the budget allows,
and of the next epoch the longest prefix that fits.

No leaf is ever sorted as a whole. Tokens are summed by the leading digits of the order, which
shows the digits on which the prefix ends; only documents on those are ranked.

Tokens are words. Defined results: a null domain, language or source is the empty string; a
null text has no tokens; a leaf without tokens, or of weight 0 at any level, has no budget and
takes no document; texts of any length count whole; equal
order keys go by document id and text digest, so repeated rows are taken one by one; an empty
table gives no rows. Columns of the documents are passed on; ``epoch``,
``n_tokens`` and ``domain`` are added, with underscores before names that are taken.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from replylane.operators.shape import join_small
from replylane.staging import stage

DIGITS = 4
WORD = "[^ \\t\\n\\x0B\\f\\r]+"


@dataclass(frozen=True)
class Target:
    """Relative weights by name at each level, 0 to leave a name out; ``other`` for one not listed."""

    domains: Mapping[str, int] = field(default_factory=dict)
    languages: Mapping[str, int] = field(default_factory=dict)
    sources: Mapping[str, int] = field(default_factory=dict)
    other: int = 1
    #: tokens wanted, in hundredths of all tokens, and how often a document may come
    percent: int = 100
    max_epochs: int = 2
    seed: int = 7

    def weight(self, level: str, name: Column) -> Column:
        out = F.lit(self.other)
        for key, value in sorted(getattr(self, level).items(), reverse=True):
            out = F.when(name == key, F.lit(value)).otherwise(out)
        return out


def domain_of_source() -> Column:
    """The default domain: one of two, told by a digest of the source's name."""
    digest = F.md5(F.coalesce(F.col("source").cast("string"), F.lit("")))
    return F.when(F.substring(digest, 1, 1) < "8", F.lit("d0")).otherwise(F.lit("d1"))


def share_out(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """``budget`` of each child from its parent's ``total``, by ``weight`` up to ``capacity``.

    Sorted by capacity over weight, the children whose capacity is below their share come
    first; the rest divide what these leave. Sums run over the children of one node. A child
    of weight 0 has no budget, and its siblings share what it leaves.
    """
    zero = F.col("weight") <= 0
    children = children.withColumn("_room", F.when(zero, F.lit(0)).otherwise(F.col("capacity")))
    steep = F.when(zero, F.lit(0.0)).otherwise(F.try_divide(F.col("capacity"), F.col("weight")))
    order = W.partitionBy(*parents).orderBy(zero.desc(), steep, name)
    rest = order.rowsBetween(0, W.unboundedFollowing)
    before = F.coalesce(F.sum("_room").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    level = F.try_divide((F.col("total") - before).cast("double"), F.sum("weight").over(rest))
    full = children.withColumn("_full", zero | (F.col("_room") <= level * F.col("weight")))
    whole = W.partitionBy(*parents)
    used = F.coalesce(F.sum(F.when(F.col("_full"), F.col("_room"))).over(whole), F.lit(0))
    open_weight = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(whole)
    share = F.try_divide((F.col("total") - used).cast("double"), open_weight) * F.col("weight")
    budget = F.when(F.col("_full"), F.col("_room")).otherwise(F.floor(share).cast("long"))
    return full.withColumn("budget", budget.cast("long")).drop("_full", "_room", "total")


def budgets(leaves: DataFrame, target: Target) -> DataFrame:
    """``budget`` for each (domain, language, source) with its ``tokens``."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * target.max_epochs)
    languages = leaves.groupBy("domain", "language").agg(F.sum("capacity").alias("capacity"))
    domains = languages.groupBy("domain").agg(F.sum("capacity").alias("capacity"))
    total = leaves.agg(F.floor(F.sum("tokens") * target.percent / 100).cast("long").alias("total"))
    root = F.lit(0).alias("root")
    domains = (
        domains.withColumn("root", root)
        .join(total.withColumn("root", root), "root")
        .withColumn("weight", target.weight("domains", F.col("domain")))
    )
    domains = share_out(domains, ["root"], "domain")
    down = domains.select("domain", F.col("budget").alias("total"))
    languages = languages.join(down, "domain").withColumn(
        "weight", target.weight("languages", F.col("language"))
    )
    languages = share_out(languages, ["domain"], "language")
    down = languages.select("domain", "language", F.col("budget").alias("total"))
    leaves = leaves.join(down, ["domain", "language"]).withColumn(
        "weight", target.weight("sources", F.col("source"))
    )
    return share_out(leaves, ["domain", "language"], "source").select(
        "domain", "language", "source", "tokens", "budget"
    )


def _keyed(documents: DataFrame, target: Target, domain: Column) -> DataFrame:
    """The documents in one struct, with their leaf and tokens."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
        F.coalesce(domain.cast("string"), F.lit("")).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
        F.xxhash64(text).alias("text_key"),
    )


def _order(target: Target, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(target.seed)), epoch.cast("string"), F.col("id")))


def mix(
    documents: DataFrame, target: Target = Target(), domain: Column | None = None
) -> DataFrame:
    """The chosen documents, a row for each epoch in which one is taken."""
    keyed = _keyed(documents, target, domain_of_source() if domain is None else domain)
    leaf = ["domain", "language", "source"]
    sums = stage(keyed.groupBy(*leaf).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    plan = budgets(sums, target).where("tokens > 0").select(
        *leaf,
        F.floor(F.col("budget") / F.col("tokens")).cast("long").alias("full"),
        (F.col("budget") % F.col("tokens")).alias("rest"),
    )
    # Written, so that its size is known when it is joined: it is broadcast only if small.
    plan = stage(plan.where("full > 0 or rest > 0"), "mix-budgets")
    ordered = join_small(keyed, plan, leaf).withColumn("key", _order(target, F.col("full") + 1))
    ordered = ordered.withColumn("digits", F.substring("key", 1, DIGITS))
    by_digits = ordered.groupBy(*leaf, "digits").agg(
        F.sum("tokens").alias("sum"), F.first("rest").alias("rest")
    )
    running = F.sum("sum").over(W.partitionBy(*leaf).orderBy("digits"))
    cut = (
        by_digits.withColumn("after", running)
        .where("after > rest")
        .groupBy(*leaf)
        .agg(F.min_by(F.struct("digits", (F.col("after") - F.col("sum")).alias("before")), "digits").alias("cut"))
        .select(*leaf, "cut.*")
        .withColumnRenamed("digits", "edge")
    )
    plan = stage(plan.join(cut, leaf, "left"), "mix-plan")
    rows = join_small(keyed, plan, leaf).withColumn("key", _order(target, F.col("full") + 1))
    digits = F.substring("key", 1, DIGITS)
    on_edge = F.coalesce(digits == F.col("edge"), F.lit(False))
    inside = F.when(F.col("edge").isNull() | (digits < F.col("edge")), 1).otherwise(0)
    clear = rows.where(~on_edge).withColumn("more", inside)
    rank = W.partitionBy(*leaf).orderBy("key", "id", "text_key").rowsBetween(W.unboundedPreceding, 0)
    edge = rows.where(on_edge).withColumn(
        "more", F.when(F.col("before") + F.sum("tokens").over(rank) <= F.col("rest"), 1).otherwise(0)
    )
    taken = clear.unionByName(edge).withColumn("copies", F.col("full") + F.col("more"))
    taken = taken.where("copies > 0").withColumn(
        "_epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    )
    names = set(documents.columns)
    epoch, tokens = (_free(n, names) for n in ("epoch", "n_tokens"))
    return taken.select(
        *[F.col("row").getField(c).alias(c) for c in documents.columns],
        F.col("_epoch").alias(epoch), F.col("tokens").alias(tokens), F.col("domain").alias(_free("domain", names)),
    )


def _free(name: str, taken: set[str]) -> str:
    while name in taken:
        name = f"_{name}"
    return name
