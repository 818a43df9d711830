"""Ordered rule labelling and multi-flag detection as column expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

MAX_RULES = 10_000


def _is_one_branch(pattern: str) -> bool:
    """Whether the pattern has no alternation outside its groups."""
    bare, left = None, re.sub(r"\\.|\[[^\]]*\]", "", pattern)
    while bare != left:
        bare, left = left, re.sub(r"\([^()]*\)", "", left)
    return "|" not in left


def _regex(*patterns: str) -> str:
    """One alternation with Unicode classes, where only a newline ends a line.

    A word boundary that starts several patterns is tested once for all of them, which
    settles most positions of a text at once.
    """
    shared = [p for p in patterns if p.startswith(r"\b") and _is_one_branch(p)]
    parts = [f"(?:{p})" for p in patterns if p not in shared]
    if shared:
        parts.append(r"\b(?:" + "|".join(f"(?:{p[2:]})" for p in shared) + ")")
    return "(?Ud)" + "|".join(parts)


def java_regex(pattern: str) -> str:
    """The expression by which one pattern is searched in a lower-cased text."""
    return _regex(pattern)


def _any(lowered: Column, patterns: tuple[str, ...]) -> Column:
    """Whether any pattern is found; one with a back-reference keeps a regex of its own."""
    alone = [p for p in patterns if re.search(r"\\[1-9k]", p)]
    joined = [p for p in patterns if p not in alone]
    tests = [lowered.rlike(_regex(*group)) for group in ([joined] if joined else []) + [[p] for p in alone]]
    found = tests[0]
    for test in tests[1:]:
        found = found | test
    return found


@dataclass(frozen=True)
class RuleSet:
    """Labels in priority order, each with its patterns; the first label hit wins."""

    rules: tuple[tuple[str, tuple[str, ...]], ...]
    default: str

    @classmethod
    def from_table(cls, table: DataFrame, default: str) -> "RuleSet":
        """Read a ``priority, label, pattern`` table, which is metadata of bounded size."""
        rows = table.orderBy("priority", "label", "pattern").limit(MAX_RULES + 1).collect()
        if len(rows) > MAX_RULES:
            raise ValueError(
                f"more than {MAX_RULES} rule patterns in one expression; see operators.rulematch"
            )
        grouped: dict[tuple[int, str], list[str]] = {}
        for row in rows:
            grouped.setdefault((row["priority"], row["label"]), []).append(row["pattern"])
        return cls(tuple((label, tuple(p)) for (_, label), p in grouped.items()), default)

    @property
    def labels(self) -> list[str]:
        return list(dict.fromkeys([label for label, _ in self.rules] + [self.default]))

    def label(self, text: Column) -> Column:
        return self._first_hit(text, lambda i, label: F.lit(label), F.lit(self.default))

    def matched_rule(self, text: Column) -> Column:
        """One-based priority of the rule that decided; null when the default did."""
        return self._first_hit(text, lambda i, label: F.lit(i + 1), F.lit(None).cast("int"))

    def _first_hit(self, text: Column, value, otherwise: Column) -> Column:
        lowered = F.lower(F.coalesce(text, F.lit("")))
        chain = F
        for i, (label, patterns) in enumerate(self.rules):
            chain = chain.when(_any(lowered, patterns), value(i, label))
        return chain.otherwise(otherwise)

    def matches(self, text: Column) -> Column:
        """Every pattern hit, as an array of (priority, label, pattern)."""
        lowered = F.lower(F.coalesce(text, F.lit("")))
        hits = [
            F.when(
                lowered.rlike(_regex(pattern)),
                F.struct(
                    F.lit(i + 1).alias("priority"),
                    F.lit(label).alias("label"),
                    F.lit(pattern).alias("pattern"),
                ),
            )
            for i, (label, patterns) in enumerate(self.rules)
            for pattern in patterns
        ]
        return F.array_compact(F.array(*hits))


def match_table(df: DataFrame, id_col: str, text_col: str, rules: RuleSet) -> DataFrame:
    """Long form of ``RuleSet.matches``: one row per message and pattern hit."""
    hits = df.select(id_col, F.explode(rules.matches(F.col(text_col))).alias("hit"))
    return hits.select(id_col, "hit.*")


def first_match(matches: DataFrame, id_col: str) -> DataFrame:
    """The winning label of each message of a match table."""
    return matches.groupBy(id_col).agg(F.min_by("label", "priority").alias("label"))


@dataclass(frozen=True)
class FlagSet:
    """Named patterns, all tested; hits keep the declared order."""

    flags: tuple[tuple[str, str], ...]

    @classmethod
    def from_table(cls, table: DataFrame) -> "FlagSet":
        rows = table.orderBy("position", "name").limit(MAX_RULES + 1).collect()
        if len(rows) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} flags")
        return cls(tuple((r["name"], r["pattern"]) for r in rows))

    def detect(self, text: Column) -> Column:
        lowered = F.lower(F.coalesce(text, F.lit("")))
        return F.array_compact(
            F.array(*[F.when(lowered.rlike(_regex(p)), F.lit(name)) for name, p in self.flags])
        )
