"""Rules in a table, however many: each text is tested against the patterns it can hold.

A pattern can only be found where one of its required literals stands: the longest run of plain
characters that every match contains, or one for each branch of an alternation. The literals of
a block of rules are searched together, in one pass over each text (Aho-Corasick); a text meets
only the rules of those that occur in it, and these regular expressions are then tested by
Spark. Patterns that require no literal of two characters meet every text.

Rules reach the driver in blocks of bounded size, one automaton and one pass each; no number
of rules is refused.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType

from replylane.functions.rules import java_regex
from replylane.operators.shape import join_small
from replylane.staging import stage

#: rules, and characters of their patterns, of one block
BLOCK_RULES, BLOCK_CHARS = 200_000, 16 << 20
SHORTEST = 2


def required_literals(pattern: str) -> frozenset[str]:
    """Literals of which every match of the pattern holds one; empty if there are none.

    Patterns that are not understood, or that set flags, count as having none.
    """
    parser = re._parser
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = parser.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return frozenset()
    if tree.state.flags & ~re.UNICODE:
        return frozenset()
    return _required(tree) or frozenset()


def _required(sequence) -> frozenset[str] | None:
    best: frozenset[str] | None = None
    run: list[str] = []

    def offer(found: frozenset[str] | None) -> None:
        nonlocal best
        if found and min(map(len, found)) >= SHORTEST:
            if best is None or (min(map(len, found)), -len(found)) > (min(map(len, best)), -len(best)):
                best = found

    def flush() -> None:
        offer(frozenset(["".join(run)]) if run else None)
        run.clear()

    for name, value in sequence:
        if name is re._constants.LITERAL:
            run.append(chr(value))
            continue
        flush()
        if name is re._constants.SUBPATTERN:
            _, on, off, inner = value
            if not on and not off:
                offer(_required(inner))
        elif name in (re._constants.MAX_REPEAT, re._constants.MIN_REPEAT, re._constants.POSSESSIVE_REPEAT):
            if value[0] >= 1:
                offer(_required(value[2]))
        elif name is re._constants.ATOMIC_GROUP:
            offer(_required(value))
        elif name is re._constants.BRANCH:
            parts = [_required(branch) for branch in value[1]]
            if all(parts):
                offer(frozenset().union(*parts))
    flush()
    return best


def _blocks(rules: DataFrame) -> Iterator[list]:
    """Rules in order of priority, label and pattern, in blocks; nulls match nothing."""
    rows, size = [], 0
    wanted = rules.where("pattern is not null").select("priority", "label", "pattern")
    for row in wanted.orderBy("priority", "label", "pattern").toLocalIterator():
        rows.append(row)
        size += len(row["pattern"])
        if len(rows) >= BLOCK_RULES or size >= BLOCK_CHARS:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _candidates(shipped) -> Column:
    """The numbers of the rules a text can match, in ascending order."""
    @F.arrow_udf(ArrayType(IntegerType()))
    def candidates(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        by_literal, always = shipped.value
        automaton = ahocorasick.Automaton()
        for literal, numbers in by_literal.items():
            automaton.add_word(literal, numbers)
        if by_literal:
            automaton.make_automaton()
        for texts in batches:
            out = []
            for text in texts.to_pylist():
                found = set(always)
                if by_literal:
                    for _, numbers in automaton.iter(text or ""):
                        found.update(numbers)
                out.append(sorted(found))
            yield pa.array(out, pa.list_(pa.int32()))

    return candidates


def match_rule_table(df: DataFrame, id_col: str, text_col: str, rules: DataFrame) -> DataFrame:
    """(id, priority, label, pattern) of every rule found in a row's lower-cased text.

    A null text is an empty one. Repeated rules, and repeated rows, each give their matches.
    """
    spark = df.sparkSession
    texts = df.select(F.col(id_col), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"))
    found = None
    for rows in _blocks(rules):
        by_literal: dict[str, list[int]] = {}
        always: list[int] = []
        for number, row in enumerate(rows):
            literals = required_literals(row["pattern"])
            for literal in literals:
                by_literal.setdefault(literal, []).append(number)
            if not literals:
                always.append(number)
        shipped = spark.sparkContext.broadcast((by_literal, always))
        table = spark.createDataFrame(pa.table({
            "_rule": pa.array(range(len(rows)), pa.int32()),
            "priority": pa.array([r["priority"] for r in rows], pa.int32()),
            "label": pa.array([r["label"] for r in rows], pa.string()),
            "pattern": pa.array([r["pattern"] for r in rows], pa.string()),
            "_regex": pa.array([java_regex(r["pattern"]) for r in rows], pa.string()),
        }))
        met = texts.withColumn("_rule", F.explode(_candidates(shipped)("_text")))
        tested = join_small(met, stage(table, "rules"), ["_rule"]).where(F.rlike("_text", F.col("_regex")))
        part = tested.select(id_col, "priority", "label", "pattern")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return texts.limit(0).select(
            id_col, F.lit(0).alias("priority"), F.lit("").alias("label"), F.lit("").alias("pattern")
        )
    return found


def label_by_rule_table(
    df: DataFrame, id_col: str, text_col: str, rules: DataFrame, default: str
) -> DataFrame:
    """(id, label, priority): the first rule that is found decides; unique ids."""
    matches = match_rule_table(df, id_col, text_col, rules)
    first = matches.groupBy(id_col).agg(F.min(F.struct("priority", "label")).alias("_first"))
    return df.select(id_col).join(first, id_col, "left").select(
        id_col, F.coalesce("_first.label", F.lit(default)).alias("label"),
        F.col("_first.priority").alias("priority"),
    )
