"""Rules kept as rows of a table, checked against any table in one pass.

A rule has a name, a kind, the columns it is about, and what its kind needs:

* ``range``: every column lies between ``low`` and ``high``, either of which may be NULL (open)
* ``pattern``: ``pattern`` is found in every column
* ``not_null``: no column is NULL
* ``named_period``: the first column, a day, lies in the period in the name of the second, a file; names without a period allow any day

A NULL breaks every rule about its column.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclear.schema import quoted
from gridclear.sources.landing import file_name_lineage

RULES = "rule string, kind string, columns array<string>, low string, high string, pattern string"
MOST_RULES = 1000


class Rule(NamedTuple):
    rule: str
    kind: str
    columns: tuple[str, ...]
    low: str | None = None
    high: str | None = None
    pattern: str | None = None


class InvalidRules(ValueError):
    """A rule that cannot be checked against the table; no row was read."""


def stored_rules(table: DataFrame) -> list[Rule]:
    """The rules of a table with the columns of ``RULES``, by name; more than ``MOST_RULES`` are refused, as each is an expression."""
    rows = table.select("rule", "kind", "columns", "low", "high", "pattern").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise InvalidRules(f"more than {MOST_RULES} rules")
    return sorted((Rule(r[0], r[1], tuple(r[2] or ()), *r[3:]) for r in rows), key=lambda r: r.rule or "")


def holds(rule: Rule, schema: T.StructType) -> Column:
    """Whether a row keeps the rule; never NULL."""
    absent = [c for c in rule.columns if c not in schema.names]
    if absent or not rule.columns:
        raise InvalidRules(f"{rule.rule}: columns absent: {absent}")
    columns = [quoted(c) for c in rule.columns]
    if rule.kind == "not_null":
        kept = [c.isNotNull() for c in columns]
    elif rule.kind == "pattern" and rule.pattern is not None:
        kept = [c.rlike(rule.pattern) for c in columns]
    elif rule.kind == "range":
        kept = []
        for name, column in zip(rule.columns, columns):
            # Numbers are compared as doubles, so that no bound is rounded to a column's decimals.
            kind = "double" if isinstance(schema[name].dataType, T.NumericType) else schema[name].dataType
            low, high = F.lit(rule.low).cast(kind), F.lit(rule.high).cast(kind)
            above = column >= low if rule.low is not None else column.isNotNull()
            kept.append(above & (column <= high) if rule.high is not None else above)
    elif rule.kind == "named_period" and len(columns) == 2:
        day, named = columns[0], file_name_lineage(columns[1])
        free = columns[1].isNotNull() & named["period_start"].isNull() & named["period_end"].isNull()
        kept = [day.isNotNull() & (free | day.between(named["period_start"], named["period_end"]))]
    else:
        raise InvalidRules(f"{rule.rule}: kind {rule.kind} with what is given")
    return F.coalesce(reduce(lambda a, b: a & b, kept), F.lit(False))


def compiled(rows: DataFrame, rules: DataFrame | Iterable[Rule]) -> dict[str, Column]:
    """Each rule's expression by its name, which has to be its own."""
    given = stored_rules(rules) if isinstance(rules, DataFrame) else list(rules)
    names = [r.rule for r in given]
    if None in names or len(set(names)) < len(names):
        raise InvalidRules("every rule needs a name of its own")
    return {r.rule: holds(r, rows.schema) for r in given}


def check_rules(rows: DataFrame, rules: DataFrame | Iterable[Rule]) -> DataFrame:
    """``(rule, failed_rows, checked_rows)`` for every rule; all of them are counted by one aggregation, without a shuffle of rows."""
    expressions = compiled(rows, rules)
    if not expressions:
        return rows.sparkSession.createDataFrame([], "rule string, failed_rows long, checked_rows long")
    # Aliases by number: a rule's name may be any text.
    failed = [F.count_if(~kept).alias(f"failed{i}") for i, kept in enumerate(expressions.values())]
    counts = rows.agg(F.count("*").alias("checked_rows"), *failed)
    per_rule = [F.struct(F.lit(name).alias("rule"), F.col(f"failed{i}").alias("failed_rows"), "checked_rows") for i, name in enumerate(expressions)]
    return counts.select(F.inline(F.array(*per_rule)))


def broken_rules(rows: DataFrame, rules: DataFrame | Iterable[Rule], name: str = "broken_rules") -> DataFrame:
    """Rows with the names of the rules they break, none for those that keep all; nothing is dropped or shuffled.

    An input column of that name is replaced.
    """
    names = [F.when(~kept, F.lit(rule)) for rule, kept in compiled(rows, rules).items()]
    return rows.withColumn(name, F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))
