"""Threshold comparisons and alarm priorities."""

from __future__ import annotations

import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six comparison operators a rule may name.
OPERATORS = {
    ">": operator.gt,
    "<": operator.lt,
    ">=": operator.ge,
    "<=": operator.le,
    "==": operator.eq,
    "!=": operator.ne,
}

# Priorities and their rank.
PRIORITY_RANK = {"LOW": 1, "MEDIUM": 2, "HIGH": 3}


def op_column(left: Column, op: str | None, threshold: float) -> Column:
    """``left op threshold`` for an operator known on the driver; unknown never holds."""
    compare = OPERATORS.get(op)
    return compare(left, F.lit(threshold)) if compare else F.lit(False)


def op_case(left: Column, op: Column, threshold: Column) -> Column:
    """``left op threshold`` for an operator that is itself a column."""
    case = F
    for symbol, compare in OPERATORS.items():
        case = case.when(op == symbol, compare(left, threshold))
    return case.otherwise(F.lit(False))


def normal_priority(priority: Column) -> Column:
    return F.upper(F.coalesce(priority, F.lit("LOW")))


def is_known_priority(priority: Column) -> Column:
    return priority.isin(*PRIORITY_RANK)


def priority_rank(priority: Column) -> Column:
    case = F
    for name, rank in PRIORITY_RANK.items():
        case = case.when(priority == name, F.lit(rank))
    return case
