"""Ordered defect rules and the routing that follows from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """One defect. ``rejects`` rows leave staging; the others stay there and are only reported."""

    reason: str
    applies: Column
    rejects: bool


def first_reason(rules: Sequence[Rule]) -> Column:
    """Reason of the first rule that applies; an unknown (NULL) rule does not apply."""
    return F.coalesce(*[F.when(rule.applies, F.lit(rule.reason)) for rule in rules])


def is_accepted(rules: Sequence[Rule]) -> Column:
    """True when every rejecting rule is known not to apply.

    It is NULL when a rule is unknown, and a filter then drops the row. The expression stays a
    plain conjunction, so that a filter on it reaches the scan.
    """
    return reduce(lambda a, b: a & b, [~rule.applies for rule in rules if rule.rejects])


def any_of(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags)
