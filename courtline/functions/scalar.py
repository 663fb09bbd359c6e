"""Scalar column helpers used by the models. All are built-in expressions, so
they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(x: Column, digits: int) -> Column:
    """Round a DOUBLE as ``round(x * 10^d) / 10^d``: the scaled product is
    rounded half away from zero. This is the rounding the reference engine
    applies to doubles; Spark's ``round`` on the decimal text of ``x`` differs
    on a few inputs at 3 digits (e.g. averages just below a .xxx5 tie)."""
    scale = float(10**digits)
    return F.round(x * scale) / scale


def guarded_ratio(num: Column, den: Column, digits: int = 3) -> Column:
    """``den > 0 ? round(float(num) / den, digits) : 0.0`` as FLOAT.

    The quotient is cast to FLOAT before rounding, as a FLOAT / INT division
    is FLOAT in the reference; a NULL or zero denominator gives 0.0."""
    ratio = (num.cast("float") / den).cast("float")
    return F.when(den > 0, F.round(ratio, digits)).otherwise(F.lit(0.0).cast("float"))


def ordered_bucket(
    value: Column, limits: Sequence[tuple[str, object, str]], otherwise: str
) -> Column:
    """First matching ``(op, limit, label)`` wins, like a searched CASE.

    ``op`` is one of '<=', '<', '>', '>='. NULL matches nothing and takes
    ``otherwise``."""
    ops = {
        "<=": lambda c, v: c <= v,
        "<": lambda c, v: c < v,
        ">": lambda c, v: c > v,
        ">=": lambda c, v: c >= v,
    }
    expr = None
    for op, limit, label in limits:
        cond = ops[op](value, F.lit(limit))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def count_true(conditions: Sequence[Column]) -> Column:
    """How many of ``conditions`` hold; NULL counts as 0."""
    terms = [F.when(c, 1).otherwise(0) for c in conditions]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def threshold_count(values: Sequence[Column], at_least: int, needed: int) -> Column:
    """True when at least ``needed`` of ``values`` are >= ``at_least``."""
    return count_true([v >= at_least for v in values]) >= needed


def weighted_sum(terms: Sequence[tuple[Column, str]], result_type: str) -> Column:
    """Exact weighted sum with DECIMAL weights, e.g. ``[(pts, '1.0'), (tov, '-1.0')]``.

    Weights are decimal literals, so the arithmetic stays exact; the result is
    cast to ``result_type`` (a DECIMAL wide enough for the sum)."""
    total = None
    for col, weight in terms:
        w = F.lit(weight).cast("decimal(4,1)")
        part = col * w
        total = part if total is None else total + part
    return total.cast(result_type)

