"""Derived measures, bands, labels and calendar keys as Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_as_zero_sum(*cols) -> Column:
    """Sum of columns in which NULL counts as 0."""
    return reduce(add, [F.coalesce(_as_col(c), F.lit(0.0)) for c in cols])


def guarded_pct(num, den, digits=4) -> Column:
    """100*num/den rounded, only where den is positive."""
    num, den = _as_col(num), _as_col(den)
    return F.when(den > 0, F.round(F.try_divide(F.lit(100.0) * num, den), digits))


def ratio_pct(num: Column, den: Column, digits=None) -> Column:
    """100*num/den of two aggregates; NULL where the denominator is 0 or NULL."""
    value = F.try_divide(F.lit(100.0) * num, den)
    return value if digits is None else F.round(value, digits)


def shortfall(reference, actual, reason) -> Column:
    """max(reference - actual, 0) where a reason is given, else 0.

    ``greatest`` skips NULL, so a missing reference or actual counts as no shortfall;
    :func:`wattfold.plans.quality.plausibility` counts such rows.
    """
    gap = F.greatest(_as_col(reference) - _as_col(actual), F.lit(0.0))
    return F.when(_as_col(reason).isNotNull(), gap).otherwise(F.lit(0.0))


def to_energy(mean_power, hours=0.5, digits=6) -> Column:
    """Energy of a mean power held for ``hours``."""
    return F.round(_as_col(mean_power) * F.lit(float(hours)), digits)


def label(code, mapping: dict) -> Column:
    """Text for a code; NULL for an unknown or missing code."""
    code = _as_col(code)
    chain = None
    for key, text in mapping.items():
        chain = F.when(code == key, text) if chain is None else chain.when(code == key, text)
    return chain


def band(value, edges, last) -> Column:
    """Label of the first ``(upper, label)`` whose upper bound exceeds the value, else ``last``. NULL stays NULL."""
    value = _as_col(value)
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for upper, text in edges:
        chain = chain.when(value < upper, text)
    return chain.otherwise(last)


def in_range(value, bounds) -> Column:
    return _as_col(value).between(*bounds)


def name_of(position, names) -> Column:
    """The 1-based ``position``-th of a fixed list of names."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), _as_col(position))


def date_key(c) -> Column:
    """Integer yyyyMMdd, by arithmetic so that it stays in generated code."""
    c = _as_col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def month_text(c) -> Column:
    """yyyy-MM."""
    return F.date_format(_as_col(c), "yyyy-MM")


def hour_start(c) -> Column:
    """The full hour a wall-clock time falls in; keeps TIMESTAMP_NTZ, unlike ``date_trunc``, and rows without a time, unlike ``window``."""
    c = _as_col(c)
    return c - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(c), F.date_part(F.lit("SECOND"), c))
