"""Aggregations: roll-up with code fan-out, latest attributes, ratios, shares, pivots and unpivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattfold.functions.measures import hour_start, ratio_pct


def fan_out(code: str, values: Sequence[str], measure: str, pattern: str, digits=6) -> list[Column]:
    """One rounded conditional sum per code, named ``pattern % code in lower case``."""
    return [
        F.round(F.sum(F.when(F.col(code) == v, F.col(measure)).otherwise(0.0)), digits).alias(pattern % v.lower())
        for v in values
    ]


def rollup_hours(df: DataFrame, keys: Sequence[str], ts: str, hour: str, aggs: Sequence[Column]) -> DataFrame:
    """Aggregate readings to full hours per key; one shuffle, with partial aggregation before it."""
    return df.withColumn(hour, hour_start(ts)).groupBy(*keys, hour).agg(*aggs)


def most_frequent(code: str) -> Column:
    """Most frequent non-NULL value; the smallest one on a tie, so the result does not depend on row order."""
    return F.mode(code, deterministic=True)


def latest_attributes(df: DataFrame, key: str, ts: str, attributes: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """Attributes of each key's latest row, all from the same row (ties by the attributes themselves)."""
    row = F.struct(F.col(ts), *[F.col(a) for a in attributes])
    latest = df.groupBy(key).agg(F.max(row).alias("_row"), *extra)
    return latest.select(key, *[F.col("_row")[a].alias(a) for a in attributes], *[c for c in latest.columns if c not in (key, "_row")])


def rate_by(df: DataFrame, keys: Sequence[str], num: str, den: str, name: str, digits=2) -> DataFrame:
    """Ratio of sums per group. A rate is never averaged or summed: it is recomputed from its two sums."""
    return df.groupBy(*keys).agg(ratio_pct(F.sum(num), F.sum(den), digits).alias(name))


def share_of_total(df: DataFrame, value: str, name: str, digits=None) -> DataFrame:
    """Percentage of the grand total. The total comes in as a scalar subquery, so rows are not gathered in one task."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, ratio_pct(F.col(value), total, digits))


def share_within(df: DataFrame, value: str, within: Sequence[str], name: str, digits=None, bounded=False) -> DataFrame:
    """Percentage of the total of each ``within`` group.

    ``bounded=True`` says that a group holds few rows by construction (one per energy source, say) and uses a window.
    Otherwise totals are aggregated and joined back, so that a large group is never gathered in one task.
    """
    within = list(within)
    if bounded:
        total = F.sum(value).over(Window.partitionBy(*within))
        return df.withColumn(name, ratio_pct(F.col(value), total, digits))
    totals = df.groupBy(*within).agg(F.sum(value).alias("_total")).select(*[F.col(c).alias(f"_t_{c}") for c in within], "_total")
    same = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in within]
    joined = df.join(totals, same, "inner")
    return joined.withColumn(name, ratio_pct(F.col(value), F.col("_total"), digits)).select(*df.columns, name)


def unpivot_measures(df: DataFrame, ids: Sequence[str], columns: Mapping[str, str], key: str, value: str) -> DataFrame:
    """Wide to long: one row per listed column with its code; a missing value becomes 0."""
    columns = dict(columns)
    coded = df.select(*ids, *[F.col(c).alias(code) for c, code in columns.items()])
    long = coded.unpivot(list(ids), list(columns.values()), key, value)
    return long.withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))


def pivot_matrix(df: DataFrame, index: Sequence[str], columns: str, values: Sequence, value: str, prefix="", fill=0.0) -> DataFrame:
    """Long to wide with a fixed list of output columns; missing cells become ``fill``."""
    wide = df.groupBy(*index).pivot(columns, list(values)).agg(F.first(value, ignorenulls=True))
    named = [F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values]
    out = wide.select(*index, *named)
    return out if fill is None else out.na.fill(fill, [f"{prefix}{v}" for v in values])


def best_row(by: str, columns: Sequence[str], highest=True, tie: Sequence[str] = ()) -> Column:
    """Aggregate: struct of ``columns`` on the row with the highest (lowest) ``by``; ties go to the smallest tie key."""
    order = F.struct(F.col(by) if not highest else -F.col(by), *[F.col(t) for t in tie])
    return F.min_by(F.struct(*[F.col(c) for c in columns]), F.when(F.col(by).isNotNull(), order))
