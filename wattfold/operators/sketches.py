"""Mergeable states of distinct counts and quantiles: kept per group, merged later to any coarser group without the rows.

Three kinds. Bitmaps count dense integer keys exactly: a state row is one bucket of 32768 neighbouring values, so no state grows
with the data and equal values of different groups meet by a bitwise or. HLL and KLL sketches estimate distinct counts and
quantiles of anything, in a few kilobytes per group, within the errors stated below.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

STATE = "estado"
#: HLL registers as a power of two; KLL's parameter, the larger the more exact.
LG_K, KLL_K = 12, 1000


def distinct_error(lg_k=LG_K) -> float:
    """Relative standard error of an HLL estimate."""
    return 1.04 / 2 ** (lg_k / 2)


def rank_error(k=KLL_K) -> float:
    """Rank error, as a share of the rows, that 99 of 100 KLL quantiles stay within."""
    return 2.296 / k**0.9021


def bitmap_state(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """Which values of an integer column occur in each group: one row per group and bucket of values; NULL is no value."""
    known = df.filter(F.col(column).isNotNull())
    bucket = F.bitmap_bucket_number(column).alias("balde")
    return known.groupBy(*by, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias(STATE))


def merge_bitmaps(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The states of finer groups as states of coarser ones."""
    return state.groupBy(*by, "balde").agg(F.bitmap_or_agg(STATE).alias(STATE))


def bitmap_distinct(state: DataFrame, by: Sequence[str] = (), name="distintos") -> DataFrame:
    """Exact distinct values of each group of a state, or of all of it. Buckets are disjoint, so counts add up."""
    return state.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count(STATE)), F.lit(0)).alias(name))


def hll_state(df: DataFrame, by: Sequence[str], column: str, lg_k=LG_K) -> DataFrame:
    """One HLL sketch per group."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, lg_k).alias(STATE))


def hll_distinct(state: DataFrame, by: Sequence[str] = (), name="distintos_estimados") -> DataFrame:
    """Estimated distinct values of each group of sketches, or of all of them, counting a value of several groups once."""
    return state.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(STATE)).alias(name))


def kll_state(df: DataFrame, by: Sequence[str], column: str, k=KLL_K) -> DataFrame:
    """One KLL sketch of a numeric column per group; NULL and NaN are left out, so a group may have none."""
    value = F.col(column).cast("double")
    return df.filter(value.isNotNull() & ~F.isnan(value)).groupBy(*by).agg(F.kll_sketch_agg_double(value, F.lit(k)).alias(STATE))


def merge_kll(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return state.groupBy(*by).agg(F.kll_merge_agg_double(STATE).alias(STATE))


def kll_quantiles(state: DataFrame, probs: Mapping[str, float]) -> DataFrame:
    """The state's groups with rows seen and one column per quantile."""
    keys = [c for c in state.columns if c != STATE]
    found = [F.kll_sketch_get_quantile_double(STATE, F.lit(float(p))).alias(name) for name, p in probs.items()]
    return state.filter(F.col(STATE).isNotNull() & (F.kll_sketch_get_n_double(STATE) > 0)).select(*keys, F.kll_sketch_get_n_double(STATE).alias("n"), *found)


def rank_bounds(value: str | Column, quantile: str | Column) -> tuple[Column, Column]:
    """Aggregates: the least and the greatest share of rows that may lie at a value, as ties allow."""
    v, q = (F.col(c) if isinstance(c, str) else c for c in (value, quantile))
    return F.count_if(v < q) / F.count(v), F.count_if(v <= q) / F.count(v)


def within_rank_error(low: Column, high: Column, p: float, error: float, rows: Column) -> Column:
    """Whether ranks from low to high come as near to p as the error and one row allow."""
    return F.greatest(low - p, F.lit(p) - high, F.lit(0.0)) <= F.lit(error) + 1 / rows
