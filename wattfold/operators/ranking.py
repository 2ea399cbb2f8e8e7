"""Order statistics that stay distributed: global ranks, exact quantiles, top-k and consecutive blocks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattfold.functions.measures import ratio_pct

PIVOTS = 255


def _cuts_at_or_below(cuts: Column, value: Column, pivots: int) -> Column:
    """How many of the sorted cuts are at or below the value, by halving steps. A missing cut compares as NULL: no step."""
    steps = [F.lit(1 << i) for i in reversed(range(pivots.bit_length()))]
    return F.aggregate(
        F.array(*steps), F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) <= value, at + step).otherwise(at)
    )


def ordered_counts(df: DataFrame, column: str, pivots: int = PIVOTS) -> DataFrame:
    """Every distinct non-NULL value with its count ``n``, the number of smaller rows ``before`` and of all rows ``total``.

    A global ``Window.orderBy`` would sort everything in one task. Here values are counted (a hot value becomes one
    row), split into ranges by at most ``pivots`` values picked by hash - a fixed choice for given data, so a retried
    task sees the same ranges - and each range is accumulated on its own. What each range must add is a map of at most
    ``pivots + 1`` entries, which reaches the rows as a scalar.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    chosen = counts.select("value").orderBy(F.xxhash64("value"), "value").limit(pivots)
    cuts = chosen.agg(F.sort_array(F.collect_list("value"))).scalar()
    ranged = counts.withColumn("_cuts", cuts).withColumn(
        "_range", _cuts_at_or_below(F.col("_cuts"), F.col("value"), pivots)
    ).drop("_cuts")
    inside = Window.partitionBy("_range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    per_range = ranged.groupBy("_range").agg(F.sum("n").alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select("_range", "_rows", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    summary = starts.agg(F.struct(
        F.map_from_entries(F.collect_list(F.struct("_range", "_start"))).alias("start"), F.sum("_rows").alias("total")
    )).scalar()
    return local.withColumn("_s", summary).select(
        "value", "n", (F.col("_local") + F.col("_s.start")[F.col("_range")]).alias("before"), F.col("_s.total").alias("total")
    )


def average_ranks(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their 1-based rank; tied rows share the mean of their positions."""
    return ordered_counts(df, column).select("value", (F.col("before") + (F.col("n") + 1) / 2).alias("rank"))


def with_average_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the average rank of a column; NULL keeps a NULL rank."""
    ranks = average_ranks(df, column).select(F.col("value").alias(column), F.col("rank").alias(name))
    return df.join(ranks, column, "left")


def series_rank(column: str) -> Column:
    """Average rank in a calendar-bounded series (one row per day, say), as windows over one scan; NULL keeps a NULL rank."""
    missing = F.col(column).isNull()
    smaller = Window.partitionBy(missing).orderBy(column)
    tied = F.count("*").over(Window.partitionBy(missing, F.col(column)))
    return F.when(~missing, F.rank().over(smaller) + (tied - 1) / 2)


def exact_quantiles(df: DataFrame, column: str, probs: Mapping[str, float]) -> DataFrame:
    """One row of exact quantiles with linear interpolation, and the row count ``n``."""
    counts = ordered_counts(df, column)
    parts = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("total") - 1)
        for side, position in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
            parts.append(F.max(F.when(here, F.col("value"))).alias(f"_{name}_{side}"))
    wide = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *parts)
    result = [F.col("n")]
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        result.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return wide.select(*result)


def approximate_quantiles(df: DataFrame, column: str, probs: Mapping[str, float], accuracy=1000) -> DataFrame:
    """One row of quantiles within a rank error of 1/accuracy, in a single pass."""
    found = F.percentile_approx(column, [float(p) for p in probs.values()], accuracy)
    wide = df.agg(F.count(column).alias("n"), found.alias("_q"))
    return wide.select("n", *[F.col("_q")[i].cast("double").alias(name) for i, name in enumerate(probs)])


def top_k(df: DataFrame, by: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the highest ``by``; ties by the given keys. Each task keeps only ``k`` rows."""
    return df.orderBy(F.desc_nulls_last(by), *tie).limit(k)


def top_k_share(df: DataFrame, value: str, k: int, tie: Sequence[str], name: str) -> DataFrame:
    """One row: percentage of the total held by the ``k`` largest rows."""
    total = df.agg(F.sum(value)).scalar()
    return top_k(df, value, k, tie).agg(ratio_pct(F.sum(value), total).alias(name))


def consecutive_blocks(series: DataFrame, order: str, blocks: int, name: str) -> DataFrame:
    """Numbers the rows of a calendar-bounded series (one row per month or day) into near-equal blocks, larger first."""
    return series.withColumn(name, F.ntile(blocks).over(Window.orderBy(order)))
