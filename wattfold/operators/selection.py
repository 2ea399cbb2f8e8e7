"""Exact order statistics of many columns at once, by intervals that narrow from scan to scan."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

FIT, SKETCH_K, GRID, MARGIN = 1_000_000, 800, 128, 2


@dataclass
class Interval:
    """The values of one column strictly between two ends (None: no end), and the ranks looked for among them."""

    column: int
    low: float | None
    high: float | None
    before: int
    inside: int
    grid: list[float] | None = None
    ranks: list[int] = field(default_factory=list)

    def holds(self) -> Column:
        x = F.col(f"_{self.column}")
        ends = ([x > F.lit(self.low)] if self.low is not None else []) + ([x < F.lit(self.high)] if self.high is not None else [])
        held = x.isNotNull()
        for end in ends:
            held = held & end
        return held

    def around(self, rank: int) -> tuple[float, float]:
        """Two values of the interval that the sketch puts on both sides of a rank."""
        at = (rank - self.before) / self.inside * GRID
        return self.grid[max(0, math.floor(at) - MARGIN)], self.grid[min(GRID, math.ceil(at) + MARGIN)]


def _sketch(where: Column, column: int) -> Column:
    return F.kll_sketch_agg_double(F.when(where, F.col(f"_{column}")), F.lit(SKETCH_K))


def _grid(sketch: str) -> Column:
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(F.col(sketch), steps))


def _sketched(values: DataFrame, intervals: Sequence[Interval]) -> None:
    """One scan: a grid of quantiles for each interval."""
    row = values.agg(*[_sketch(v.holds(), v.column).alias(f"s{i}") for i, v in enumerate(intervals)])
    for v, grid in zip(intervals, row.select(*[_grid(c) for c in row.columns]).first()):
        v.grid = grid


def _narrowed(values: DataFrame, intervals: Sequence[Interval], found: dict) -> list[Interval]:
    """One scan: what lies below, at and between two values around each rank, and the next grid of what lies between."""
    brackets = {}
    for v in intervals:
        for rank in v.ranks:
            brackets.setdefault((v.column, *v.around(rank)), []).append((v, rank))
    aggs, grids = [], []
    for i, (column, a, b) in enumerate(brackets):
        x = F.col(f"_{column}")
        aggs += [F.count_if(c).alias(f"{n}{i}") for n, c in (("lt_a", x < a), ("le_a", x <= a), ("lt_b", x < b), ("le_b", x <= b))]
        aggs.append(_sketch((x > a) & (x < b), column).alias(f"s{i}"))
        grids.append(_grid(f"s{i}").alias(f"g{i}"))
    counted = values.agg(*aggs)
    row = counted.select(*[c for c in counted.columns if not c.startswith("s")], *grids).first()
    left = {}
    for i, ((column, a, b), looked_for) in enumerate(brackets.items()):
        lt_a, le_a, lt_b, le_b = (row[f"{n}{i}"] for n in ("lt_a", "le_a", "lt_b", "le_b"))
        for v, rank in looked_for:
            if lt_a <= rank < le_a or lt_b <= rank < le_b:
                found[column, rank] = a if rank < le_a else b
                continue
            if rank < lt_a:  # the sketch erred by more than the margin: go on beside the bracket
                ends, before, inside, grid = (v.low, a), v.before, lt_a - v.before, None
            elif rank < lt_b:
                ends, before, inside, grid = (a, b), le_a, lt_b - le_a, row[f"g{i}"]
            else:
                ends, before, inside, grid = (b, v.high), le_b, v.before + v.inside - le_b, None
            left.setdefault((column, *ends), Interval(column, *ends, before, inside, grid)).ranks.append(rank)
    return list(left.values())


def _picked(values: DataFrame, intervals: Sequence[Interval], found: dict) -> None:
    """One scan: the values of intervals that each fit a task, counted and put in order there."""
    held = [F.when(v.holds(), F.struct(F.lit(i).alias("i"), F.col(f"_{v.column}").alias("x"))) for i, v in enumerate(intervals)]
    rows = values.select(F.explode(F.array_compact(F.array(*held))).alias("h")).select("h.*")
    order = Window.partitionBy("i").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = rows.groupBy("i", "x").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(order))
    wanted = [(i, v, rank) for i, v in enumerate(intervals) for rank in v.ranks]
    at = [
        F.max(F.when((F.col("i") == i) & (F.col("upto") > rank - v.before) & (F.col("upto") - F.col("n") <= rank - v.before), F.col("x")))
        for i, v, rank in wanted
    ]
    for (_, v, rank), value in zip(wanted, counts.agg(*at).first()):
        found[v.column, rank] = value


def quantiles_of(df: DataFrame, columns: Mapping[str, Column], probs: Mapping[str, float], fit: int = FIT) -> dict[str, dict]:
    """Exact quantiles with linear interpolation, as doubles, and the count ``n`` of non-NULL values, for every column.

    The first scan counts and sketches all columns. Each further scan counts, for all ranks looked for together, how many
    values lie below, at and between two values that the last sketch puts around the rank, and sketches those between;
    counts decide, so a sketch that errs costs a scan and never a result. An interval whose values fit a task (``fit``
    rows) is put in order there. Both ends of an interval are values of the data and are left out of the next one, so
    hot values end a search instead of holding it up. A round keeps about a twenty-fifth of the rows: seven scans for 10**12.

    Runs its scans when called; only counts and a grid of 129 values for each interval reach the driver. NaN counts as the greatest
    value. A column without values has n 0 and None for each quantile.
    """
    if not columns:
        return {}
    raw = df.select(*[e.cast("double").alias(f"_{i}") for i, e in enumerate(columns.values())])
    values = raw.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in raw.columns])
    all_of = [Interval(i, None, None, 0, 0) for i in range(len(columns))]
    state = raw.agg(
        *[F.count(c).alias(f"n{c}") for c in raw.columns], *[F.count_if(F.isnan(c)).alias(f"nan{c}") for c in raw.columns],
        *[_sketch(~F.isnan(c), i).alias(f"s{c}") for i, c in enumerate(raw.columns)],
    )
    row = state.select(*[c for c in state.columns if not c.startswith("s")], *[_grid(f"s{c}").alias(f"g{c}") for c in raw.columns]).first()
    found = {}
    for v in all_of:
        n, nan = row[f"n_{v.column}"], row[f"nan_{v.column}"]
        v.inside, v.grid = n - nan, row[f"g_{v.column}"]
        for rank in sorted({r for p in probs.values() for r in _positions(p, n)}):
            if rank < v.inside:
                v.ranks.append(rank)
            else:
                found[v.column, rank] = math.nan
    todo, ready = [v for v in all_of if v.ranks], []
    while todo:
        ready += [v for v in todo if v.inside <= fit]
        todo = [v for v in todo if v.inside > fit]
        if blind := [v for v in todo if v.grid is None]:
            _sketched(values, blind)
        if todo:
            todo = _narrowed(values, todo, found)
    if ready:
        _picked(values, ready, found)
    result = {}
    for i, name in enumerate(columns):
        n = row[f"n_{i}"]
        result[name] = {"n": n} | {key: _between(found, i, p, n) for key, p in probs.items()}
    return result


def _positions(p: float, n: int) -> tuple[int, ...]:
    return (math.floor(p * (n - 1)), math.ceil(p * (n - 1))) if n else ()


def _between(found: Mapping, column: int, p: float, n: int) -> float | None:
    if not n:
        return None
    lo, hi = (found[column, r] for r in _positions(p, n))
    return lo if lo == hi else lo + (hi - lo) * (p * (n - 1) - math.floor(p * (n - 1)))


def quantile_table(df: DataFrame, columns: Mapping[str, Column], probs: Mapping[str, float], fit: int = FIT) -> DataFrame:
    """``quantiles_of`` as one row for each column."""
    found = quantiles_of(df, columns, probs, fit)
    schema = "coluna string, n bigint" + "".join(f", `{p}` double" for p in probs)
    return df.sparkSession.createDataFrame([(name, *row.values()) for name, row in found.items()], schema)
