"""Exact quantiles by narrowing intervals, against pandas, with intervals that fit a task only after several rounds."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattfold.operators import selection as X
from wattfold.plans import quality as Q

PROBS = {"least": 0.0, "p001": 0.001, "q1": 0.25, "mediana": 0.5, "p901": 0.901, "most": 1.0}


def columns_of(n, seed):
    rng = random.Random(seed)
    hot = [None if rng.random() < 0.05 else 7.0 if rng.random() < 0.4 else round(rng.gauss(0, 50), 1) for _ in range(n)]
    tail = [math.exp(rng.gauss(0, 4)) for _ in range(n)]
    return list(zip(hot, tail, [float(i % 2) for i in range(n)], [3.0] * n, [None] * n))


@pytest.mark.parametrize("n,fit", [(1, 1), (2, 0), (3000, 10**6), (3000, 40), (20000, 5), (20000, 0)])
def test_quantiles_equal_pandas(spark, n, fit):
    rows = columns_of(n, n + fit)
    df = spark.createDataFrame(rows, "hot double, tail double, two double, same double, none double").repartition(5)
    got = X.quantiles_of(df, {c: F.col(c) for c in df.columns}, PROBS, fit)
    expected = pd.DataFrame(rows, columns=df.columns, dtype="float64")
    for c in df.columns:
        assert got[c]["n"] == expected[c].count()
        if got[c]["n"]:
            assert np.allclose([got[c][p] for p in PROBS], expected[c].quantile(list(PROBS.values())), rtol=1e-12)
        else:
            assert all(got[c][p] is None for p in PROBS)


def test_a_sketch_that_errs_costs_no_result(spark, monkeypatch):
    """Brackets one step beside the rank: the search goes on outside of them."""
    around = X.Interval.around
    monkeypatch.setattr(X.Interval, "around", lambda v, rank: around(v, v.before + (rank - v.before + v.inside // 2) % v.inside))
    values = [float((i * 7919) % 5003) for i in range(5003)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    probs = {"q1": 0.25, "p901": 0.901}
    got = X.quantiles_of(df, {"x": F.col("x")}, probs, 3000)["x"]
    assert np.allclose([got[p] for p in probs], np.quantile(values, list(probs.values())))


def test_not_a_number_and_infinity(spark):
    df = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,), (1.0,), (None,), (2.0,)], "x double")
    for fit in (0, 100):
        got = X.quantiles_of(df, {"x": F.col("x")}, {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0}, fit)["x"]
        assert [got[k] for k in "nabcd"] == [5, -math.inf, 1.0, 2.0, math.inf] and math.isnan(got["e"])


def test_table_and_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    assert X.quantile_table(empty, {"x": F.col("x")}, {"m": 0.5}).collect() == [("x", 0, None)]
    assert X.quantiles_of(empty, {}, {"m": 0.5}) == {}


def test_outliers_of_a_table_equal_those_one_by_one(spark):
    rows = columns_of(2000, 3)
    df = spark.createDataFrame(rows, "hot double, tail double, two double, same double, none double")
    measures = [("hot", "a", "two = 1"), ("tail", "b", "true"), ("same", "c", "true"), ("none", "d", "true"), ("tail", "e", "false")]
    together = Q.outliers_together(df, measures).collect()
    assert together == [Q.outliers(df, c, label, condition, exact=True).first() for c, label, condition in measures]
