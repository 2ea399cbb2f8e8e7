"""Operators against brute force on small and skewed inputs."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattfold.operators import aggregate as A, conform as K, joins as J, ranking as R, stats as S


def skewed(n, seed):
    """A third of all rows share one value; some are NULL."""
    rng = random.Random(seed)
    return [None if rng.random() < 0.05 else 7.0 if rng.random() < 0.35 else round(rng.gauss(0, 50), 1) for _ in range(n)]


@pytest.mark.parametrize("n,seed,pivots", [(1, 0, 255), (2, 1, 255), (500, 2, 3), (3000, 3, 7), (3000, 4, 255)])
def test_ranks_and_quantiles_equal_pandas(spark, n, seed, pivots):
    values = skewed(n, seed)
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    s = pd.Series(values, dtype="float64")
    expected = pd.DataFrame({"x": s, "r": s.rank()}).dropna().drop_duplicates().sort_values("x")
    got = R.ordered_counts(df, "x", pivots).orderBy("value").toPandas()
    ranks = got.before + (got.n + 1) / 2
    assert got.value.tolist() == expected.x.tolist() and ranks.tolist() == expected.r.tolist()
    assert not len(got) or (got.total == s.count()).all()
    q = R.exact_quantiles(df, "x", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.901, "e": 1.0}).first()
    assert q.n == s.count()
    if q.n:
        assert np.allclose([q.a, q.b, q.c, q.d, q.e], s.quantile([0.0, 0.25, 0.5, 0.901, 1.0]))


def test_quantiles_of_nothing(spark):
    q = R.exact_quantiles(spark.createDataFrame([], "x double"), "x", {"m": 0.5}).first()
    assert (q.n, q.m) == (0, None)


def test_approximate_quantiles_within_rank_error(spark):
    df = spark.range(20_000).select(F.col("id").cast("double").alias("x"))
    q = R.approximate_quantiles(df, "x", {"m": 0.5, "p": 0.9}).first()
    assert abs(q.m - 10_000) <= 21 and abs(q.p - 18_000) <= 21


def test_spearman_and_deseasonalised_equal_pandas(spark):
    rng = random.Random(5)
    rows = [(rng.randint(1, 12), rng.choice([1.0, 1.0, 2.0, rng.random()]), None if i % 50 == 0 else rng.gauss(0, 1)) for i in range(800)]
    pdf = pd.DataFrame(rows, columns=["m", "x", "y"])
    df = spark.createDataFrame(rows, "m int, x double, y double")
    assert np.isclose(S.spearman(df, "x", "y", "r").first().r, pdf.x.rank().corr(pdf.y.rank()))
    x, y = (pdf[c] - pdf.groupby("m")[c].transform("mean") for c in ("x", "y"))
    for bounded in (True, False):
        clean = S.deseasonalise(df, ["x", "y"], "m", bounded=bounded)
        assert np.isclose(clean.agg(S.safe_corr("x_des", "y_des")).first()[0], x.corr(y))


def test_correlation_without_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert df.agg(S.safe_corr("x", "y")).first()[0] is None


def test_trend_equals_polyfit(spark):
    pts = [(float(i), 3.0 * i + (i % 5)) for i in range(50)]
    r = spark.createDataFrame(pts, "x double, y double").agg(*S.linear_trend("y", "x")).first()
    assert np.allclose([r.inclinacao, r.intercepto], np.polyfit(*zip(*pts), 1))


def test_dedupe_keeps_the_latest_in_any_order(spark):
    rows = [("a", 1, "old"), ("a", 2, "new"), ("a", 2, "new"), (None, 1, "x"), (None, 3, "y"), ("b", 1, "b")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, t int, v string").repartition(3)
        got = sorted(K.dedupe(df, ["k"], ["t"]).collect(), key=str)
        assert [tuple(r) for r in got] == [("a", 2, "new"), ("b", 1, "b"), (None, 3, "y")]
    assert K.dedupe(df.select("k"), ["k"]).count() == 3


def test_rejects_name_the_first_broken_rule(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (None, None), (2, None)], "a int, b int")
    rules = {"sem_a": F.col("a").isNull(), "sem_b": F.col("b").isNull()}
    assert {r.medida: r.linhas for r in K.reject_counts(df, rules).collect()} == {
        "linhas_lidas": 4, "linhas_aceitas": 1, "sem_a": 2, "sem_b": 1}
    assert K.accepted(df, rules).count() == 1 and K.rejected(df, rules).count() == 3


def test_union_refuses_other_columns(spark):
    with pytest.raises(Exception):
        K.union_conformed(spark.range(1).select(F.lit(1).alias("a")), spark.range(1).select(F.lit(1).alias("b"))).collect()


def test_orphans_count_rows_and_nulls(spark):
    fact = spark.createDataFrame([(1,), (1,), (9,), (9,), (9,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    r = J.orphan_count(fact, "k", dim, "k").first()
    assert tuple(r) == (4, 2, 1)
    assert tuple(J.orphan_count(fact.filter("k = 1"), "k", dim, "k").first()) == (0, 0, 0)


def test_roles_need_both_sides(spark):
    fact = spark.createDataFrame([(1, "NE", 10.0), (1, "SE", 20.0), (2, "NE", 5.0), (1, "N", 1.0), (3, "NE", None), (3, "SE", 1.0)], "d int, s string, v double")
    got = J.roles_by_key(fact, "d", "s", {"ne": "NE", "se": "SE"}, {"ear": "v"}).orderBy("d").collect()
    assert [tuple(r) for r in got] == [(1, 10.0, 20.0), (3, None, 1.0)]


def test_enrich_keeps_rows_with_null_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "i int, k string")
    right = spark.createDataFrame([("a", 5), (None, 6)], "k string, v int")
    assert [(r.i, r.v) for r in J.enrich(left, right, "k").orderBy("i").collect()] == [(1, 5), (2, None), (3, None)]


def test_shares(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0), (None, 3, 5.0), (None, 4, 5.0)], "g string, i int, v double")
    for bounded in (True, False):
        got = {r.i: r.p for r in A.share_within(df, "v", ["g"], "p", bounded=bounded).collect()}
        assert got == {1: 25.0, 2: 75.0, 3: 50.0, 4: 50.0}
    assert sum(r.p for r in A.share_of_total(df, "v", "p").collect()) == pytest.approx(100)
    zero = spark.createDataFrame([(0.0,)], "v double")
    assert A.share_of_total(zero, "v", "p").first().p is None


def test_unpivot_keeps_missing_as_zero_and_pivot_returns(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "i int, a double, b double")
    long = A.unpivot_measures(df, ["i"], {"a": "A", "b": "B"}, "k", "v")
    assert sorted((r.k, r.v) for r in long.collect()) == [("A", 2.0), ("B", 0.0)]
    wide = A.pivot_matrix(long, ["i"], "k", ["A", "B", "C"], "v", "m_").first()
    assert tuple(wide) == (1, 2.0, 0.0, 0.0)


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("REL",), ("ENE",), (None,), (None,), (None,)], "c string")
    assert df.agg(A.most_frequent("c")).first()[0] == "ENE"
    assert df.filter("c is null").agg(A.most_frequent("c")).first()[0] is None


def test_latest_attributes_come_from_one_row(spark):
    df = spark.createDataFrame([("p", 1, "old", "BA"), ("p", 2, "new", None)], "k string, t int, n string, uf string")
    r = A.latest_attributes(df, "k", "t", ["n", "uf"], [F.min("t").alias("first")]).first()
    assert tuple(r) == ("p", "new", None, 1)


def test_top_k_best_row_and_blocks(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 9.0), (4, None)], "i int, v double")
    assert [r.i for r in R.top_k(df, "v", 2, ["i"]).collect()] == [2, 3]
    best = df.agg(A.best_row("v", ["i"], True, ["i"]).alias("a"), A.best_row("v", ["i"], False, ["i"]).alias("b")).first()
    assert (best.a.i, best.b.i) == (2, 1)
    assert R.top_k_share(df, "v", 1, ["i"], "p").first().p == pytest.approx(100 * 9 / 23)
    months = spark.range(20).select(F.format_string("2025-%02d", "id").alias("m"))
    blocks = R.consecutive_blocks(months, "m", 3, "b").groupBy("b").count().orderBy("b").collect()
    assert [r["count"] for r in blocks] == [len(b) for b in np.array_split(np.arange(20), 3)]


def test_rows_of_single_keys_are_not_shuffled_and_the_rest_is_deduplicated(spark):
    for n, twice in ((300, 7), (40, 40), (5, 0)):  # few keys repeat, all do, none does
        rows = [(i, "x" if i % 3 else None, 1, f"a{i}") for i in range(n)] + [(i, "x" if i % 3 else None, 2, f"b{i}") for i in range(twice)] * 2
        df = spark.createDataFrame(rows, "k int, g string, t int, v string").repartition(3)
        repeated = K.repeated_keys(df, ["k", "g"])
        assert repeated.count() == twice
        once, several = K.apart(df, ["k", "g"], repeated)
        assert {r.k for r in several.collect()} == set(range(twice)) and once.count() == n - twice
        got = once.unionByName(K.dedupe(several, ["k", "g"], ["t"]))
        assert sorted(map(str, got.collect())) == sorted(map(str, K.dedupe(df, ["k", "g"], ["t"]).collect()))
        assert "hashpartitioning" not in once.select("v")._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]


def test_hashes_that_share_a_bit_go_to_the_rows_that_are_compared(spark):
    low, high = 5, 5 + K.MAP_BITS
    bits = K.key_map(spark.createDataFrame([(low,), (-1,), (K.MAP_BITS // 2 + 63,)], "resumo bigint")).first().chunks
    chunk, word, bit = K._place(F.col("h"))
    for h, there in ((low, 1), (high, 1), (-1, 1), (K.MAP_BITS - 1, 1), (K.MAP_BITS // 2 + 63, 1), (6, 0), (0, 0)):
        c, w, b = spark.createDataFrame([(h,)], "h bigint").select(chunk, word, bit).first()
        assert ((bits[c] or [0] * K.CHUNK_WORDS)[w] >> b) & 1 == there
    assert all(x is None for x in K.key_map(spark.createDataFrame([], "resumo bigint")).first().chunks)


def test_targets_made_once_are_the_same_columns(spark):
    df = spark.createDataFrame([(" a ", "1", "2025-01-01 10:00:00"), ("-", "x", "2025-01-41 10:00:00"), (None, None, None)], "a string, b string, t string")
    spec = [("a", "nome", "text"), ("b", "valor", "decimal"), ("t", "quando", "timestamp")]
    plain, once = K.conform(df, spec, ["b"], {"tag": 1}), K.conform(df, spec, ["b"], {"tag": 1}, once=["nome", "quando"])
    assert plain.columns == once.columns and plain.collect() == once.collect()
