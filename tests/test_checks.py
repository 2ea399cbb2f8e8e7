"""Integrity in one pass, runs and gaps, co-moment states and guarded loads, against plain versions."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattfold.operators import joins as J, stats as S
from wattfold.plans import guard, quality as Q


def test_many_keys_at_once_equal_one_at_a_time(spark):
    fact = spark.createDataFrame([(1, "a", 0.0), (1, "z", 2.5), (9, None, -0.0), (9, "z", None), (None, "b", 7.0)], "k int, s string, x double")
    other = spark.createDataFrame([(2,), (1,), (2,)], "k long")
    dims = spark.createDataFrame([(1, "a", 0.0), (2, "b", 7.0), (2, "b", 7.0), (None, None, None)], "k long, s string, x double")
    tables, keys = {"f": fact, "o": other, "d": dims}, [("f", "k", "d", "k"), ("f", "s", "d", "s"), ("f", "x", "d", "x"), ("o", "k", "d", "k")]
    got = {r[0]: tuple(r)[1:] for r in J.orphan_counts(tables, keys).collect()}
    assert got == {f"{f}.{c} -> {d}": tuple(J.orphan_count(tables[f], c, tables[d], k).first()) for f, c, d, k in keys}
    empty = J.orphan_counts({"f": fact.limit(0), "d": dims}, keys[:1]).collect()
    assert [tuple(r) for r in empty] == [("f.k -> d", 0, 0, 0)]


@pytest.mark.parametrize("kind,step", [("timestamp_ntz", "30 MINUTES"), ("date", "1 DAY")])
def test_runs_and_gaps_equal_a_walk_over_the_slots(spark, monkeypatch, kind, step):
    monkeypatch.setattr(Q, "RANGE_SLOTS", 8)
    rng, unit = random.Random(3), dt.timedelta(minutes=30) if "MIN" in step else dt.timedelta(days=1)
    start = dt.datetime(2018, 10, 30) if "MIN" in step else dt.date(2018, 10, 30)
    at = {e: sorted({0, *(k for k in range(90) if rng.random() < share)}) for e, share in (("a", 0.9), ("b", 0.3), (None, 0.6))} | {"c": [5], "d": [0, 300]}
    rows = [(e, start + k * unit) for e, ks in at.items() for k in ks] * 2 + [("a", None), ("e", None)]
    if "MIN" in step:
        rows.append(("a", start + dt.timedelta(minutes=7)))  # off the grid
    df = spark.createDataFrame(rows, f"e string, t {kind}").repartition(5)
    holes, runs = [], []
    for e, ks in at.items():
        holes += [(e, start + k * unit) for k in set(range(ks[0], ks[-1])) - set(ks)]
        cuts = [0, *(i for i in range(1, len(ks)) if ks[i] - ks[i - 1] > 1), len(ks)]
        runs += [(e, start + ks[a] * unit, start + ks[b - 1] * unit, b - a, ks[a] - ks[a - 1] - 1 if a else 0) for a, b in zip(cuts, cuts[1:])]
    order = lambda rs: sorted(rs, key=str)
    assert order(map(tuple, Q.gaps(df, "e", "t", step).collect())) == order(holes)
    assert order(map(tuple, Q.present_runs(df, "e", "t", step).collect())) == order(runs)
    assert Q.gaps(df.limit(0), "e", "t", step).count() == Q.present_runs(df.limit(0), "e", "t", step).count() == 0


def test_steps_without_a_fixed_length_are_refused(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, 1))], "e string, t date")
    for step in ("1 MONTH", "30 MINUTES"):
        with pytest.raises(ValueError):
            Q.gaps(df, "e", "t", step)


def test_merged_comoments_equal_pandas(spark):
    rng = random.Random(8)
    rows = [(rng.choice("aaab"), rng.randint(1, 12), None if rng.random() < 0.1 else 1e9 + rng.random(), None if rng.random() < 0.1 else rng.gauss(0, 1)) for _ in range(2000)]
    rows = [(g, m, x, y if y is None or x is None else y + 3 * (x - 1e9) + m) for g, m, x, y in rows] + [("c", 1, None, 1.0), ("d", 1, 1.0, 2.0), ("d", 2, 1.0, 3.0)]
    state = S.comoment_state(spark.createDataFrame(rows, "g string, m int, x double, y double"), ["g", "m"], "x", "y")
    pairs = pd.DataFrame(rows, columns=["g", "m", "x", "y"]).dropna()
    got = {r.g: r for r in S.merge_comoments(state, ["g"]).select("g", "n", S.state_corr().alias("r"), *S.state_trend()).collect()}
    within = {r.g: r.r for r in S.within_groups(state, ["g"]).select("g", S.state_corr().alias("r")).collect()}
    assert "c" not in got and got["d"].n == 2 and got["d"].r is None and got["d"].inclinacao is None
    for g, p in pairs[pairs.g != "d"].groupby("g"):
        assert got[g].n == len(p) and np.isclose(got[g].r, p.x.corr(p.y), atol=1e-5)
        assert np.isclose(got[g].inclinacao, np.polyfit(p.x - p.x.mean(), p.y, 1)[0], rtol=1e-4)
        rest = p[["x", "y"]] - p.groupby("m")[["x", "y"]].transform("mean")
        assert np.isclose(within[g], rest.x.corr(rest.y), atol=1e-5)
    nothing = S.merge_comoments(state.limit(0)).first()
    assert nothing.n == 0 and nothing.mx is None


def test_a_load_above_its_limits_leaves_the_table(spark, tmp_path):
    target, quarantine, replaced = str(tmp_path / "t"), str(tmp_path / "q"), []

    def load(rows, name, **more):
        df = spark.createDataFrame(rows, "k int, v double")
        rules = {"sem_chave": F.col("k").isNull(), "negativo": F.col("v") < 0}
        keep = lambda good: (replaced.append(name), good.write.mode("overwrite").parquet(target))
        return guard.guarded_load(df, name, rules, keep, quarantine, 50.0, warnings={"sem_valor": F.col("v").isNull()}, **more)

    one = load([(1, 1.0), (2, -1.0), (3, None), (None, -2.0)], "a")
    assert (one["situacao"], one["linhas_lidas"], one["sem_chave"], one["negativo"], one["sem_valor"]) == ("gravada", 4, 1, 1, 1)
    content = lambda: sorted(tuple(r) for r in spark.read.parquet(target).select("k").collect())
    assert content() == [(1,), (3,)]
    two = load([(7, -1.0), (8, -1.0), (9, 1.0)], "b")
    three = load([(7, None), (9, 1.0)], "c", limits={"sem_valor": 10.0})
    assert (two["situacao"], two["limites_excedidos"]) == ("recusada", ["rejeitadas"])
    assert (three["situacao"], three["limites_excedidos"]) == ("recusada", ["sem_valor"])
    assert content() == [(1,), (3,)] and replaced == ["a"]
    load([(7, -1.0), (8, -1.0), (9, 1.0)], "b")
    held = guard.quarantined(spark, quarantine).groupBy("carga", "motivo_rejeicao").count().collect()
    assert sorted(map(tuple, held)) == [("a", "negativo", 1), ("a", "sem_chave", 1), ("b", "negativo", 2)]
    assert load([], "d")["situacao"] == "gravada" and content() == []
    with pytest.raises(ValueError):
        load([], "e", limits={"outro": 1.0})
