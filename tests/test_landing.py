"""Landing exactly once, period selection, and refresh of changed partitions only, on planted files."""

import pathlib

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests import grid
from wattfold.config import Layers, Period
from wattfold.operators import sketches as SK
from wattfold.plans import pipeline
from wattfold.sources import landing, partitions


def put(folder, name, *rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(["a;b", *rows]) + "\n", encoding="utf-8")


def counts(spark, target):
    return {r["arquivo"]: r["n"] for r in landing.landed_rows(spark, target).groupBy("arquivo").agg(F.count("*").alias("n")).collect()}


def test_files_are_landed_once_even_after_a_failure(spark, tmp_path):
    folder, target = tmp_path / "in" / "x", str(tmp_path / "out")
    put(folder, "x_2024_01.csv", "1;um", '2;"dois\nlinhas; ""e"" mais"')
    put(folder, "x_2024_02.csv", "3;três")
    land = lambda **k: landing.land(spark, str(tmp_path / "in"), "x", ["a", "b"], target, **k)

    def fails(batch):
        raise RuntimeError("planned")

    assert landing.landed_manifest(spark, target).count() == 0
    with pytest.raises(StreamingQueryException):
        land(between=fails)
    land()
    land()
    assert counts(spark, target) == {"x_2024_01.csv": 2, "x_2024_02.csv": 1}
    put(folder, "x_2024_03.csv", "4;quatro")
    put(folder, "x_sem.csv", "5;cinco")
    put(folder, "x_2024_04.csv")
    (folder / "x_2024_05.csv").write_text("")
    with pytest.raises(StreamingQueryException):
        land(between=fails)
    land()
    assert counts(spark, target) == {"x_2024_01.csv": 2, "x_2024_02.csv": 1, "x_2024_03.csv": 1, "x_sem.csv": 1}
    put(folder, "x_2024_02.csv", "3;trocado por outro")
    (folder / "x_2024_01.csv").unlink()
    window = Period(first_month="2024-02", last_month="2024-12")
    status = {r["arquivo"]: (r["status"], r["situacao"], r["linhas"]) for r in landing.landing_status(spark, str(tmp_path / "in"), target, 1, period=window).collect()}
    assert status == {
        "x_2024_01.csv": ("ausente", "fora_da_janela", 2), "x_2024_02.csv": ("alterado", "selecionado", 1), "x_2024_03.csv": ("novo", "selecionado", 1),
        "x_sem.csv": ("novo", "sem_periodo", 1), "x_2024_04.csv": ("pendente", "selecionado", 0)}
    assert sorted(r["a"] for r in landing.landed_rows(spark, target, period=window).collect()) == ["3", "4"]
    same = landing.landed_manifest(spark, target).select("resumo").distinct().count()
    assert same == 4


def test_bronze_from_landed_files_equals_a_full_reload(spark, tmp_path):
    window = Period(2021, 2026, "2025-01", "2026-08")
    folder, store = grid.land(tmp_path / "landing"), str(tmp_path / "store")
    full, landed = Layers("lf_b", "lf_s", "lf_g"), Layers("li_b", "li_s", "li_g")
    for layers in (full, landed):
        pipeline.create_layers(spark, layers)
    want = pipeline.run_bronze(spark, folder, full, window)
    for _ in range(2):
        assert pipeline.run_landing(spark, folder, store, landed, window) == want
    for name in want:
        a, b = (spark.table(f"{x.bronze}.{name}").drop("_ingest_ts", "_source_file") for x in (full, landed))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in pathlib.Path(path).rglob("*.parquet")}


def test_refresh_leaves_unchanged_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    made = lambda rows: spark.createDataFrame(rows, "day string, k long, v double")
    first = [("a", 1, 1.0), ("a", 2, None), ("b", 3, 2.0), (None, 4, 3.0), ("c/d", 5, 4.0)]
    show = lambda df: {r["day"]: (r["linhas"], r["situacao"]) for r in df.collect()}
    assert set(show(partitions.refresh(made(first), path, ["day"])).values()) == {(1, "gravada"), (2, "gravada")}
    before = files(tmp_path / "t" / "dados")
    assert {s for _, s in show(partitions.refresh(made(first[::-1]), path, ["day"])).values()} == {"mantida"}
    assert files(tmp_path / "t" / "dados") == before
    now = [("a", 1, 1.0), ("a", 1, 1.0), ("b", 3, 2.0), (None, 4, 3.0), ("e", 6, 0.0)]
    assert show(partitions.refresh(made(now), path, ["day"])) == {"a": (2, "gravada"), "b": (1, "mantida"), None: (1, "mantida"), "c/d": (1, "removida"), "e": (1, "gravada")}
    after = files(tmp_path / "t" / "dados")
    assert {f for f in after if f in before and after[f] == before[f]} == {f for f in before if "day=b" in f or "HIVE" in f}
    assert sorted(tuple(r) for r in partitions.read(spark, path).select("day", "k", "v").filter("day is not null").collect()) == sorted(r for r in now if r[0])
    assert partitions.refresh(made([]), path, ["day"]).filter("situacao <> 'removida'").count() == 0


def test_a_refresh_that_fails_is_made_good_by_the_next(spark, tmp_path, monkeypatch):
    path, made = str(tmp_path / "t"), lambda v: spark.createDataFrame([("a", v), ("b", 1)], "day string, v long")
    partitions.refresh(made(1), path, ["day"])
    real, calls = partitions._replace_digests, []

    def second_fails(digests, where):
        calls.append(where)
        if len(calls) == 2:
            raise RuntimeError("planned")
        real(digests, where)

    monkeypatch.setattr(partitions, "_replace_digests", second_fails)
    with pytest.raises(RuntimeError):
        partitions.refresh(made(2), path, ["day"])
    monkeypatch.undo()
    # The content that was replaced comes back: its old digest must not pass it off as unchanged.
    assert {r["day"]: r["situacao"] for r in partitions.refresh(made(1), path, ["day"]).collect()} == {"a": "gravada", "b": "mantida"}
    assert sorted(tuple(r) for r in partitions.read(spark, path).select("day", "v").collect()) == [("a", 1), ("b", 1)]


def test_states_merge_to_what_rows_give(spark):
    df = spark.createDataFrame([(i % 3, i * 7 % 50 - 10 if i % 11 else None, float(i)) for i in range(1000)], "g long, k long, x double")
    bits = SK.bitmap_state(df, ["g"], "k")
    assert SK.bitmap_distinct(SK.merge_bitmaps(bits)).first()[0] == df.select("k").dropna().distinct().count()
    assert {r["g"]: r["distintos"] for r in SK.bitmap_distinct(bits, ["g"]).collect()} == {r["g"]: r["n"] for r in df.groupBy("g").agg(F.count_distinct("k").alias("n")).collect()}
    assert abs(SK.hll_distinct(SK.hll_state(df, ["g"], "k")).first()[0] - 50) <= 2
    q = SK.kll_quantiles(SK.merge_kll(SK.kll_state(df, ["g"], "x")), {"m": 0.5}).first()
    assert q["n"] == 1000 and abs(q["m"] - 500) < 20
    assert SK.kll_quantiles(SK.kll_state(df.filter("g > 5"), ["g"], "x"), {"m": 0.5}).count() == 0
    assert SK.bitmap_distinct(SK.bitmap_state(df.filter("g > 5"), [], "k")).first()[0] == 0
