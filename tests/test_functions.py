"""Column functions on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from wattfold.config import CORRELATION_BANDS, REASONS, SENTINELS, STORAGE_BANDS
from wattfold.functions import clean as C, measures as M
from wattfold.operators.stats import correlation_label


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_sentinels_alone_and_padded_become_null(spark):
    values = SENTINELS + [f"  {s} " for s in SENTINELS] + ["n/a", "Null", " x "]
    assert column(spark, values, C.clean_text("c")) == [None] * 14 + ["n/a", "Null", "x"]


def test_decimal(spark):
    got = column(spark, ["1,234.5", " 7 ", "1,5", "abc", "NaN", "-", None, "1e3"], C.clean_decimal("c"))
    assert got == [1234.5, 7.0, 15.0, None, None, None, None, 1000.0]
    assert column(spark, ["1.234,5", "1,5"], C.clean_decimal("c", decimal=",")) == [1234.5, 1.5]


def test_int_truncates(spark):
    assert column(spark, ["30.9", "-1.9", "x", ""], C.clean_int("c")) == [30, -1, None, None]


def test_timestamps_and_dates(spark):
    good = dt.datetime(2025, 1, 31, 23, 30)
    values = ["2025-01-31 23:30:00", " 2025-01-31 23:30:00 ", "2025-02-30 00:00:00", "2025-01-31", "31/01/2025", "-", None]
    assert column(spark, values, C.clean_timestamp("c")) == [good, good, None, None, None, None, None]
    assert column(spark, ["31/01/2025 23:30"], C.clean_timestamp("c", "dd/MM/yyyy HH:mm")) == [good]
    assert column(spark, ["2025-01-31", "2025-02-30", "x", ""], C.clean_date("c")) == [dt.date(2025, 1, 31), None, None, None]


def test_wall_clock_survives_a_session_zone_with_summer_time(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # midnight did not exist on 2018-11-04 in this zone
        got = column(spark, ["2018-11-04 00:00:00"], M.hour_start(C.clean_timestamp("c")).cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2018-11-04 00:00:00"]


def test_text_helpers(spark):
    assert column(spark, [None, " a "], C.visible_null("c")) == ["<nulo>", "a"]
    assert column(spark, ["a\nb", "ab"], C.has_newline("c")) == [True, False]
    assert column(spark, ["a \n\t b"], C.collapse_whitespace("c")) == ["a b"]
    assert column(spark, ["abc  def"], C.collapse_whitespace("c", 5)) == ["abc d"]


def test_shortfall_rules(spark):
    rows = [(10.0, 4.0, "ENE"), (4.0, 10.0, "ENE"), (10.0, 4.0, None), (None, 4.0, "REL"), (10.0, None, "REL")]
    df = spark.createDataFrame(rows, "ref double, act double, why string")
    got = [r[0] for r in df.select(M.shortfall("ref", "act", "why")).collect()]
    assert got == [6.0, 0.0, 0.0, 0.0, 0.0]


def test_guards_and_energy(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 0.0), (1.0, None), (1.0, -2.0)], "a double, b double")
    got = [tuple(r) for r in df.select(M.guarded_pct("a", "b"), M.ratio_pct(F.col("a"), F.col("b"))).collect()]
    assert got == [(33.3333, 100 / 3), (None, None), (None, None), (None, -50.0)]
    assert column(spark, [5.0], M.to_energy("c"), "double") == [2.5]
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(M.null_as_zero_sum("a", "b")).collect()] == [1.0, 0.0]


def test_bands_take_the_lower_bound_and_keep_null(spark):
    got = column(spark, [29.99, 30.0, 50.0, 70.0, None], M.band("c", *STORAGE_BANDS), "double")
    assert got == ["Crítico (<30%)", "Baixo (30-50%)", "Confortável (50-70%)", "Alto (>70%)", None]
    assert column(spark, [-0.05, 0.1, -0.3, 0.5, 0.9], correlation_label(F.col("c")), "double") == [
        *[t for _, t in CORRELATION_BANDS[0]], CORRELATION_BANDS[1]]


def test_labels_and_keys(spark):
    assert column(spark, ["PAR", "XXX", None], M.label("c", REASONS)) == ["Parecer de acesso", None, None]
    assert column(spark, [dt.date(2025, 1, 31)], M.date_key("c"), "date") == [20250131]


def test_decimals_refuse_what_is_no_plain_number(spark):
    texts = ["Infinity", "inf", "+Inf", "NaN", "1d", "1.5f", "1e400x", "1,234.5", "-.5", "7.", "+2e3"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(C.clean_decimal("t")).collect()]
    assert got == [None] * 7 + [1234.5, -0.5, 7.0, 2000.0]


def test_hours_keep_rows_without_a_time(spark):
    df = spark.sql("select * from values (timestamp_ntz'2025-03-30 02:59:59.999'), (cast(null as timestamp_ntz)) as t(x)")
    got = df.groupBy(M.hour_start("x").alias("h")).count().collect()
    assert sorted((str(r["h"]), r["count"]) for r in got) == [("2025-03-30 02:00:00", 1), ("None", 1)]
