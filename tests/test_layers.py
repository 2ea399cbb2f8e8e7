"""What the layers behind reports and checks write."""

import os
import time

import pytest

import __spark_entry__ as E
from checks import layers
from checks.standin import bronze
from wattfold.operators.conform import dedupe
from wattfold.plans import silver

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def at(tmp_path_factory):
    """The given tables by a path of their own, so that no layer of them is written yet."""
    os.symlink(SF_DIR, path := f"{tmp_path_factory.mktemp('tables')}/in")
    return path


@pytest.mark.parametrize("name", ["report_negative_hours", "report_monthly_rate", "reconciliation", "official_without_reason", "presence_by_category", "gold_foreign_keys"])
def test_the_whole_table_of_readings_is_not_written(spark, at, name):
    assert E.queries()[name](spark, at).collect()
    written = {table: path for (_, d, table), path in layers._written.items() if d == at}
    assert "s_restricao" not in written and spark.read.parquet(written["s_restricao_chaves"]).columns == ["resumo"]
    if "s_restricao_repetidas" in written:  # whole rows are written of repeated keys only
        assert spark.read.parquet(written["s_restricao_repetidas"]).count() < 0.01 * layers.readings(spark, at).count()


def test_readings_are_those_that_a_whole_deduplication_keeps(spark):
    wind, solar = (bronze(spark, SF_DIR, f"restricao_coff_{kind}") for kind in ("eolica", "fotovoltaica"))
    for twice in (False, True):
        if twice:  # every key repeats
            wind, solar = wind.unionAll(wind), solar.unionAll(solar)
        want = dedupe(silver.accepted_curtailment(wind, solar), silver.CURTAILMENT_KEY, silver.LATEST)
        got = silver.silver_curtailment(wind, solar)
        assert got.dtypes == want.dtypes and got.count() == want.count() and got.exceptAll(want).count() == 0


def test_a_layer_leaves_no_shuffle_files(spark, tmp_path):
    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]

    def shuffled():
        return {f for top in folders for _, _, files in os.walk(top) for f in files if f.startswith("shuffle_")}

    os.symlink(SF_DIR, tmp_path / "in")
    before = shuffled()
    layers.read(spark, f"{tmp_path}/in", "s_restricao_chaves")
    left = shuffled() - before
    for _ in range(50):  # files are removed a moment later
        if not (left := left & shuffled()):
            break
        time.sleep(0.2)
    assert not left
