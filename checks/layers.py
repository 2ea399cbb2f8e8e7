"""Silver and gold tables over the stand-ins.

As in the pipeline, a layer is written once and read by everything after it: the first query that needs a table builds
it in the shared folder, later ones scan it. A table is built only from the tables it depends on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks.standin import DATASETS, bronze
from wattfold.plans import dims, facts, silver
from wattfold.plans.reports import Star
from wattfold.session import tune
from wattfold.sources.shared import shared_folder

#: With it a write removes its shuffle files when it ends, instead of when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: dict[tuple[str, str, str], str] = {}


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: bronze(spark, sf_dir, name) for name in DATASETS}


def build_balance(spark, d):
    return silver.silver_balance(bronze(spark, d, "balanco_energia_subsistema"))


def build_storage(spark, d):
    return silver.silver_storage(bronze(spark, d, "ear_diario_subsistema"))


def _readings(spark, d):
    return bronze(spark, d, "restricao_coff_eolica"), bronze(spark, d, "restricao_coff_fotovoltaica")


def build_curtailment(spark, d):
    return silver.silver_curtailment(*_readings(spark, d))


def readings(spark, d):
    """The rows of s_restricao for a step that reads a few of its columns once: these are computed, the table is not written."""
    return silver.silver_curtailment(*_readings(spark, d), read(spark, d, "s_restricao_chaves"), read(spark, d, "s_restricao_repetidas"))


def build_capacity(spark, d):
    return silver.silver_capacity(bronze(spark, d, "capacidade_geracao"))


def build_calendar(spark, d):
    return dims.calendar_dim([
        read(spark, d, "s_balanco").select("din_instante"), read(spark, d, "s_ear").select("dat_referencia"),
        silver.silver_curtailment(*_readings(spark, d), read(spark, d, "s_restricao_chaves")).select("din_instante"),
    ])


def build_plants(spark, d):
    return dims.plant_dim(readings(spark, d), read(spark, d, "s_capacidade"))


BUILDERS = {
    "s_balanco": build_balance,
    "s_ear": build_storage,
    "s_restricao_chaves": lambda s, d: silver.repeated_readings(*_readings(s, d)),
    "s_restricao_repetidas": lambda s, d: silver.latest_repeated(*_readings(s, d), read(s, d, "s_restricao_chaves")),
    "s_restricao": build_curtailment,
    "s_capacidade": build_capacity,
    "dim_data": build_calendar,
    "dim_usina": build_plants,
    "fato_geracao_horaria": lambda s, d: facts.generation_fact(read(s, d, "s_balanco")),
    "fato_balanco_horario": lambda s, d: facts.balance_fact(read(s, d, "s_balanco")),
    "fato_restricao_horaria": lambda s, d: facts.curtailment_fact(readings(s, d)),
    "fato_reservatorio_diario": lambda s, d: facts.storage_fact(read(s, d, "s_ear")),
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A layer table, written on first use."""
    where = (spark.sparkContext.applicationId, sf_dir, name)
    if where not in _written:
        path = shared_folder(tune(spark))
        frame = BUILDERS[name](spark, sf_dir)
        kept = spark.conf.get(CLEANUP)
        spark.conf.set(CLEANUP, "true")
        try:
            frame.write.option("compression", "zstd").parquet(path)
        finally:
            spark.conf.set(CLEANUP, kept)
        _written[where] = path
    return spark.read.parquet(_written[where])


class LazyStar:
    """A :class:`Star` whose tables are built only when a report reads them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._at = (spark, sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        spark, sf_dir = self._at
        fixed = {"dim_hora": dims.hour_dim, "dim_subsistema": dims.subsystem_dim, "dim_fonte_geracao": dims.source_dim}
        if name in fixed:
            return fixed[name](spark)
        if name in Star.__dataclass_fields__:
            return read(spark, sf_dir, name)
        raise AttributeError(name)


def star(spark: SparkSession, sf_dir: str) -> Star:
    return LazyStar(spark, sf_dir)


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    s = star(spark, sf_dir)
    return {name: getattr(s, name) for name in Star.__dataclass_fields__}
