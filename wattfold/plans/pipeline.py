"""Runs the layers in order: files to bronze, silver, gold and quality tables. These functions start jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattfold.config import BUSINESS_KEYS, HEADERS, Layers, PERIODICITY, Period
from wattfold.operators.conform import accepted, dedupe, reject_counts, reject_reason
from wattfold.plans import dims, facts, keys, quality, silver
from wattfold.plans.documentation import COLUMN_COMMENTS, TABLE_COMMENTS
from wattfold.plans.guard import guarded_load
from wattfold.plans.reports import Star
from wattfold.session import tune
from wattfold.sources import landing as landings
from wattfold.sources.bronze import CONTROL_COLUMNS, read_bronze
from wattfold.sources.files import file_status, list_files, manifest, selected_files
from wattfold.sources.shared import checkpointed
from wattfold.sources.tables import observed, scan, write_table


def _documented(df: DataFrame, layer: str, name: str, **options) -> dict:
    comments = {c: t for c, t in COLUMN_COMMENTS.get(name, {}).items() if c in df.columns}
    return write_table(df, f"{layer}.{name}", TABLE_COMMENTS.get(name, ""), comments, **options)


def create_layers(spark: SparkSession, layers: Layers = Layers()) -> None:
    for name in (layers.bronze, layers.silver, layers.gold):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def run_manifest(spark: SparkSession, landing: str, layers: Layers = Layers(), period: Period = Period()) -> dict:
    """Records the landed files of the window in ``_manifesto_ingestao``, marking those already recorded.

    ``_situacao_arquivos`` says of every landed file whether it is loaded, and if not, why.
    """
    table = f"{layers.bronze}._manifesto_ingestao"
    landed = list_files(spark, landing)
    _documented(file_status(landed, period), layers.bronze, "_situacao_arquivos")
    files = selected_files(landed, period)
    known = None
    if spark.catalog.tableExists(table):
        # the old rows must outlive the table they are in, which is replaced below
        known = checkpointed(spark.table(table).select("caminho_volume", "bytes"))
    return _documented(manifest(files, known), layers.bronze, "_manifesto_ingestao")


def run_bronze(spark: SparkSession, landing: str, layers: Layers = Layers(), period: Period = Period()) -> dict[str, int]:
    """Full refresh of the bronze tables from the files of the window; returns rows per table."""
    rows = {}
    listed = selected_files(list_files(spark, landing), period)
    for name in PERIODICITY:
        # one path per landed file: a listing bounded by the number of files, not of rows
        paths = sorted(r.path for r in listed.filter(F.col("dataset") == name).select("path").toLocalIterator())
        if paths:
            df = read_bronze(spark, paths, name, HEADERS[name])
            rows[name] = _documented(df, layers.bronze, name)["linhas"]
    return rows


def run_landing(spark: SparkSession, landing: str, store: str, layers: Layers = Layers(), period: Period = Period()) -> dict[str, int]:
    """Lands the files that are new since the last run and sets the bronze tables to the window's rows of all landed files.

    ``store`` is a folder that outlives the run: it holds, for each dataset, landed rows, manifest and checkpoint. Files already
    landed are not read again. Returns rows per bronze table.
    """
    rows = {}
    for name, periodicity in PERIODICITY.items():
        if not landings.exists(spark, f"{landing}/{name}"):
            continue
        target = f"{store}/{name}"
        landings.land(spark, landing, name, HEADERS[name], target, periodicity)
        if landings.exists(spark, f"{target}/linhas"):
            landed = landings.landed_rows(spark, target, periodicity, period).select(*HEADERS[name], *CONTROL_COLUMNS)
            rows[name] = _documented(landed, layers.bronze, name)["linhas"]
    return rows


def typed_tables(spark: SparkSession, layers: Layers = Layers()) -> dict[str, tuple]:
    """Silver table name to typed frame, reject rules and business key."""
    b = lambda name: scan(spark, layers.bronze, name)
    tables = {
        "balanco_subsistema_horario": (silver.typed_balance(b("balanco_energia_subsistema")), silver.no_instant(), silver.BALANCE_KEY),
        "ear_subsistema_diario": (silver.typed_storage(b("ear_diario_subsistema")), silver.no_date(), silver.STORAGE_KEY),
        "restricao_coff_usina": (
            silver.typed_curtailment(b("restricao_coff_eolica"), b("restricao_coff_fotovoltaica")), silver.no_instant(), silver.CURTAILMENT_KEY,
        ),
        "capacidade_instalada_ug": (silver.typed_capacity(b("capacidade_geracao")), silver.no_power(), silver.CAPACITY_KEY),
    }
    return {name: (typed, silver.no_key(rules, key), key) for name, (typed, rules, key) in tables.items()}


def run_silver(spark: SparkSession, layers: Layers = Layers(), refuse_above_pct: float | None = None, quarantine: str | None = None) -> dict[str, dict]:
    """Writes the silver tables. Rows read, rejected and kept come from the write itself: one run per table.

    A row counts for the first rule it breaks; ``chave_ausente`` is stated where it rejects a row. With ``refuse_above_pct`` a
    table of which more rows are rejected keeps what it holds, and rejected rows go to folders under ``quarantine``.
    """
    if refuse_above_pct is not None and quarantine is None:
        raise ValueError("name a quarantine folder for the rejected rows")
    result = {}
    for name, (typed, rules, key) in typed_tables(spark, layers).items():
        if refuse_above_pct is not None:
            latest, written = [c for c in silver.LATEST if c in typed.columns], {}
            replace = lambda good, k=key, l=latest, n=name, w=written: w.update(_documented(dedupe(good, k, l), layers.silver, n))
            result[name] = {**guarded_load(typed, name, rules, replace, f"{quarantine}/{name}", refuse_above_pct), **written}
            continue
        why = reject_reason(rules)
        counts = {"linhas_lidas": F.count(F.lit(1)), **{r: F.count_if(F.coalesce(why == r, F.lit(False))) for r in rules}}
        watched, watch = observed(typed, f"read_{name}", counts)
        latest = [c for c in silver.LATEST if c in typed.columns]
        written = _documented(dedupe(accepted(watched, rules), key, latest), layers.silver, name)
        seen = watch.get
        rejected = sum(seen[r] for r in rules)
        shown = {k: n for k, n in seen.items() if n or k != "chave_ausente"}
        result[name] = {**shown, **written, "duplicatas_removidas": seen["linhas_lidas"] - rejected - written["linhas"]}
    return result


def silver_rejects(spark: SparkSession, layers: Layers = Layers()) -> DataFrame:
    """Reject counts of every silver table as data."""
    return quality.stack([
        reject_counts(typed, rules).select(F.lit(name).alias("tabela"), "medida", "linhas")
        for name, (typed, rules, _) in typed_tables(spark, layers).items()
    ])


def run_gold(spark: SparkSession, layers: Layers = Layers(), partition_facts=False) -> dict[str, int]:
    """Writes dimensions and facts. ``partition_facts`` lays facts out by day, so that date filters prune files."""
    s = lambda name: scan(spark, layers.silver, name)
    balance, storage = s("balanco_subsistema_horario"), s("ear_subsistema_diario")
    readings, units = s("restricao_coff_usina"), s("capacidade_instalada_ug")
    dimensions = {
        "dim_data": dims.calendar_dim([
            balance.select("din_instante"), storage.select("dat_referencia"), readings.select("din_instante")
        ]),
        "dim_hora": dims.hour_dim(spark),
        "dim_subsistema": dims.subsystem_dim(spark),
        "dim_fonte_geracao": dims.source_dim(spark),
        "dim_usina": dims.plant_dim(readings, units),
    }
    fact_frames = {
        "fato_geracao_horaria": facts.generation_fact(balance),
        "fato_balanco_horario": facts.balance_fact(balance),
        "fato_restricao_horaria": facts.curtailment_fact(readings),
        "fato_reservatorio_diario": facts.storage_fact(storage),
    }
    rows = {name: _documented(df, layers.gold, name)["linhas"] for name, df in dimensions.items()}
    by = ["sk_data"] if partition_facts else []
    rows.update({name: _documented(df, layers.gold, name, partition_by=by)["linhas"] for name, df in fact_frames.items()})
    return rows


def load_star(spark: SparkSession, layers: Layers = Layers()) -> Star:
    return Star(**{name: scan(spark, layers.gold, name) for name in Star.__dataclass_fields__})


def run_quality(spark: SparkSession, layers: Layers = Layers()) -> dict:
    """Writes the completeness profile of every bronze attribute."""
    tables = {name: scan(spark, layers.bronze, name) for name in HEADERS}
    profiled = quality.profile_tables(tables).withColumn("_perfilado_em", F.current_timestamp())
    return _documented(profiled, layers.gold, "qualidade_perfil_atributos")


def check_model(spark: SparkSession, layers: Layers = Layers()) -> dict[str, DataFrame]:
    """Key checks of bronze and gold, and the plausibility rules, as frames."""
    bronze = {name: scan(spark, layers.bronze, name) for name in HEADERS}
    gold = {name: scan(spark, layers.gold, name) for name in Star.__dataclass_fields__}
    s = lambda name: scan(spark, layers.silver, name)
    return {
        "unicidade": keys.check_uniqueness(bronze, BUSINESS_KEYS),
        "chaves_primarias": keys.check_primary_keys(gold),
        "chaves_estrangeiras": keys.check_foreign_keys(gold),
        "conversao": quality.cast_loss_tables(bronze),
        "plausibilidade": quality.plausibility(
            s("balanco_subsistema_horario"), s("ear_subsistema_diario"), s("restricao_coff_usina")
        ),
    }


def run(spark: SparkSession, landing: str, layers: Layers = Layers(), period: Period = Period(), partition_facts=False) -> dict:
    """Everything, in order."""
    tune(spark)
    create_layers(spark, layers)
    return {
        "manifesto": run_manifest(spark, landing, layers, period),
        "bronze": run_bronze(spark, landing, layers, period),
        "silver": run_silver(spark, layers),
        "gold": run_gold(spark, layers, partition_facts),
        "qualidade": run_quality(spark, layers),
    }
