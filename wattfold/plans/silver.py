"""Bronze text to typed, deduplicated silver tables, one declared grain each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from wattfold.config import HALF_HOUR, ORIGINS, REASONS, TOTAL_ROW
from wattfold.functions.measures import guarded_pct, label, null_as_zero_sum, shortfall, to_energy
from wattfold.operators.conform import accepted, apart, conform, dedupe, repeated_keys, union_conformed

CONTROL = ("_source_file", "_ingest_ts")
LATEST = ("_ingest_ts", "_source_file")

BALANCE_SPEC = [
    ("id_subsistema", "id_subsistema", "text"),
    ("nom_subsistema", "nom_subsistema_origem", "text"),
    ("din_instante", "din_instante", "timestamp"),
    ("val_gerhidraulica", "ger_hidraulica_mwmed", "decimal"),
    ("val_gertermica", "ger_termica_mwmed", "decimal"),
    ("val_gereolica", "ger_eolica_mwmed", "decimal"),
    ("val_gersolar", "ger_solar_mwmed", "decimal"),
    ("val_carga", "carga_mwmed", "decimal"),
    ("val_intercambio", "intercambio_mwmed", "decimal"),
]
STORAGE_SPEC = [
    ("id_subsistema", "id_subsistema", "text"),
    ("ear_data", "dat_referencia", "date"),
    ("ear_max_subsistema", "ear_maxima_mwmes", "decimal"),
    ("ear_verif_subsistema_mwmes", "ear_verificada_mwmes", "decimal"),
    ("ear_verif_subsistema_percentual", "ear_percentual", "decimal"),
]
CURTAILMENT_SPEC = [
    ("id_subsistema", "id_subsistema", "text"),
    ("id_estado", "id_estado", "text"),
    ("nom_estado", "nom_estado", "text"),
    ("nom_usina", "nom_usina", "text"),
    ("id_ons", "id_ons", "text"),
    ("ceg", "ceg", "text"),
    ("din_instante", "din_instante", "timestamp"),
    ("val_geracao", "geracao_mwmed", "decimal"),
    ("val_geracaolimitada", "geracao_limitada_mwmed", "decimal"),
    ("val_disponibilidade", "disponibilidade_mwmed", "decimal"),
    ("val_geracaoreferencia", "geracao_referencia_mwmed", "decimal"),
    ("val_geracaoreferenciafinal", "geracao_referencia_final_mwmed", "decimal"),
    ("cod_razaorestricao", "cod_razao_restricao", "text"),
    ("cod_origemrestricao", "cod_origem_restricao", "text"),
    ("dsc_restricao", "dsc_restricao", "text"),
    ("id_pontoconexao", "id_ponto_conexao", "text"),
    ("nom_pontoconexao", "nom_ponto_conexao", "text"),
    ("nom_agenteoperador", "nom_agente_operador", "text"),
    ("val_geracaonaorealizadaapurada", "gnra_oficial_mwmed", "decimal"),
    ("num_minutos_rel", "num_minutos_rel", "int"),
    ("num_minutos_cnf", "num_minutos_cnf", "int"),
    ("num_minutos_ene", "num_minutos_ene", "int"),
    ("num_minutos_restricao", "num_minutos_restricao", "int"),
]
CAPACITY_SPEC = [
    ("id_subsistema", "id_subsistema", "text"),
    ("id_estado", "id_estado", "text"),
    ("nom_estado", "nom_estado", "text"),
    ("nom_tipousina", "nom_tipo_usina", "text"),
    ("nom_usina", "nom_usina", "text"),
    ("ceg", "ceg", "text"),
    ("nom_combustivel", "nom_combustivel", "text"),
    ("nom_agenteproprietario", "nom_agente_proprietario", "text"),
    ("cod_equipamento", "cod_equipamento", "text"),
    ("dat_entradaoperacao", "dat_entrada_operacao", "date"),
    ("dat_desativacao", "dat_desativacao", "date"),
    ("val_potenciaefetiva", "potencia_efetiva_mw", "decimal"),
]
BALANCE_KEY = ["id_subsistema", "din_instante"]
STORAGE_KEY = ["id_subsistema", "dat_referencia"]
CURTAILMENT_KEY = ["id_ons", "din_instante", "cod_fonte"]
CAPACITY_KEY = ["cod_equipamento", "nom_usina"]


def no_instant() -> dict[str, Column]:
    return {"instante_invalido": F.col("din_instante").isNull()}


def no_date() -> dict[str, Column]:
    return {"data_invalida": F.col("dat_referencia").isNull()}


def no_power() -> dict[str, Column]:
    return {"potencia_ausente": F.col("potencia_efetiva_mw").isNull()}


def no_key(rules: Mapping[str, Column], key: Sequence[str]) -> dict[str, Column]:
    """The rules, and after them one for rows without a full business key, of which deduplication would keep one in all."""
    return {**rules, "chave_ausente": reduce(or_, [F.col(c).isNull() for c in key])}


def is_total() -> Column:
    return F.coalesce(F.col("id_subsistema") == TOTAL_ROW, F.lit(False))


def typed_balance(bronze: DataFrame) -> DataFrame:
    """Subsystem × hour before rejects and duplicates are removed; the national total row is flagged, not removed."""
    base = conform(bronze, BALANCE_SPEC, CONTROL)
    intermittent = null_as_zero_sum("ger_eolica_mwmed", "ger_solar_mwmed")
    return base.select(
        "*",
        is_total().alias("eh_agregado"),
        null_as_zero_sum("ger_hidraulica_mwmed", "ger_termica_mwmed", "ger_eolica_mwmed", "ger_solar_mwmed").alias(
            "ger_total_mwmed"
        ),
        intermittent.alias("ger_intermitente_mwmed"),
        (F.col("carga_mwmed") - intermittent).alias("carga_liquida_mwmed"),
        guarded_pct(intermittent, "carga_mwmed").alias("pct_intermitente_sobre_carga"),
    )


def typed_storage(bronze: DataFrame) -> DataFrame:
    base = conform(bronze, STORAGE_SPEC, CONTROL)
    return base.select("*", is_total().alias("eh_agregado"))


def typed_curtailment(wind: DataFrame, solar: DataFrame) -> DataFrame:
    """Plant × half hour of both sources, with the energy not generated for a declared reason."""
    base = union_conformed(
        conform(wind, CURTAILMENT_SPEC, CONTROL, {"cod_fonte": "EOL", "nom_fonte": "Eólica"}, once=CURTAILMENT_KEY[:2]),
        conform(solar, CURTAILMENT_SPEC, CONTROL, {"cod_fonte": "SOL", "nom_fonte": "Solar"}, once=CURTAILMENT_KEY[:2]),
    )
    cut = shortfall("geracao_referencia_mwmed", "geracao_mwmed", "cod_razao_restricao")
    return base.select(
        "*",
        F.col("cod_razao_restricao").isNotNull().alias("houve_restricao"),
        cut.alias("corte_mwmed"),
        to_energy(cut, HALF_HOUR).alias("corte_mwh"),
        to_energy("geracao_mwmed", HALF_HOUR).alias("geracao_mwh"),
        to_energy("geracao_referencia_mwmed", HALF_HOUR).alias("geracao_referencia_mwh"),
        to_energy("gnra_oficial_mwmed", HALF_HOUR).alias("gnra_oficial_mwh"),
        label("cod_razao_restricao", REASONS).alias("dsc_razao_restricao"),
        label("cod_origem_restricao", ORIGINS).alias("dsc_origem_restricao"),
    )


def typed_capacity(bronze: DataFrame) -> DataFrame:
    base = conform(bronze, CAPACITY_SPEC, ("_ingest_ts",))
    return base.select("*", F.col("dat_desativacao").isNull().alias("esta_ativa"))


def finish(typed: DataFrame, rejects: Mapping[str, Column], key: Sequence[str], latest_by=LATEST) -> DataFrame:
    """Drop rejects and rows without a full key, then keep the latest row per business key."""
    return dedupe(accepted(typed, no_key(rejects, key)), key, [c for c in latest_by if c in typed.columns])


def silver_balance(bronze: DataFrame) -> DataFrame:
    return finish(typed_balance(bronze), no_instant(), BALANCE_KEY)


def silver_storage(bronze: DataFrame) -> DataFrame:
    return finish(typed_storage(bronze), no_date(), STORAGE_KEY)


def accepted_curtailment(wind: DataFrame, solar: DataFrame) -> DataFrame:
    return accepted(typed_curtailment(wind, solar), no_key(no_instant(), CURTAILMENT_KEY))


def repeated_readings(wind: DataFrame, solar: DataFrame) -> DataFrame:
    """The :func:`repeated_keys` of the accepted readings."""
    return repeated_keys(accepted_curtailment(wind, solar), CURTAILMENT_KEY)


def latest_repeated(wind: DataFrame, solar: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """The part of :func:`silver_curtailment` that is shuffled: readings whose key repeats, and few others."""
    return dedupe(apart(accepted_curtailment(wind, solar), CURTAILMENT_KEY, repeated)[1], CURTAILMENT_KEY, LATEST)


def silver_curtailment(wind: DataFrame, solar: DataFrame, repeated: DataFrame | None = None, latest: DataFrame | None = None) -> DataFrame:
    """The largest and widest table, of whose keys few repeat: the other rows are not shuffled, and a step costs the columns that it reads.

    ``repeated`` and ``latest`` hold :func:`repeated_readings` and :func:`latest_repeated` where they are stored.
    """
    once, _ = apart(accepted_curtailment(wind, solar), CURTAILMENT_KEY, repeated)
    return once.unionByName(latest_repeated(wind, solar, repeated) if latest is None else latest)


def silver_capacity(bronze: DataFrame) -> DataFrame:
    return finish(typed_capacity(bronze), no_power(), CAPACITY_KEY)
