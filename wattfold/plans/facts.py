"""The four facts, at three grains."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattfold.config import ORIGINS, REASONS, SOURCE_COLUMNS, STORAGE_BANDS
from wattfold.functions.measures import band, date_key, guarded_pct
from wattfold.operators.aggregate import fan_out, most_frequent, rollup_hours, unpivot_measures


def without_totals(df: DataFrame) -> DataFrame:
    """Rows of real subsystems; total rows, and rows whose subsystem is unknown, are left out."""
    return df.filter(~F.col("eh_agregado"))


def generation_fact(balance: DataFrame) -> DataFrame:
    """Subsystem × hour × source."""
    long = unpivot_measures(
        without_totals(balance), ["id_subsistema", "din_instante"], SOURCE_COLUMNS, "cod_fonte", "geracao_mwmed"
    )
    power = F.round("geracao_mwmed", 4)
    return long.select(
        date_key("din_instante").alias("sk_data"),
        F.hour("din_instante").alias("sk_hora"),
        F.col("id_subsistema").alias("sk_subsistema"),
        F.col("cod_fonte").alias("sk_fonte"),
        "din_instante",
        power.alias("geracao_mwmed"),
        power.alias("geracao_mwh"),
    )


def balance_fact(balance: DataFrame) -> DataFrame:
    """Subsystem × hour: load, generation, net load and exchange."""
    rounded = ["carga_mwmed", "ger_total_mwmed", "ger_intermitente_mwmed", "carga_liquida_mwmed", "intercambio_mwmed"]
    return without_totals(balance).select(
        date_key("din_instante").alias("sk_data"),
        F.hour("din_instante").alias("sk_hora"),
        F.col("id_subsistema").alias("sk_subsistema"),
        "din_instante",
        *[F.round(c, 4).alias(c) for c in rounded],
        "pct_intermitente_sobre_carga",
        (F.round("carga_liquida_mwmed", 4) < 0).alias("carga_liquida_negativa"),
    )


def curtailment_fact(readings: DataFrame) -> DataFrame:
    """Plant × hour from half-hour readings. Each half hour's energy goes to its own reason and origin."""
    hourly = rollup_hours(
        readings, ["id_ons", "cod_fonte", "id_subsistema"], "din_instante", "hora_cheia",
        [
            *[F.round(F.sum(m), 6).alias(m) for m in ("corte_mwh", "geracao_mwh", "geracao_referencia_mwh")],
            F.count_if("houve_restricao").alias("intervalos_com_restricao"),
            F.count("*").alias("intervalos_no_periodo"),
            *fan_out("cod_razao_restricao", list(REASONS), "corte_mwh", "corte_%s_mwh"),
            *fan_out("cod_origem_restricao", list(ORIGINS), "corte_mwh", "corte_%s_mwh"),
            F.round(F.sum("gnra_oficial_mwh"), 6).alias("gnra_oficial_mwh"),
            most_frequent("cod_razao_restricao").alias("cod_razao_predominante"),
        ],
    )
    measures = [c for c in hourly.columns if c not in ("id_ons", "cod_fonte", "id_subsistema", "hora_cheia")]
    return hourly.select(
        date_key("hora_cheia").alias("sk_data"),
        F.hour("hora_cheia").alias("sk_hora"),
        F.col("id_ons").alias("sk_usina"),
        F.col("id_subsistema").alias("sk_subsistema"),
        F.col("cod_fonte").alias("sk_fonte"),
        F.col("hora_cheia").alias("din_instante"),
        *measures,
        (F.col("intervalos_com_restricao") > 0).alias("houve_restricao_na_hora"),
        guarded_pct("corte_mwh", "geracao_referencia_mwh").alias("taxa_corte_pct"),
    )


def storage_fact(storage: DataFrame) -> DataFrame:
    """Subsystem × day: a stock, summed across subsystems but averaged over time."""
    level = F.round("ear_percentual", 4)
    return without_totals(storage).select(
        date_key("dat_referencia").alias("sk_data"),
        F.col("id_subsistema").alias("sk_subsistema"),
        "dat_referencia",
        F.round("ear_verificada_mwmes", 4).alias("ear_verificada_mwmes"),
        F.round("ear_maxima_mwmes", 4).alias("ear_maxima_mwmes"),
        level.alias("ear_percentual"),
        band(level, *STORAGE_BANDS).alias("faixa_armazenamento"),
    )
