"""Descriptions of tables and columns, written to the catalog with each table, and the additivity of every measure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_COMMENTS = {
    "_manifesto_ingestao": "Landed files: origin, path, size and time of each.",
    "balanco_energia_subsistema": "Hourly balance as published, all text. Rows with id SIN are the national total.",
    "ear_diario_subsistema": "Daily stored energy as published, all text.",
    "restricao_coff_eolica": "Half-hourly curtailment of wind plants as published, all text.",
    "restricao_coff_fotovoltaica": "Half-hourly curtailment of solar plants as published, all text.",
    "capacidade_geracao": "Generating units as published, all text.",
    "balanco_subsistema_horario": "One row per subsystem and hour, typed. Leave out eh_agregado rows when summing.",
    "ear_subsistema_diario": "One row per subsystem and day, typed.",
    "restricao_coff_usina": "One row per plant, half hour and source, typed, with the energy not generated for a declared reason.",
    "capacidade_instalada_ug": "One row per generating unit, typed.",
    "dim_data": "Calendar covering the dates of all facts.",
    "dim_hora": "The 24 hours: day part, peak hours, solar hours.",
    "dim_subsistema": "Subsystems of the grid and the national total.",
    "dim_fonte_geracao": "Energy sources and their nature.",
    "dim_usina": "Plants with readings: latest attributes, and installed power where the registry code matches.",
    "fato_geracao_horaria": "Generation by subsystem, hour and source.",
    "fato_balanco_horario": "Load, generation, net load and exchange by subsystem and hour.",
    "fato_restricao_horaria": "Curtailment by plant and hour, split by reason and origin.",
    "fato_reservatorio_diario": "Stored energy by subsystem and day. A stock: not summed over time.",
    "qualidade_perfil_atributos": "Completeness of every bronze attribute.",
}

# How a measure may be combined: additive over everything, semi-additive (not over time), or a ratio to recompute.
ADDITIVE, SEMI_ADDITIVE, RATIO = "aditiva", "semiaditiva", "razão"
ADDITIVITY = {
    "fato_geracao_horaria": {"geracao_mwmed": ADDITIVE, "geracao_mwh": ADDITIVE},
    "fato_balanco_horario": {
        "carga_mwmed": ADDITIVE, "ger_total_mwmed": ADDITIVE, "ger_intermitente_mwmed": ADDITIVE, "carga_liquida_mwmed": ADDITIVE,
        "intercambio_mwmed": ADDITIVE, "pct_intermitente_sobre_carga": RATIO,
    },
    "fato_restricao_horaria": {
        **{f"corte_{k}mwh": ADDITIVE for k in ("", "rel_", "cnf_", "ene_", "par_", "sis_", "loc_")},
        "geracao_mwh": ADDITIVE, "geracao_referencia_mwh": ADDITIVE, "gnra_oficial_mwh": ADDITIVE,
        "intervalos_com_restricao": ADDITIVE, "intervalos_no_periodo": ADDITIVE, "taxa_corte_pct": RATIO,
    },
    "fato_reservatorio_diario": {
        "ear_verificada_mwmes": SEMI_ADDITIVE, "ear_maxima_mwmes": SEMI_ADDITIVE, "ear_percentual": RATIO,
    },
}

_KEYS = {
    "sk_data": "Day as yyyyMMdd; key of dim_data.", "sk_hora": "Hour 0-23; key of dim_hora.", "sk_subsistema": "Key of dim_subsistema.",
    "sk_fonte": "Key of dim_fonte_geracao.", "sk_usina": "Key of dim_usina.", "din_instante": "Start of the hour, wall clock.",
}
_MEASURES = {
    "geracao_mwmed": "mean generation of the hour, MW.", "geracao_mwh": "energy generated, MWh.", "carga_mwmed": "load, MW.",
    "ger_total_mwmed": "generation of all sources, MW.", "ger_intermitente_mwmed": "wind and solar generation, MW.",
    "carga_liquida_mwmed": "load less wind and solar, MW; may be negative.", "intercambio_mwmed": "net exchange, MW; positive exports.",
    "pct_intermitente_sobre_carga": "wind and solar as a percentage of load.", "corte_mwh": "energy curtailed, MWh.",
    "corte_rel_mwh": "curtailed for reason REL, MWh.", "corte_cnf_mwh": "curtailed for reason CNF, MWh.",
    "corte_ene_mwh": "curtailed for reason ENE, MWh.", "corte_par_mwh": "curtailed for reason PAR, MWh.",
    "corte_sis_mwh": "curtailed with systemic origin, MWh.", "corte_loc_mwh": "curtailed with local origin, MWh.",
    "geracao_referencia_mwh": "energy possible without restriction, MWh.", "gnra_oficial_mwh": "officially published energy not generated, MWh.",
    "intervalos_com_restricao": "half hours with a declared reason.", "intervalos_no_periodo": "half hours present; 2 when complete.",
    "taxa_corte_pct": "curtailed as a percentage of possible energy.", "ear_verificada_mwmes": "stored energy, MW-month.",
    "ear_maxima_mwmes": "storage capacity, MW-month.", "ear_percentual": "stored energy as a percentage of capacity.",
}
_OTHER = {
    "dim_data": {
        "data": "Date.", "ano": "Year.", "mes": "Month 1-12.", "nom_mes": "Name of the month.", "dia": "Day of the month.",
        "ano_mes": "yyyy-MM.", "trimestre": "Quarter.", "num_dia_semana": "Weekday, 1 is Sunday.", "nom_dia_semana": "Name of the weekday.",
        "eh_fim_semana": "Saturday or Sunday.", "dia_do_ano": "Day of the year.", "estacao_ano": "Season of the southern hemisphere.",
    },
    "dim_hora": {
        "hora": "Hour 0-23.", "hora_rotulo": "Hour as 00h to 23h.", "periodo_dia": "Part of the day.",
        "eh_horario_ponta": "Peak hours 18-20.", "eh_janela_solar": "Hours 6-18, in which the sun can shine.",
    },
    "dim_subsistema": {
        "id_subsistema": "Published id.", "nom_subsistema": "Short name.", "nom_subsistema_ons": "Published name.",
        "estados": "States covered.", "eh_agregado": "National total, not a subsystem.",
    },
    "dim_fonte_geracao": {
        "cod_fonte": "Code.", "nom_fonte": "Name.", "eh_renovavel": "Renewable.", "eh_despachavel": "Can be dispatched.",
        "eh_intermitente": "Depends on wind or sun.", "coluna_origem": "Published column the source comes from.",
    },
    "dim_usina": {
        "id_ons": "Published plant id.", "nom_usina": "Name in the latest reading.", "ceg": "Registry code; NULL for groups of plants.",
        "cod_fonte": "Source code.", "nom_fonte": "Source name.", "id_estado": "State.", "nom_estado": "Name of the state.",
        "id_subsistema": "Subsystem.", "potencia_instalada_mw": "Installed power of active units with the same registry code, MW.",
        "qtd_unidades_geradoras": "Units summed.", "dat_entrada_operacao": "First unit in operation.",
        "disponibilidade_maxima_mwmed": "Highest availability seen, MW.", "tem_cadastro_capacidade": "Registry code matched.",
        "primeiro_registro": "First reading.", "ultimo_registro": "Last reading.",
    },
    "fato_balanco_horario": {"carga_liquida_negativa": "Wind and solar exceed load."},
    "fato_restricao_horaria": {
        "cod_razao_predominante": "Most frequent reason of the hour; for reading, not for summing.",
        "houve_restricao_na_hora": "Some half hour had a declared reason.",
    },
    "fato_reservatorio_diario": {"dat_referencia": "Date of the measurement.", "faixa_armazenamento": "Band of the stored percentage."},
}


def _comments(table: str) -> dict[str, str]:
    measures = {c: f"[{kind}] {_MEASURES[c]}" for c, kind in ADDITIVITY.get(table, {}).items()}
    return {**_KEYS, **measures, **_OTHER.get(table, {})}


COLUMN_COMMENTS = {t: _comments(t) for t in TABLE_COMMENTS if t.startswith(("dim_", "fato_"))}


def documentation(spark: SparkSession) -> DataFrame:
    """The descriptions as data."""
    rows = [(t, None, text) for t, text in TABLE_COMMENTS.items()]
    rows += [(t, c, text) for t, cs in COLUMN_COMMENTS.items() for c, text in cs.items()]
    return spark.createDataFrame(rows, "tabela string, coluna string, descricao string")


def require_additive(table: str, measures, over_time=True) -> None:
    """Raises if a report would sum a measure that must not be summed that way."""
    for m in measures:
        kind = ADDITIVITY.get(table, {}).get(m, ADDITIVE)
        if kind == RATIO or (kind == SEMI_ADDITIVE and over_time):
            raise ValueError(f"{table}.{m} is {kind}: it cannot be summed{' over time' if kind == SEMI_ADDITIVE else ''}")
