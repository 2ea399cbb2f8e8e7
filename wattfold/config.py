"""Fixed values of the grid configuration: names, code tables, bands and column contracts."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: texts the publisher uses for "no value" ------------------
SENTINELS = ["", "-", "--", "N/A", "NA", "null", "NULL"]

# --- fixed values: formats of the published files ---------------------------
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"

# --- fixed values: subsystem and source metadata ----------------------------
# (id, published name, short name, states, is the national total)
SUBSYSTEMS = [
    ("N", "NORTE", "Norte", "AC, AM, AP, PA, RO, RR, TO", False),
    ("NE", "NORDESTE", "Nordeste", "AL, BA, CE, MA, PB, PE, PI, RN, SE", False),
    ("SE", "SUDESTE/CENTRO-OESTE", "Sudeste/C.O.", "DF, ES, GO, MG, MS, MT, RJ, SP", False),
    ("S", "SUL", "Sul", "PR, RS, SC", False),
    ("SIN", "SISTEMA INTERLIGADO NACIONAL", "Brasil", "Agregado nacional", True),
]
TOTAL_ROW = "SIN"
# (code, name, published column, renewable, dispatchable, intermittent)
SOURCES = [
    ("HID", "Hidráulica", "val_gerhidraulica", True, True, False),
    ("TER", "Térmica", "val_gertermica", False, True, False),
    ("EOL", "Eólica", "val_gereolica", True, False, True),
    ("SOL", "Solar", "val_gersolar", True, False, True),
]
# silver column holding each source's mean power
SOURCE_COLUMNS = {
    "ger_hidraulica_mwmed": "HID",
    "ger_termica_mwmed": "TER",
    "ger_eolica_mwmed": "EOL",
    "ger_solar_mwmed": "SOL",
}
# --- fixed values: restriction reasons and origins --------------------------
REASONS = {
    "REL": "Indisponibilidade externa (elétrica)",
    "CNF": "Requisitos de confiabilidade",
    "ENE": "Razão energética",
    "PAR": "Parecer de acesso",
}
ORIGINS = {"SIS": "Sistêmica", "LOC": "Local"}
# --- fixed values: bands, upper bound exclusive, last label open -------------
STORAGE_BANDS = ([(30, "Crítico (<30%)"), (50, "Baixo (30-50%)"), (70, "Confortável (50-70%)")], "Alto (>70%)")
DAY_PARTS = ([(6, "Madrugada"), (12, "Manhã"), (18, "Tarde")], "Noite")
# southern hemisphere, by day of year; the last label wraps over the new year
SEASONS = ([(80, "Verão"), (172, "Outono"), (266, "Inverno"), (355, "Primavera")], "Verão")
CORRELATION_BANDS = (
    [(0.1, "praticamente inexistente"), (0.3, "fraca"), (0.5, "moderada"), (0.7, "forte")],
    "muito forte",
)
PEAK_HOURS = (18, 20)
SOLAR_HOURS = (6, 18)
MONTH_NAMES = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
WEEKDAY_NAMES = ["Domingo", "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado"]
# --- fixed values: report parameters -----------------------------------------
HALF_HOUR = 0.5
HOUSEHOLD_KWH_PER_MONTH = 160
RATE_FLOOR_MWH = 10_000
RECONCILE_TOLERANCE = 0.01
DESCRIPTION_WIDTH = 160

# --- fixed values: header of each published dataset ---------------------------
_CURTAILMENT_HEADER = (
    "id_subsistema nom_subsistema id_estado nom_estado nom_usina id_ons ceg din_instante val_geracao "
    "val_geracaolimitada val_disponibilidade val_geracaoreferencia val_geracaoreferenciafinal cod_razaorestricao "
    "cod_origemrestricao dsc_restricao id_pontoconexao nom_pontoconexao nom_agenteoperador "
    "val_geracaonaorealizadaapurada num_minutos_rel num_minutos_cnf num_minutos_ene num_minutos_restricao"
).split()
HEADERS = {
    "balanco_energia_subsistema": (
        "id_subsistema nom_subsistema din_instante val_gerhidraulica val_gertermica val_gereolica val_gersolar "
        "val_carga val_intercambio"
    ).split(),
    "ear_diario_subsistema": (
        "id_subsistema nom_subsistema ear_data ear_max_subsistema ear_verif_subsistema_mwmes "
        "ear_verif_subsistema_percentual"
    ).split(),
    "restricao_coff_eolica": _CURTAILMENT_HEADER,
    "restricao_coff_fotovoltaica": _CURTAILMENT_HEADER,
    "capacidade_geracao": (
        "id_subsistema nom_subsistema id_estado nom_estado nom_modalidadeoperacao nom_agenteproprietario "
        "nom_agenteoperador nom_tipousina nom_usina ceg nom_unidadegeradora cod_equipamento num_unidadegeradora "
        "nom_combustivel dat_entradateste dat_entradaoperacao dat_desativacao val_potenciaefetiva"
    ).split(),
}
# how the period is written in a dataset's file names
PERIODICITY = {
    "balanco_energia_subsistema": "yearly",
    "ear_diario_subsistema": "yearly",
    "restricao_coff_eolica": "monthly",
    "restricao_coff_fotovoltaica": "monthly",
    "capacidade_geracao": "single",
}
BUSINESS_KEYS = {
    "balanco_energia_subsistema": ["id_subsistema", "din_instante"],
    "ear_diario_subsistema": ["id_subsistema", "ear_data"],
    "restricao_coff_eolica": ["id_ons", "din_instante"],
    "restricao_coff_fotovoltaica": ["id_ons", "din_instante"],
    "capacidade_geracao": ["cod_equipamento", "nom_usina"],
}


@dataclass(frozen=True)
class Layers:
    """Database name of each layer."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"


@dataclass(frozen=True)
class Period:
    """Inclusive window of the files to load: years for yearly files, months for monthly ones. Open unless the caller sets it."""

    first_year: int = 0
    last_year: int = 9999
    first_month: str = "0000-01"
    last_month: str = "9999-12"
