"""The oracle's side: SQL text of every layer, as common table expressions resolved by name."""

from __future__ import annotations

import re

from checks.standin import DATASETS, bronze_sql

_NO_VALUE = "('', '-', '--', 'N/A', 'NA', 'null', 'NULL')"
REASONS = ("REL", "CNF", "ENE", "PAR")


def text(c):
    return f"CASE WHEN TRIM({c}) IN {_NO_VALUE} THEN NULL ELSE TRIM({c}) END"


def num(c):
    x = f"TRY_CAST(REPLACE({text(c)}, ',', '') AS DOUBLE)"
    return f"CASE WHEN isnan({x}) THEN NULL ELSE {x} END"


def stamp(c):
    return f"TRY_STRPTIME({text(c)}, '%Y-%m-%d %H:%M:%S')"


def day(c):
    return f"CAST(TRY_STRPTIME({text(c)}, '%Y-%m-%d') AS DATE)"


def rnd(x, digits):
    """Half-up rounding of the decimal value, which is what Spark's round does to a double.

    The decimal keeps at least six digits more than are asked for, so that rounding twice does not show.
    """
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,{10 if digits <= 4 else 14})), {digits}) AS DOUBLE)"


def ratio(a, b, digits=None):
    x = f"100.0 * ({a}) / NULLIF({b}, 0)"
    return x if digits is None else rnd(x, digits)


def corr(x, y):
    c = f"corr({x}, {y})"
    return f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END"


def big(x):
    return f"CAST({x} AS BIGINT)"


def key(d):
    return f"CAST(YEAR({d}) * 10000 + MONTH({d}) * 100 + DAY({d}) AS INTEGER)"


def month(d):
    return f"strftime({d}, '%Y-%m')"


CTES: dict[str, str] = {f"b_{name}": bronze_sql(name) for name in DATASETS}

CTES["t_balanco"] = f"""
    SELECT x.*, id_subsistema = 'SIN' AS eh_agregado,
           COALESCE(ger_hidraulica_mwmed, 0) + COALESCE(ger_termica_mwmed, 0) + COALESCE(ger_eolica_mwmed, 0) + COALESCE(ger_solar_mwmed, 0) AS ger_total_mwmed,
           COALESCE(ger_eolica_mwmed, 0) + COALESCE(ger_solar_mwmed, 0) AS ger_intermitente_mwmed,
           carga_mwmed - (COALESCE(ger_eolica_mwmed, 0) + COALESCE(ger_solar_mwmed, 0)) AS carga_liquida_mwmed,
           CASE WHEN carga_mwmed > 0 THEN {rnd('100.0 * (COALESCE(ger_eolica_mwmed, 0) + COALESCE(ger_solar_mwmed, 0)) / carga_mwmed', 4)} END AS pct_intermitente_sobre_carga
    FROM (SELECT {text('id_subsistema')} AS id_subsistema, {text('nom_subsistema')} AS nom_subsistema_origem, {stamp('din_instante')} AS din_instante,
                 {num('val_gerhidraulica')} AS ger_hidraulica_mwmed, {num('val_gertermica')} AS ger_termica_mwmed,
                 {num('val_gereolica')} AS ger_eolica_mwmed, {num('val_gersolar')} AS ger_solar_mwmed, {num('val_carga')} AS carga_mwmed,
                 {num('val_intercambio')} AS intercambio_mwmed, _source_file, _ingest_ts FROM b_balanco_energia_subsistema) x"""
CTES["s_balanco"] = """
    SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_subsistema, din_instante ORDER BY _source_file DESC) AS rn
    FROM t_balanco WHERE din_instante IS NOT NULL) WHERE rn = 1"""
CTES["t_ear"] = f"""
    SELECT {text('id_subsistema')} AS id_subsistema, {day('ear_data')} AS dat_referencia, {num('ear_max_subsistema')} AS ear_maxima_mwmes,
           {num('ear_verif_subsistema_mwmes')} AS ear_verificada_mwmes, {num('ear_verif_subsistema_percentual')} AS ear_percentual,
           _source_file, _ingest_ts, {text('id_subsistema')} = 'SIN' AS eh_agregado
    FROM b_ear_diario_subsistema"""
CTES["s_ear"] = """
    SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_subsistema, dat_referencia ORDER BY _source_file DESC) AS rn
    FROM t_ear WHERE dat_referencia IS NOT NULL) WHERE rn = 1"""


def _readings(source, code, name):
    texts = {
        "id_subsistema": "id_subsistema", "id_estado": "id_estado", "nom_estado": "nom_estado", "nom_usina": "nom_usina",
        "id_ons": "id_ons", "ceg": "ceg", "cod_razaorestricao": "cod_razao_restricao", "cod_origemrestricao": "cod_origem_restricao",
        "dsc_restricao": "dsc_restricao", "id_pontoconexao": "id_ponto_conexao", "nom_pontoconexao": "nom_ponto_conexao",
        "nom_agenteoperador": "nom_agente_operador",
    }
    numbers = {
        "val_geracao": "geracao_mwmed", "val_geracaolimitada": "geracao_limitada_mwmed", "val_disponibilidade": "disponibilidade_mwmed",
        "val_geracaoreferencia": "geracao_referencia_mwmed", "val_geracaoreferenciafinal": "geracao_referencia_final_mwmed",
        "val_geracaonaorealizadaapurada": "gnra_oficial_mwmed",
    }
    whole = {f"num_minutos_{m}": f"num_minutos_{m}" for m in ("rel", "cnf", "ene", "restricao")}
    cols = [f"{text(a)} AS {b}" for a, b in texts.items()] + [f"{num(a)} AS {b}" for a, b in numbers.items()]
    cols += [f"CAST(TRUNC({num(a)}) AS INTEGER) AS {b}" for a, b in whole.items()]
    return f"SELECT {', '.join(cols)}, {stamp('din_instante')} AS din_instante, _source_file, _ingest_ts, '{code}' AS cod_fonte, '{name}' AS nom_fonte FROM {source}"


_CUT = ("CASE WHEN cod_razao_restricao IS NULL THEN 0.0 WHEN geracao_referencia_mwmed IS NULL OR geracao_mwmed IS NULL THEN 0.0 "
        "WHEN geracao_referencia_mwmed > geracao_mwmed THEN geracao_referencia_mwmed - geracao_mwmed ELSE 0.0 END")
CTES["t_restricao"] = f"""
    SELECT x.*, cod_razao_restricao IS NOT NULL AS houve_restricao, CAST({_CUT} AS DOUBLE) AS corte_mwmed, {rnd(f'({_CUT}) * 0.5', 6)} AS corte_mwh,
           {rnd('geracao_mwmed * 0.5', 6)} AS geracao_mwh, {rnd('geracao_referencia_mwmed * 0.5', 6)} AS geracao_referencia_mwh,
           {rnd('gnra_oficial_mwmed * 0.5', 6)} AS gnra_oficial_mwh,
           CASE cod_razao_restricao WHEN 'REL' THEN 'Indisponibilidade externa (elétrica)' WHEN 'CNF' THEN 'Requisitos de confiabilidade'
                WHEN 'ENE' THEN 'Razão energética' WHEN 'PAR' THEN 'Parecer de acesso' END AS dsc_razao_restricao,
           CASE cod_origem_restricao WHEN 'SIS' THEN 'Sistêmica' WHEN 'LOC' THEN 'Local' END AS dsc_origem_restricao
    FROM ({_readings('b_restricao_coff_eolica', 'EOL', 'Eólica')} UNION ALL {_readings('b_restricao_coff_fotovoltaica', 'SOL', 'Solar')}) x"""
CTES["s_restricao"] = """
    SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_ons, din_instante, cod_fonte
             ORDER BY _source_file DESC, id_subsistema DESC, id_estado DESC, nom_usina DESC, ceg DESC, geracao_mwmed DESC) AS rn
    FROM t_restricao WHERE din_instante IS NOT NULL) WHERE rn = 1"""
CTES["t_capacidade"] = f"""
    SELECT {text('id_subsistema')} AS id_subsistema, {text('id_estado')} AS id_estado, {text('nom_estado')} AS nom_estado,
           {text('nom_tipousina')} AS nom_tipo_usina, {text('nom_usina')} AS nom_usina, {text('ceg')} AS ceg,
           {text('nom_combustivel')} AS nom_combustivel, {text('nom_agenteproprietario')} AS nom_agente_proprietario,
           {text('cod_equipamento')} AS cod_equipamento, {day('dat_entradaoperacao')} AS dat_entrada_operacao,
           {day('dat_desativacao')} AS dat_desativacao, {num('val_potenciaefetiva')} AS potencia_efetiva_mw, _ingest_ts,
           {day('dat_desativacao')} IS NULL AS esta_ativa
    FROM b_capacidade_geracao"""
CTES["s_capacidade"] = """
    SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cod_equipamento, nom_usina ORDER BY ceg DESC) AS rn
    FROM t_capacidade WHERE potencia_efetiva_mw IS NOT NULL) WHERE rn = 1"""

_MONTHS = ["Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro"]
_DAYS = ["Domingo", "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado"]


def _list(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


CTES["d_data"] = f"""
    SELECT {key('d')} AS sk_data, d AS data, CAST(YEAR(d) AS INTEGER) AS ano, CAST(MONTH(d) AS INTEGER) AS mes,
           {_list(_MONTHS)}[MONTH(d)] AS nom_mes, CAST(DAY(d) AS INTEGER) AS dia, {month('d')} AS ano_mes,
           CAST(QUARTER(d) AS INTEGER) AS trimestre, CAST(DAYOFWEEK(d) + 1 AS INTEGER) AS num_dia_semana,
           {_list(_DAYS)}[DAYOFWEEK(d) + 1] AS nom_dia_semana, DAYOFWEEK(d) IN (0, 6) AS eh_fim_semana,
           CAST(DAYOFYEAR(d) AS INTEGER) AS dia_do_ano,
           CASE WHEN DAYOFYEAR(d) >= 355 OR DAYOFYEAR(d) < 80 THEN 'Verão' WHEN DAYOFYEAR(d) < 172 THEN 'Outono'
                WHEN DAYOFYEAR(d) < 266 THEN 'Inverno' ELSE 'Primavera' END AS estacao_ano
    FROM (SELECT CAST(UNNEST(generate_series(CAST(ini AS TIMESTAMP), CAST(fim AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
          FROM (SELECT MIN(d) AS ini, MAX(d) AS fim FROM (SELECT CAST(din_instante AS DATE) AS d FROM s_balanco
                UNION ALL SELECT dat_referencia FROM s_ear UNION ALL SELECT CAST(din_instante AS DATE) FROM s_restricao)))"""
CTES["d_hora"] = """
    SELECT CAST(h AS INTEGER) AS sk_hora, CAST(h AS INTEGER) AS hora, LPAD(CAST(h AS VARCHAR), 2, '0') || 'h' AS hora_rotulo,
           CASE WHEN h < 6 THEN 'Madrugada' WHEN h < 12 THEN 'Manhã' WHEN h < 18 THEN 'Tarde' ELSE 'Noite' END AS periodo_dia,
           h BETWEEN 18 AND 20 AS eh_horario_ponta, h BETWEEN 6 AND 18 AS eh_janela_solar
    FROM range(0, 24) t(h)"""
CTES["d_subsistema"] = """
    SELECT id AS sk_subsistema, id AS id_subsistema, nome AS nom_subsistema FROM (VALUES ('N', 'Norte'), ('NE', 'Nordeste'),
           ('SE', 'Sudeste/C.O.'), ('S', 'Sul'), ('SIN', 'Brasil')) t(id, nome)"""
CTES["d_fonte"] = """
    SELECT cod AS sk_fonte, cod AS cod_fonte, nome AS nom_fonte, inter AS eh_intermitente FROM (VALUES ('HID', 'Hidráulica', FALSE),
           ('TER', 'Térmica', FALSE), ('EOL', 'Eólica', TRUE), ('SOL', 'Solar', TRUE)) t(cod, nome, inter)"""
CTES["d_usina"] = f"""
    SELECT u.id_ons AS sk_usina, u.id_ons, u.nom_usina, u.ceg, u.cod_fonte, u.nom_fonte, u.id_estado, u.nom_estado, u.id_subsistema,
           c.potencia_instalada_mw, c.qtd_unidades_geradoras, c.dat_entrada_operacao, a.disponibilidade_maxima_mwmed,
           c.potencia_instalada_mw IS NOT NULL AS tem_cadastro_capacidade, a.primeiro_registro, a.ultimo_registro
    FROM (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_ons ORDER BY din_instante DESC, nom_usina DESC) AS r FROM s_restricao) WHERE r = 1) u
    JOIN (SELECT id_ons, MIN(din_instante) AS primeiro_registro, MAX(din_instante) AS ultimo_registro,
                 MAX(disponibilidade_mwmed) AS disponibilidade_maxima_mwmed FROM s_restricao GROUP BY id_ons) a ON a.id_ons = u.id_ons
    LEFT JOIN (SELECT ceg, {rnd('SUM(potencia_efetiva_mw)', 3)} AS potencia_instalada_mw, COUNT(*) AS qtd_unidades_geradoras,
                      MIN(dat_entrada_operacao) AS dat_entrada_operacao FROM s_capacidade WHERE esta_ativa AND ceg IS NOT NULL GROUP BY ceg) c ON c.ceg = u.ceg"""
CTES["f_geracao"] = "\n    UNION ALL ".join(
    f"SELECT {key('din_instante')} AS sk_data, CAST(HOUR(din_instante) AS INTEGER) AS sk_hora, id_subsistema AS sk_subsistema, '{cod}' AS sk_fonte, "
    f"din_instante, {rnd(f'COALESCE({col}, 0)', 4)} AS geracao_mwmed, {rnd(f'COALESCE({col}, 0)', 4)} AS geracao_mwh FROM s_balanco WHERE NOT eh_agregado"
    for cod, col in (("HID", "ger_hidraulica_mwmed"), ("TER", "ger_termica_mwmed"), ("EOL", "ger_eolica_mwmed"), ("SOL", "ger_solar_mwmed")))
CTES["f_balanco"] = f"""
    SELECT {key('din_instante')} AS sk_data, CAST(HOUR(din_instante) AS INTEGER) AS sk_hora, id_subsistema AS sk_subsistema, din_instante,
           {', '.join(f"{rnd(c, 4)} AS {c}" for c in ('carga_mwmed', 'ger_total_mwmed', 'ger_intermitente_mwmed', 'carga_liquida_mwmed', 'intercambio_mwmed'))},
           pct_intermitente_sobre_carga, {rnd('carga_liquida_mwmed', 4)} < 0 AS carga_liquida_negativa
    FROM s_balanco WHERE NOT eh_agregado"""


def _fan(column, codes):
    return ", ".join(f"{rnd(f'''SUM(CASE WHEN {column} = '{c}' THEN corte_mwh ELSE 0 END)''', 6)} AS corte_{c.lower()}_mwh" for c in codes)


CTES["f_restricao"] = f"""
    SELECT {key('g.hora')} AS sk_data, CAST(HOUR(g.hora) AS INTEGER) AS sk_hora, g.id_ons AS sk_usina, g.id_subsistema AS sk_subsistema, g.cod_fonte AS sk_fonte,
           g.hora AS din_instante, g.* EXCLUDE (hora, id_ons, id_subsistema, cod_fonte), m.cod AS cod_razao_predominante,
           intervalos_com_restricao > 0 AS houve_restricao_na_hora,
           CASE WHEN geracao_referencia_mwh > 0 THEN {rnd('100.0 * corte_mwh / geracao_referencia_mwh', 4)} END AS taxa_corte_pct
    FROM (SELECT id_ons, cod_fonte, id_subsistema, DATE_TRUNC('hour', din_instante) AS hora, {rnd('SUM(corte_mwh)', 6)} AS corte_mwh,
                 {rnd('SUM(geracao_mwh)', 6)} AS geracao_mwh, {rnd('SUM(geracao_referencia_mwh)', 6)} AS geracao_referencia_mwh,
                 COUNT(*) FILTER (WHERE houve_restricao) AS intervalos_com_restricao, COUNT(*) AS intervalos_no_periodo,
                 {_fan('cod_razao_restricao', REASONS)}, {_fan('cod_origem_restricao', ('SIS', 'LOC'))}, {rnd('SUM(gnra_oficial_mwh)', 6)} AS gnra_oficial_mwh
          FROM s_restricao GROUP BY 1, 2, 3, 4) g
    LEFT JOIN (SELECT id_ons, cod_fonte, id_subsistema, hora, cod FROM (
                 SELECT id_ons, cod_fonte, id_subsistema, DATE_TRUNC('hour', din_instante) AS hora, cod_razao_restricao AS cod,
                        ROW_NUMBER() OVER (PARTITION BY id_ons, cod_fonte, id_subsistema, DATE_TRUNC('hour', din_instante) ORDER BY COUNT(*) DESC, cod_razao_restricao) AS r
                 FROM s_restricao WHERE cod_razao_restricao IS NOT NULL GROUP BY 1, 2, 3, 4, 5) WHERE r = 1) m
      ON m.id_ons = g.id_ons AND m.cod_fonte = g.cod_fonte AND m.id_subsistema = g.id_subsistema AND m.hora = g.hora"""
CTES["f_reservatorio"] = f"""
    SELECT {key('dat_referencia')} AS sk_data, id_subsistema AS sk_subsistema, dat_referencia, {rnd('ear_verificada_mwmes', 4)} AS ear_verificada_mwmes,
           {rnd('ear_maxima_mwmes', 4)} AS ear_maxima_mwmes, {rnd('ear_percentual', 4)} AS ear_percentual,
           CASE WHEN ear_percentual < 30 THEN 'Crítico (<30%)' WHEN ear_percentual < 50 THEN 'Baixo (30-50%)'
                WHEN ear_percentual < 70 THEN 'Confortável (50-70%)' WHEN ear_percentual >= 70 THEN 'Alto (>70%)' END AS faixa_armazenamento
    FROM s_ear WHERE NOT eh_agregado"""


def query(body: str) -> str:
    """A statement with the common table expressions it needs, in order of dependency."""
    needed: list[str] = []

    def visit(sql):
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in needed)
    own = re.match(r"\s*WITH\s", body)
    return f"WITH {ctes}" + (",\n" + body[own.end():] if own else "\n" + body)
