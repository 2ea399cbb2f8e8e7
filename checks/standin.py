"""Published-file look-alikes derived from the given tables.

The grid files cannot be had offline, so every dataset is derived, whole, from a given table: balances and storage
from orders, wind readings from lineitem, solar readings from events (moved back 23 years so that the periods overlap),
generating units from part. All business columns are text, with padding, no-value texts, thousands separators, bad
numbers and impossible times planted by key. The same SQL text, with two spellings of date formatting, feeds Spark
and the oracle; everything after these frames is written twice, independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


TABLES = "region nation customer supplier part orders lineitem events documents labels".split()


class Spark:
    name = "spark"

    @staticmethod
    def day(x):
        return f"date_format({x}, 'yyyy-MM-dd')"

    @staticmethod
    def second(x):
        return f"date_format({x}, 'yyyy-MM-dd HH:mm:ss')"

    ntz = "TIMESTAMP_NTZ"


class Duck:
    name = "duck"

    @staticmethod
    def day(x):
        return f"strftime({x}, '%Y-%m-%d')"

    @staticmethod
    def second(x):
        return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"

    ntz = "TIMESTAMP"


def _dec(x, digits=2):
    return f"CAST(CAST({x} AS DECIMAL(20,{digits})) AS STRING)"


def _pick(key, *values):
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE CAST({key} % {len(values)} AS INT) {cases} END"


_SUB = ("N", "NE", "SE", "S")
_SUB_NAME = ("NORTE", "NORDESTE", "SUDESTE/CENTRO-OESTE", "SUL")
_UF = ("RN", "BA", "CE", "MG", "RS")
_UF_NAME = ("RIO GRANDE DO NORTE", "BAHIA", "CEARA", "MINAS GERAIS", "RIO GRANDE DO SUL")
_REASON_LINE = (
    "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'REL' WHEN l_returnflag = 'A' THEN 'CNF ' "
    "WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'ENE' WHEN l_returnflag = 'N' THEN '' "
    "WHEN l_linestatus = 'F' THEN '-' ELSE ' ENE ' END"
)
_REASON_EVENT = (
    "CASE event_type WHEN 'click' THEN 'REL' WHEN 'error' THEN 'CNF' WHEN 'purchase' THEN 'ENE' "
    "WHEN 'signup' THEN 'PAR' ELSE 'N/A' END"
)


def _control(d, source):
    return f"CAST('2024-06-01 00:00:00' AS {d.ntz}) AS _ingest_ts, {source} AS _source_file"


def balance(d, orders="orders"):
    cents = "CAST(ROUND(o_totalprice * 100) AS BIGINT)"
    hour = "(o_orderkey % 24)"
    sums = ", ".join(f"SUM({c}) AS {c}" for c in ("carga", "hid", "ter", "eol", "sol", "inter"))
    value = lambda c: f"CAST(CAST({c} AS DECIMAL(20,2)) AS STRING)"
    return f"""
    WITH o AS (
      SELECT {_pick('o_custkey', *_SUB)} AS sub, {d.day('o_orderdate')} || ' ' || LPAD(CAST({hour} AS STRING), 2, '0') || ':00:00' AS inst,
             o_orderkey AS k, 8 * {cents} AS carga, 2 * {cents} AS hid, (o_orderkey % 3) * {cents} AS ter,
             (o_orderkey % 13) * {cents} AS eol,
             CASE WHEN {hour} BETWEEN 6 AND 18 THEN (o_orderkey % 5) * {cents} WHEN o_orderkey % 50 = 0 THEN {cents} ELSE 0 END AS sol,
             ((o_orderkey % 13) - 4 - (o_orderkey % 7)) * {cents} AS inter
      FROM {orders}),
    p AS (SELECT sub, inst, MAX(k) AS k, {sums} FROM o GROUP BY sub, inst),
    t AS (SELECT 'SIN' AS sub, inst, 1 AS k, {sums} FROM p GROUP BY inst),
    a AS (SELECT sub, inst, CAST(k AS BIGINT) AS k, carga, hid, ter, eol, sol, inter FROM p
          UNION ALL SELECT sub, inst, CAST(k AS BIGINT) AS k, carga, hid, ter, eol, sol, inter FROM t)
    SELECT CASE WHEN k % 3 = 0 THEN sub || ' ' ELSE sub END AS id_subsistema,
           RPAD(sub || '-nome', 20, ' ') AS nom_subsistema,
           CASE WHEN k % 101 = 0 THEN 'invalido' WHEN k % 103 = 0 THEN '1999-02-30 00:00:00' WHEN k % 5 = 0 THEN ' ' || inst ELSE inst END AS din_instante,
           {value('hid')} AS val_gerhidraulica,
           CASE WHEN k % 17 = 0 THEN 'NA' ELSE {value('ter')} END AS val_gertermica,
           CASE WHEN k % 19 = 0 THEN '--' ELSE {value('eol')} END AS val_gereolica,
           CASE WHEN k % 23 = 0 THEN 'NaN' ELSE {value('sol')} END AS val_gersolar,
           CASE WHEN k % 11 = 0 THEN SUBSTRING({value('carga')}, 1, LENGTH({value('carga')}) - 6) || ',' || SUBSTRING({value('carga')}, LENGTH({value('carga')}) - 5)
                WHEN k % 29 = 0 THEN '0.00' ELSE {value('carga')} END AS val_carga,
           CASE WHEN k % 97 = 0 THEN 'abc' ELSE {value('inter')} END AS val_intercambio,
           {_control(d, "'balanco_' || SUBSTRING(inst, 1, 4) || '.csv'")}
    FROM a"""


def storage(d, orders="orders"):
    pct = "CAST(CAST(CAST(s % 10001 AS DOUBLE) / 100 AS DECIMAL(10,2)) AS STRING)"
    return f"""
    WITH p AS (SELECT {_pick('o_custkey', *_SUB)} AS sub, {d.day('o_orderdate')} AS dia, MAX(o_orderkey) AS k,
                      CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS s
               FROM {orders} GROUP BY 1, 2)
    SELECT sub AS id_subsistema, RPAD(sub || '-nome', 20, ' ') AS nom_subsistema,
           CASE WHEN k % 101 = 0 THEN '2001-13-01' ELSE dia END AS ear_data,
           CAST(CAST(100000 AS DECIMAL(20,2)) AS STRING) AS ear_max_subsistema,
           CAST(CAST((s % 10001) * 10 AS DECIMAL(20,2)) AS STRING) AS ear_verif_subsistema_mwmes,
           CASE WHEN k % 89 = 0 THEN '-' WHEN k % 83 = 0 THEN 'abc' ELSE {pct} END AS ear_verif_subsistema_percentual,
           {_control(d, "'ear_' || SUBSTRING(dia, 1, 4) || '.csv'")}
    FROM p"""


def _plant(key, letter, year):
    """Columns that name a plant; its name changes with the year."""
    return f"""{_pick(key, *_SUB)} AS id_subsistema, RPAD({_pick(key, *_SUB_NAME)}, 22, ' ') AS nom_subsistema,
           {_pick(key, *_UF)} AS id_estado, {_pick(key, *_UF_NAME)} AS nom_estado,
           'Usina ' || CAST({key} % 40 AS STRING) || CASE WHEN {year} >= '2000' THEN ' II ' ELSE '' END AS nom_usina,
           '{letter}' || CAST({key} AS STRING) AS id_ons,
           CASE WHEN {key} % 3 = 0 THEN 'CEG.' || CAST({key} AS STRING) ELSE '-' END AS ceg"""


def wind(d, lineitem="lineitem"):
    day = d.day("l_shipdate")
    slot = "((l_orderkey * 7 + l_linenumber) % 48)"
    clock = f"LPAD(CAST(CAST(FLOOR({slot} / 2) AS INT) AS STRING), 2, '0') || CASE WHEN {slot} % 2 = 0 THEN ':00:00' ELSE ':30:00' END"
    gen = "CASE WHEN l_linenumber = 6 THEN l_extendedprice * 1.02 ELSE l_extendedprice * (1 - l_discount) END"
    has = "has"
    text = "'Limite  da linha ' || CAST(CAST(l_quantity AS INT) AS STRING) || CHR(10) || REPEAT('circuito ', 18) || 'trecho ' || CAST(l_linenumber AS STRING)"
    minutes = lambda code: f"CASE WHEN code = '{code}' THEN '30.9' ELSE '' END"
    row = "CAST(l_orderkey AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || " \
          "CAST(CAST(l_extendedprice AS DECIMAL(20,2)) AS STRING) || '-' || CAST(CAST(l_discount AS DECIMAL(20,2)) AS STRING) || '-' || l_returnflag || l_linestatus"
    return f"""
    SELECT {_plant('l_suppkey', 'W', f"SUBSTRING({day}, 1, 4)")},
           CASE WHEN l_partkey % 499 = 0 THEN '2001-02-30 00:00:00' ELSE {day} || ' ' || {clock} END AS din_instante,
           CASE WHEN l_quantity = 1 THEN '-0.50' ELSE {_dec(gen, 4)} END AS val_geracao,
           {_dec('l_extendedprice * 0.5', 4)} AS val_geracaolimitada,
           {_dec("CASE WHEN l_tax >= 0.07 THEN l_extendedprice * 0.9 ELSE l_extendedprice * 1.1 END", 4)} AS val_disponibilidade,
           CASE WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN '' ELSE {_dec('l_extendedprice')} END AS val_geracaoreferencia,
           CASE WHEN code = 'REL' THEN {_dec('l_extendedprice')} ELSE '' END AS val_geracaoreferenciafinal,
           reason AS cod_razaorestricao,
           CASE WHEN l_tax >= 0.04 THEN 'SIS' WHEN l_tax >= 0.01 THEN 'LOC' ELSE 'NULL' END AS cod_origemrestricao,
           CASE WHEN {has} THEN {text} END AS dsc_restricao,
           'PC' || CAST(l_suppkey % 9 AS STRING) AS id_pontoconexao, 'Ponto ' || CAST(l_suppkey % 9 AS STRING) AS nom_pontoconexao,
           'Agente ' || CAST(l_suppkey % 7 AS STRING) AS nom_agenteoperador,
           CASE WHEN {has} AND l_linenumber <> 4 THEN {_dec(f"CASE WHEN l_linenumber = 6 THEN 0 WHEN l_linenumber = 5 THEN l_extendedprice * l_discount + 0.02 ELSE l_extendedprice * l_discount END", 4)}
                WHEN l_quantity = 50 THEN '1.5' ELSE '' END AS val_geracaonaorealizadaapurada,
           {minutes('REL')} AS num_minutos_rel, {minutes('CNF')} AS num_minutos_cnf, {minutes('ENE')} AS num_minutos_ene,
           CASE WHEN {has} THEN '30' ELSE '' END AS num_minutos_restricao,
           {_control(d, row)}
    FROM (SELECT *, TRIM(reason) AS code, TRIM(reason) NOT IN ('', '-') AS has
          FROM (SELECT *, {_REASON_LINE} AS reason FROM {lineitem}) r) c"""


def solar(d, events="events"):
    time = d.second("ts - INTERVAL 23 YEAR")
    has = "event_type <> 'view'"
    return f"""
    SELECT {_plant('user_id', 'S', f"SUBSTRING({time}, 1, 4)")},
           {time} AS din_instante,
           {_dec('value * (user_id % 10)')} AS val_geracao, {_dec('value * 5')} AS val_geracaolimitada,
           {_dec('value * 8')} AS val_disponibilidade, {_dec('value * 9')} AS val_geracaoreferencia,
           CASE WHEN event_type = 'click' THEN {_dec('value * 9')} ELSE '' END AS val_geracaoreferenciafinal,
           {_REASON_EVENT} AS cod_razaorestricao, CASE WHEN user_id % 2 = 0 THEN 'SIS' ELSE 'LOC' END AS cod_origemrestricao,
           CASE WHEN {has} THEN 'Controle de frequencia ' || CAST(user_id % 5 AS STRING) END AS dsc_restricao,
           'PC' || CAST(user_id % 9 AS STRING) AS id_pontoconexao, 'Ponto' || CHR(10) || CAST(user_id % 9 AS STRING) AS nom_pontoconexao,
           'Agente ' || CAST(user_id % 7 AS STRING) AS nom_agenteoperador,
           CASE WHEN {has} THEN {_dec('CASE WHEN user_id % 10 = 9 THEN 0 ELSE value * (9 - user_id % 10) END')} ELSE '' END AS val_geracaonaorealizadaapurada,
           '' AS num_minutos_rel, '' AS num_minutos_cnf, '' AS num_minutos_ene, '30' AS num_minutos_restricao,
           {_control(d, "'solar-' || CAST(event_id AS STRING)")}
    FROM {events}"""


def capacity(d, part="part"):
    return f"""
    SELECT {_pick('p_partkey', *_SUB)} AS id_subsistema, RPAD({_pick('p_partkey', *_SUB_NAME)}, 22, ' ') AS nom_subsistema,
           {_pick('p_partkey', *_UF)} AS id_estado, {_pick('p_partkey', *_UF_NAME)} AS nom_estado,
           'TIPO I' AS nom_modalidadeoperacao, p_brand AS nom_agenteproprietario, p_brand AS nom_agenteoperador,
           p_type AS nom_tipousina, p_name AS nom_usina,
           CASE WHEN p_partkey % 9 = 0 THEN '-' ELSE 'CEG.' || CAST(p_partkey % 60 AS STRING) END AS ceg,
           p_name || ' UG' AS nom_unidadegeradora, RPAD('EQ' || CAST(p_partkey AS STRING), 16, ' ') AS cod_equipamento,
           RPAD(CAST(p_partkey % 7 AS STRING), 4, ' ') AS num_unidadegeradora, 'null' AS nom_combustivel, '' AS dat_entradateste,
           CASE WHEN p_partkey % 97 = 0 THEN '2001-02-30' ELSE '20' || LPAD(CAST(p_size % 24 AS STRING), 2, '0') || '-01-15' END AS dat_entradaoperacao,
           CASE WHEN p_partkey % 10 = 0 THEN '2020-05-05' ELSE '' END AS dat_desativacao,
           CASE WHEN p_partkey % 50 = 7 THEN '' WHEN p_partkey % 50 = 8 THEN '1,' || {_dec('p_retailprice')} ELSE {_dec('p_retailprice')} END AS val_potenciaefetiva,
           {_control(d, "'capacidade.csv'")}
    FROM {part}"""


DATASETS = {
    "balanco_energia_subsistema": (balance, "orders"),
    "ear_diario_subsistema": (storage, "orders"),
    "restricao_coff_eolica": (wind, "lineitem"),
    "restricao_coff_fotovoltaica": (solar, "events"),
    "capacidade_geracao": (capacity, "part"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """A dataset's bronze frame, derived from a given table by Spark."""
    build, source = DATASETS[dataset]
    return spark.sql(build(Spark, "{src}"), src=table(spark, sf_dir, source))


def bronze_sql(dataset: str) -> str:
    return DATASETS[dataset][0](Duck)


ORDER_FILES = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
#: Months from which on files are published late, and what a name is made of.
LATE = "1998-06"


def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as texts, with the name of the monthly file that each belongs to."""
    orders = table(spark, sf_dir, "orders")
    return orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS o_orderkey", "CAST(o_custkey AS STRING) AS o_custkey", "CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS STRING) AS o_totalprice",
        f"{Spark.day('o_orderdate')} AS o_orderdate", "o_orderpriority", f"'pedidos_' || REPLACE(SUBSTRING({Spark.day('o_orderdate')}, 1, 7), '-', '_') || '.csv' AS arquivo",
    )


def publish(orders: DataFrame, folder: str, staging: str) -> None:
    """One CSV file per name in ``folder``, as a publisher would leave them there: written by Spark, then given their names."""
    spark = orders.sparkSession
    options = dict(header=True, sep=";", quote='"', escape='"', quoteAll=True)
    orders.repartition("arquivo").write.partitionBy("arquivo").options(**options).csv(staging)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staging).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(path(folder))
    for parts in fs.globStatus(path(f"{staging}/arquivo=*/part-*")):
        name = parts.getPath().getParent().getName().split("=", 1)[1]
        fs.rename(parts.getPath(), path(f"{folder}/{name}"))


MONTHLY_FILES = f"""
    SELECT 'pedidos_' || REPLACE(SUBSTRING({Duck.day('o_orderdate')}, 1, 7), '-', '_') || '.csv' AS arquivo, SUBSTRING({Duck.day('o_orderdate')}, 1, 7) AS mes, COUNT(*) AS linhas,
           CAST(SUM(CAST(('0x' || SUBSTRING(MD5(CONCAT_WS(CHR(31), CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS VARCHAR),
               {Duck.day('o_orderdate')}, o_orderpriority)), 1, 15)) AS BIGINT)) AS VARCHAR) AS resumo
    FROM orders GROUP BY 1, 2"""
