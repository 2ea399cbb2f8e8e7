"""Registered queries: data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import layers
from checks.registry import register
from checks.sqltext import _NO_VALUE, big, corr, day, month, num, ratio, rnd, stamp, text
from checks.standin import Duck, bronze, table
from wattfold.config import BUSINESS_KEYS, HEADERS
from wattfold.operators import ranking as R, selection as X, sketches as SK
from wattfold.plans import guard, keys, quality as Q
from wattfold.sources.shared import shared_folder

_REAL = "SELECT * FROM s_balanco WHERE NOT eh_agregado"


# --- completeness --------------------------------------------------------------------------------
def _profile_sql(dataset, distinct=True):
    def one(c):
        counted = f", COUNT(DISTINCT {c}) AS qtd_valores_distintos" if distinct else ""
        absent = f"COUNT(*) FILTER (WHERE {c} IS NULL OR TRIM({c}) IN {_NO_VALUE})"
        return (f"SELECT '{dataset}' AS tabela, '{c}' AS coluna, COUNT(*) AS linhas_totais, COUNT(*) FILTER (WHERE {c} IS NULL) AS qtd_nulos, "
                f"COUNT(*) FILTER (WHERE TRIM({c}) IN {_NO_VALUE}) AS qtd_sentinelas, {rnd(f'100.0 * {absent} / COUNT(*)', 4)} AS pct_ausente{counted} FROM b_{dataset}")
    return " UNION ALL ".join(one(c) for c in HEADERS[dataset])


_ALL_PROFILES = " UNION ALL ".join(_profile_sql(n, distinct=False) for n in HEADERS)


@register("profile_exact", _profile_sql("capacidade_geracao"))
def profile_exact(spark, d):
    """NULLs, no-value texts and exact distinct values of every column."""
    return Q.profile(bronze(spark, d, "capacidade_geracao"), "capacidade_geracao", distinct="exact")


@register("profile_all_tables", _ALL_PROFILES)
def profile_all_tables(spark, d):
    """All 81 attributes, one pass per table; sketched distinct counts left out of the comparison."""
    return Q.profile_tables(layers.bronze_tables(spark, d)).drop("qtd_valores_distintos")


@register("profile_approx", f"""
    SELECT tabela, coluna, linhas_totais, qtd_nulos, qtd_sentinelas, pct_ausente, TRUE AS distintos_no_erro FROM ({_profile_sql('balanco_energia_subsistema', distinct=False)}) p""")
def profile_approx(spark, d):
    """The same with sketched distinct counts, each held against the exact one: within three standard errors of 5 percent."""
    b = bronze(spark, d, "balanco_energia_subsistema")
    exact = Q.profile(b, "balanco_energia_subsistema", distinct="exact").select("coluna", F.col("qtd_valores_distintos").alias("exato"))
    near = F.abs(F.col("qtd_valores_distintos") - F.col("exato")) <= 3 * 0.05 * F.col("exato") + 1
    return Q.profile(b, "balanco_energia_subsistema").join(exact, "coluna").withColumn("distintos_no_erro", near).drop("qtd_valores_distintos", "exato")


@register("absent_columns", f"SELECT tabela, coluna, linhas_totais, qtd_nulos, qtd_sentinelas, pct_ausente FROM ({_ALL_PROFILES}) WHERE pct_ausente > 0")
def absent_columns(spark, d):
    return Q.absent_columns(Q.profile_tables(layers.bronze_tables(spark, d)))


@register("quality_synthesis", f"""
    SELECT tabela, COUNT(*) AS atributos, COUNT(*) FILTER (WHERE pct_ausente = 0) AS completos,
           COUNT(*) FILTER (WHERE pct_ausente > 0 AND pct_ausente < 50) AS ausencia_parcial,
           COUNT(*) FILTER (WHERE pct_ausente >= 50) AS ausencia_estrutural, MAX(linhas_totais) AS linhas FROM ({_ALL_PROFILES}) GROUP BY tabela""")
def quality_synthesis(spark, d):
    return Q.synthesis(Q.profile_tables(layers.bronze_tables(spark, d)))


@register("availability_by_month", f"""
    SELECT {month('din_instante')} AS mes, {rnd('100.0 * COUNT(dsc_restricao) / COUNT(*)', 2)} AS pct_com_descricao,
           {rnd('100.0 * COUNT(cod_razao_restricao) / COUNT(*)', 2)} AS pct_com_restricao FROM s_restricao GROUP BY 1""")
def availability_by_month(spark, d):
    return Q.availability_by_month(layers.read(spark, d, "s_restricao"), "din_instante", {
        "pct_com_descricao": "dsc_restricao", "pct_com_restricao": "cod_razao_restricao"})


# --- keys, conversion, domains ----------------------------------------------------------------------
@register("bronze_key_uniqueness", " UNION ALL ".join(
    f"""SELECT '{t}' AS tabela, '{" + ".join(k)}' AS chave_negocio, SUM(n)::BIGINT AS linhas, COUNT(*) AS chaves_distintas, (SUM(n) - COUNT(*))::BIGINT AS linhas_duplicadas,
        0::BIGINT AS linhas_com_chave_nula, {rnd('100.0 * (SUM(n) - COUNT(*)) / SUM(n)', 4)} AS pct_duplicado
        FROM (SELECT {", ".join(k)}, COUNT(*) AS n FROM b_{t} GROUP BY {", ".join(k)})""" for t, k in BUSINESS_KEYS.items()))
def bronze_key_uniqueness(spark, d):
    return keys.check_uniqueness(layers.bronze_tables(spark, d), BUSINESS_KEYS)


_CONVERT = {"timestamp": stamp, "date": day, "decimal": num}


def _cast_sql(t, c, kind):
    lost = f"(COUNT(*) FILTER (WHERE ({_CONVERT[kind](c)}) IS NULL) - COUNT(*) FILTER (WHERE ({text(c)}) IS NULL))"
    return f"""SELECT '{t}' AS tabela, '{c}' AS coluna, '{Q.TARGET_TYPE[kind]}' AS tipo_alvo, COUNT(*) FILTER (WHERE ({text(c)}) IS NULL) AS ja_ausente,
        {lost} AS perdidos_no_cast, {rnd(f'100.0 * {lost} / COUNT(*)', 6)} AS pct_perdido, CASE WHEN {lost} = 0 THEN 'OK' ELSE 'ATENÇÃO' END AS status FROM b_{t}"""


@register("cast_loss", " UNION ALL ".join(_cast_sql(t, c, k) for t, tests in Q.CAST_TESTS.items() for c, k in tests))
def cast_loss(spark, d):
    """The fifteen conversion tests, one pass per table."""
    return Q.cast_loss_tables(layers.bronze_tables(spark, d))


@register("domain_values", " UNION ALL ".join(
    f"SELECT '{t}' AS tabela, '{c}' AS coluna, COALESCE(TRIM({c}), '<nulo>') AS valor, COUNT(*) AS linhas FROM b_{t} GROUP BY 3"
    for t, cs in Q.DOMAIN_COLUMNS.items() for c in cs))
def domain_values(spark, d):
    tables = layers.bronze_tables(spark, d)
    return Q.stack([Q.domain_values(tables[t], t, cs) for t, cs in Q.DOMAIN_COLUMNS.items()])


@register("domain_allowed", """
    SELECT 'orders' AS tabela, 'o_orderpriority' AS coluna, o_orderpriority AS valor, COUNT(*) AS linhas, o_orderpriority IN ('1-URGENT', '2-HIGH') AS esperado FROM orders GROUP BY 3
    UNION ALL SELECT 'orders', 'o_orderstatus', o_orderstatus, COUNT(*), TRUE FROM orders GROUP BY 3""")
def domain_allowed(spark, d):
    """Values with counts, and whether each is in the allowed set."""
    return Q.domain_values(table(spark, d, "orders"), "orders", ["o_orderstatus", "o_orderpriority"], {"o_orderpriority": ["1-URGENT", "2-HIGH"]})


@register("domain_head", """
    SELECT 'part' AS tabela, 'p_name' AS coluna, p_name AS valor, COUNT(*) AS linhas FROM part GROUP BY 3 ORDER BY 4 DESC, 3 LIMIT 12""")
def domain_head(spark, d):
    """The twelve most frequent values of a column."""
    return Q.domain_head(Q.domain_values(table(spark, d, "part"), "part", ["p_name"]))


@register("padding", " UNION ALL ".join(
    f"SELECT '{c}' AS atributo, COUNT(*) AS linhas, COUNT(*) FILTER (WHERE {c} <> TRIM({c})) AS com_espaco_extra, "
    f"COUNT(DISTINCT {c}) AS distintos_sem_trim, COUNT(DISTINCT TRIM({c})) AS distintos_com_trim FROM b_capacidade_geracao"
    for c in ("nom_subsistema", "cod_equipamento", "num_unidadegeradora")))
def padding(spark, d):
    return Q.padding(bronze(spark, d, "capacidade_geracao"), ["nom_subsistema", "cod_equipamento", "num_unidadegeradora"])


@register("newline_records", " UNION ALL ".join(
    f"SELECT '{t}' AS tabela, COUNT(*) FILTER (WHERE CONTAINS(dsc_restricao, CHR(10)) OR CONTAINS(nom_pontoconexao, CHR(10))) AS registros_com_quebra FROM b_{t}"
    for t in ("restricao_coff_eolica", "restricao_coff_fotovoltaica")))
def newline_records(spark, d):
    return Q.stack([
        Q.newline_records(bronze(spark, d, t), t, ["dsc_restricao", "nom_pontoconexao"])
        for t in ("restricao_coff_eolica", "restricao_coff_fotovoltaica")
    ])


# --- consistency ----------------------------------------------------------------------------------------
@register("total_equals_parts", f"""
    WITH sub AS (SELECT din_instante, SUM(carga_mwmed) AS soma FROM s_balanco WHERE NOT eh_agregado GROUP BY din_instante)
    SELECT COUNT(*) AS horas_comparadas, {rnd('MAX(ABS(s.carga_mwmed - sub.soma))', 3)} AS maior_diferenca_mwmed,
           {rnd('SUM(s.carga_mwmed) / SUM(sub.soma)', 6)} AS razao_sin_sobre_soma
    FROM s_balanco s JOIN sub USING (din_instante) WHERE s.eh_agregado""")
def total_equals_parts(spark, d):
    """National total rows against the sum of the subsystems, hour by hour."""
    return Q.total_equals_parts(layers.read(spark, d, "s_balanco"), "din_instante", "eh_agregado", "carga_mwmed")


@register("balance_identity", f"""
    SELECT id_subsistema, {rnd(corr('intercambio_mwmed', 'ger_total_mwmed - carga_mwmed'), 4)} AS correlacao,
           {rnd('AVG(ABS(intercambio_mwmed - (ger_total_mwmed - carga_mwmed)))', 1)} AS erro_medio_abs_mwmed,
           {rnd('AVG(ABS(intercambio_mwmed))', 1)} AS intercambio_medio_abs_mwmed FROM ({_REAL}) GROUP BY id_subsistema""")
def balance_identity(spark, d):
    return Q.balance_identity(layers.read(spark, d, "s_balanco"))


_RULES = [
    ("Carga negativa", "carga_mwmed < 0", "b"), ("Geração hidráulica negativa", "ger_hidraulica_mwmed < 0", "b"),
    ("Geração térmica negativa", "ger_termica_mwmed < 0", "b"), ("Geração eólica negativa", "ger_eolica_mwmed < 0", "b"),
    ("Geração solar negativa", "ger_solar_mwmed < 0", "b"),
    ("Geração solar > 1 MWmed entre 0h e 4h", "HOUR(din_instante) BETWEEN 0 AND 4 AND ger_solar_mwmed > 1", "b"),
    ("EAR fora de 0-100%", "ear_percentual < 0 OR ear_percentual > 100", "e"),
    ("Geração da usina > disponibilidade + 5%", "geracao_mwmed > disponibilidade_mwmed * 1.05", "r"),
    ("Geração negativa em usina", "geracao_mwmed < 0", "r"), ("Corte calculado negativo", "corte_mwh < 0", "r"),
    ("Restrição declarada sem energia cortada", "houve_restricao AND corte_mwh = 0", "r"),
    ("Restrição declarada sem geração de referência", "houve_restricao AND geracao_referencia_mwmed IS NULL", "r"),
]
_RULE_SOURCE = {"b": f"({_REAL})", "e": "(SELECT * FROM s_ear WHERE NOT eh_agregado)", "r": "s_restricao"}


@register("plausibility_rules", " UNION ALL ".join(
    f"SELECT '{n}' AS teste, COUNT(*) FILTER (WHERE {c}) AS violacoes, COUNT(*) AS avaliados FROM {_RULE_SOURCE[s]}" for n, c, s in _RULES))
def plausibility_rules(spark, d):
    """The twelve plausibility rules, one scan per table."""
    return Q.plausibility(*[layers.read(spark, d, t) for t in ("s_balanco", "s_ear", "s_restricao")])


_NIGHT = "HOUR(din_instante) BETWEEN 0 AND 4 AND ger_solar_mwmed > 1"


_EARLY = "o_orderdate < DATE '1996-01-01'"
_LOADS = {"c1": (_EARLY, 3), "c2": ("TRUE", 60), "c3": ("TRUE", 3)}


def _load_sql(name, where, modulus):
    """Rows read, per rule and warning of one load; the first and the third load are within their limits."""
    low = f"o_custkey % 100 < {modulus}"
    pick = f"FROM orders WHERE {where}"
    done = f"(SELECT COUNT(*) FILTER (WHERE {low} OR o_totalprice < 1000) * 100.0 <= 10 * COUNT(*) {pick})"
    kept = {"c1": f"SELECT COUNT(*) FROM orders WHERE {_EARLY} AND NOT (o_custkey % 100 < 3 OR o_totalprice < 1000)"}
    kept["c2"], kept["c3"] = kept["c1"], "SELECT COUNT(*) FROM orders WHERE NOT (o_custkey % 100 < 3 OR o_totalprice < 1000)"
    return f"""SELECT '{name}' AS carga, CASE WHEN {done} THEN 'gravada' ELSE 'recusada' END AS situacao, COUNT(*) AS linhas_lidas, COUNT(*) FILTER (WHERE {low}) AS cliente_retido,
        COUNT(*) FILTER (WHERE NOT {low} AND o_totalprice < 1000) AS valor_baixo, COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS aberto_em_parte,
        COUNT(*) FILTER (WHERE {low} OR o_totalprice < 1000) AS em_quarentena, ({kept[name]}) AS linhas_da_tabela {pick}"""


@register("guarded_load", " UNION ALL ".join(_load_sql(n, *v) for n, v in _LOADS.items()))
def guarded_load(spark, d):
    """Three loads of orders: some rows, then all with a rule that rejects most of them and so is refused, then all."""
    base, orders, reports = shared_folder(spark), table(spark, d, "orders"), []
    target, quarantine = f"{base}/tabela", f"{base}/quarentena"
    for name, (where, modulus) in _LOADS.items():
        rules = {"cliente_retido": F.col("o_custkey") % 100 < modulus, "valor_baixo": F.col("o_totalprice") < 1000}
        report = guard.guarded_load(
            orders.filter(where), name, rules, lambda good: good.write.mode("overwrite").parquet(target), quarantine, 10.0,
            warnings={"aberto_em_parte": F.col("o_orderstatus") == "P"}, limits={"aberto_em_parte": 90.0})
        report["linhas_da_tabela"] = spark.read.parquet(target).count()
        reports.append(report)
    held = guard.quarantined(spark, quarantine).groupBy("carga").agg(F.count("*").alias("em_quarentena"))
    columns = ["carga", "situacao", "linhas_lidas", "cliente_retido", "valor_baixo", "aberto_em_parte", "linhas_da_tabela"]
    told = spark.createDataFrame([tuple(r[c] for c in columns) for r in reports], "carga string, situacao string, " + ", ".join(f"{c} long" for c in columns[2:]))
    return told.join(held, "carga", "left").select(*columns[:-1], F.coalesce("em_quarentena", F.lit(0)).alias("em_quarentena"), "linhas_da_tabela")


@register("night_solar", f"""
    SELECT id_subsistema, CAST(YEAR(din_instante) AS INTEGER) AS ano, COUNT(*) AS horas, {rnd('AVG(ger_solar_mwmed)', 1)} AS media_mwmed,
           {rnd('MAX(ger_solar_mwmed)', 1)} AS maximo_mwmed FROM ({_REAL}) WHERE {_NIGHT} GROUP BY 1, 2""")
def night_solar(spark, d):
    return Q.night_solar(layers.read(spark, d, "s_balanco"))


@register("night_solar_share", f"""
    SELECT {ratio(f'SUM(CASE WHEN {_NIGHT} THEN ger_solar_mwmed ELSE 0 END)', 'SUM(ger_solar_mwmed)', 4)} AS pct_da_energia_solar_na_madrugada FROM ({_REAL})""")
def night_solar_share(spark, d):
    return Q.night_solar_share(layers.read(spark, d, "s_balanco"))


@register("reconciliation", f"""
    SELECT COUNT(*) AS registros, {rnd('SUM(corte_mwh)', 1)} AS corte_calculado_mwh, {rnd('SUM(gnra_oficial_mwh)', 1)} AS gnra_oficial_mwh,
           {ratio('SUM(corte_mwh) - SUM(gnra_oficial_mwh)', 'SUM(gnra_oficial_mwh)', 4)} AS diferenca_pct,
           {rnd(corr('corte_mwmed', 'gnra_oficial_mwmed'), 6)} AS correlacao,
           COUNT(*) FILTER (WHERE gnra_oficial_mwmed IS NOT NULL AND ABS(corte_mwmed - gnra_oficial_mwmed) > 0.01) AS registros_divergentes,
           COUNT(*) FILTER (WHERE gnra_oficial_mwmed IS NOT NULL AND NOT houve_restricao) AS gnra_sem_razao_declarada,
           COUNT(*) FILTER (WHERE gnra_oficial_mwmed IS NULL AND houve_restricao) AS razao_sem_gnra FROM s_restricao""")
def reconciliation(spark, d):
    """Computed against official energy not generated."""
    return Q.reconcile_curtailment(layers.readings(spark, d))


@register("official_without_reason", f"""
    SELECT cod_fonte, {month('din_instante')} AS mes, COUNT(*) AS registros, {rnd('SUM(gnra_oficial_mwh)', 1)} AS gnra_mwh
    FROM s_restricao WHERE gnra_oficial_mwmed IS NOT NULL AND NOT houve_restricao GROUP BY 1, 2""")
def official_without_reason(spark, d):
    return Q.official_without_reason(layers.readings(spark, d))


@register("presence_by_category", f"""
    SELECT COALESCE(cod_razao_restricao, '<sem restrição>') AS razao, COUNT(*) AS registros, COUNT(geracao_referencia_final_mwmed) AS com_referencia_final,
           {rnd('100.0 * COUNT(geracao_referencia_final_mwmed) / COUNT(*)', 2)} AS pct FROM s_restricao GROUP BY 1""")
def presence_by_category(spark, d):
    return Q.presence_by_category(
        layers.readings(spark, d), "cod_razao_restricao", "geracao_referencia_final_mwmed", "com_referencia_final")


# --- outliers and order statistics ------------------------------------------------------------------------
def _tukey_sql(source, column, label, condition):
    return f"""SELECT '{label}' AS metrica, COUNT(*) AS n, {rnd('MIN(x)', 3)} AS minimo, {rnd('MAX(q1)', 3)} AS q1, {rnd('MAX(q2)', 3)} AS mediana, {rnd('MAX(q3)', 3)} AS q3,
        {rnd('MAX(x)', 3)} AS maximo, {rnd('MAX(q1 - 1.5 * (q3 - q1))', 3)} AS limite_inferior, {rnd('MAX(q3 + 1.5 * (q3 - q1))', 3)} AS limite_superior,
        COUNT(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS qtd_outliers,
        {rnd('100.0 * COUNT(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) / COUNT(*)', 3)} AS pct_outliers
        FROM (SELECT {column} AS x FROM {source} WHERE {condition} AND {column} IS NOT NULL) v,
             (SELECT QUANTILE_CONT({column}, 0.25) AS q1, QUANTILE_CONT({column}, 0.5) AS q2, QUANTILE_CONT({column}, 0.75) AS q3 FROM {source} WHERE {condition}) q"""


_TUKEY = [
    ("s_balanco", "carga_mwmed", "Carga do subsistema (MWmed)", "NOT eh_agregado"), ("s_balanco", "ger_eolica_mwmed", "Geração eólica (MWmed)", "NOT eh_agregado"),
    ("s_balanco", "ger_solar_mwmed", "Geração solar (MWmed)", "NOT eh_agregado"), ("s_balanco", "intercambio_mwmed", "Intercâmbio (MWmed)", "NOT eh_agregado"),
    ("s_ear", "ear_percentual", "EAR (%)", "NOT eh_agregado"), ("s_restricao", "corte_mwh", "Corte por usina / 30 min (MWh)", "houve_restricao"),
]


@register("outliers_exact", " UNION ALL ".join(_tukey_sql(*t) for t in _TUKEY))
def outliers_exact(spark, d):
    """Tukey fences from exact, distributed quartiles."""
    return Q.outlier_report(*[layers.read(spark, d, t) for t in ("s_balanco", "s_ear", "s_restricao")], exact=True)


@register("outliers_approx", """
    SELECT 'Carga do subsistema (MWmed)' AS metrica, COUNT(carga_mwmed) AS n, TRUE AS q1_no_erro, TRUE AS mediana_no_erro, TRUE AS q3_no_erro FROM s_balanco WHERE NOT eh_agregado
    UNION ALL SELECT 'Geração eólica (MWmed)', COUNT(ger_eolica_mwmed), TRUE, TRUE, TRUE FROM s_balanco WHERE NOT eh_agregado
    UNION ALL SELECT 'Geração solar (MWmed)', COUNT(ger_solar_mwmed), TRUE, TRUE, TRUE FROM s_balanco WHERE NOT eh_agregado
    UNION ALL SELECT 'Intercâmbio (MWmed)', COUNT(intercambio_mwmed), TRUE, TRUE, TRUE FROM s_balanco WHERE NOT eh_agregado
    UNION ALL SELECT 'EAR (%)', COUNT(ear_percentual), TRUE, TRUE, TRUE FROM s_ear WHERE NOT eh_agregado
    UNION ALL SELECT 'Corte por usina / 30 min (MWh)', COUNT(corte_mwh), TRUE, TRUE, TRUE FROM s_restricao WHERE houve_restricao""")
def outliers_approx(spark, d):
    """Sketched quartiles of the outlier measures, each held against exact ranks: within a thousandth of the rows."""
    frames = [layers.read(spark, d, t) for t in ("s_balanco", "s_ear", "s_restricao")]
    return Q.stack([Q.quartile_ranks(*m) for m in Q.outlier_measures(*frames)])


_MONTH = f"SUBSTRING({Duck.day('o_orderdate')}, 1, 7)"


def _orders_by_month(spark, d):
    month = F.substring(F.date_format("o_orderdate", "yyyy-MM-dd"), 1, 7).alias("mes")
    return table(spark, d, "orders").select(month, "o_custkey", F.col("o_totalprice").cast("double").alias("valor"))


@register("distinct_states", f"""
    SELECT mes, COUNT(DISTINCT o_custkey) AS distintos, TRUE AS estimativa_no_erro FROM (SELECT {_MONTH} AS mes, o_custkey FROM orders) o GROUP BY 1
    UNION ALL SELECT 'ano ' || SUBSTRING(mes, 1, 4), COUNT(DISTINCT o_custkey), TRUE FROM (SELECT {_MONTH} AS mes, o_custkey FROM orders) o GROUP BY 1
    UNION ALL SELECT 'total', COUNT(DISTINCT o_custkey), TRUE FROM orders""")
def distinct_states(spark, d):
    """Customers per month, year and in all: exact from bitmaps kept per month, and whether HLL sketches agree within four standard errors."""
    orders = _orders_by_month(spark, d)
    bits, sketches = SK.bitmap_state(orders, ["mes"], "o_custkey"), SK.hll_state(orders, ["mes"], "o_custkey")
    year = F.concat(F.lit("ano "), F.substring("mes", 1, 4))
    levels = []
    for name in (F.col("mes"), year, F.lit("total")):
        exact = SK.bitmap_distinct(SK.merge_bitmaps(bits.withColumn("mes", name), ["mes"]), ["mes"])
        levels.append(exact.join(SK.hll_distinct(sketches.withColumn("mes", name), ["mes"]), "mes"))
    near = F.abs(F.col("distintos_estimados") - F.col("distintos")) <= 4 * SK.distinct_error() * F.col("distintos") + 1
    return Q.stack(levels).select("mes", "distintos", near.alias("estimativa_no_erro"))


@register("quantile_states", f"""
    SELECT mes, COUNT(*) AS n, TRUE AS p10_no_erro, TRUE AS mediana_no_erro, TRUE AS p99_no_erro FROM (SELECT {_MONTH} AS mes FROM orders) o GROUP BY 1
    UNION ALL SELECT 'total', COUNT(*), TRUE, TRUE, TRUE FROM orders""")
def quantile_states(spark, d):
    """Order values' quantiles from KLL sketches kept per month and merged, each held against exact ranks: within twice the stated error."""
    orders, probs = _orders_by_month(spark, d), {"p10": 0.1, "mediana": 0.5, "p99": 0.99}
    state = SK.kll_state(orders, ["mes"], "valor")
    merged = SK.merge_kll(state.withColumn("mes", F.lit("total")), ["mes"])
    checked = []
    for rows, found in ((orders, state), (orders.withColumn("mes", F.lit("total")), merged)):
        bounds = [side.alias(f"{name}_{k}") for name in probs for k, side in enumerate(SK.rank_bounds("valor", name))]
        ranks = rows.join(SK.kll_quantiles(found, probs), "mes").groupBy("mes").agg(F.count("valor").alias("linhas"), F.max("n").alias("n"), *bounds)
        near = [SK.within_rank_error(F.col(f"{name}_0"), F.col(f"{name}_1"), p, 2 * SK.rank_error(), F.col("n")).alias(f"{name}_no_erro") for name, p in probs.items()]
        checked.append(ranks.filter("linhas = n").select("mes", F.col("n").cast("long").alias("n"), *near))
    return Q.stack(checked)


@register("exact_quantiles", f"""
    SELECT COUNT(l_quantity) AS n, QUANTILE_CONT(l_quantity, 0.5) AS mediana, {rnd('QUANTILE_CONT(l_quantity, 0.9)', 6)} AS p90, {rnd('QUANTILE_CONT(l_quantity, 0.001)', 6)} AS p001 FROM lineitem""")
def exact_quantiles(spark, d):
    """Exact quantiles of a column in which a few values fill whole percents of the rows."""
    return R.exact_quantiles(table(spark, d, "lineitem"), "l_quantity", {"mediana": 0.5, "p90": 0.9, "p001": 0.001})


_MEASURES = {
    "quantidade": "l_quantity", "preco": "l_extendedprice", "desconto": "l_discount", "preco_devolvido": "CASE WHEN l_returnflag = 'R' THEN l_extendedprice END",
}
_PROBS = {"minimo": 0.0, "p001": 0.001, "q1": 0.25, "mediana": 0.5, "p90": 0.9, "p999": 0.999, "maximo": 1.0}


@register("quantiles_many_columns", " UNION ALL ".join(
    f"SELECT '{name}' AS coluna, COUNT({x}) AS n, " + ", ".join(rnd(f"QUANTILE_CONT(CAST({x} AS DOUBLE), {p})", 6) + f" AS {q}" for q, p in _PROBS.items()) + " FROM lineitem"
    for name, x in _MEASURES.items()))
def quantiles_many_columns(spark, d):
    """Exact quantiles of four measures in the same scans; only a thousand values may be put in order in one task."""
    return X.quantile_table(table(spark, d, "lineitem"), {name: F.expr(x) for name, x in _MEASURES.items()}, _PROBS, fit=1000)


@register("average_ranks", """
    SELECT o_totalprice AS value, MIN(r) + (COUNT(*) - 1) / 2.0 AS rank FROM (SELECT o_totalprice, RANK() OVER (ORDER BY o_totalprice) AS r FROM orders) GROUP BY 1""")
def average_ranks(spark, d):
    """Global average ranks without a global window."""
    return R.average_ranks(table(spark, d, "orders"), "o_totalprice")


@register("top_k_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 12")
def top_k_rows(spark, d):
    return R.top_k(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 12, ["o_orderkey"])


@register("month_blocks", f"""
    SELECT NTILE(3) OVER (ORDER BY mes) AS bloco, mes, pedidos FROM (SELECT {month('o_orderdate')} AS mes, COUNT(*) AS pedidos FROM orders GROUP BY 1)""")
def month_blocks(spark, d):
    """Months in three consecutive blocks of near-equal size."""
    from wattfold.functions.measures import month_text
    months = table(spark, d, "orders").groupBy(month_text("o_orderdate").alias("mes")).agg(F.count("*").alias("pedidos"))
    return R.consecutive_blocks(months, "mes", 3, "bloco").withColumn("bloco", F.col("bloco").cast("bigint"))


# --- coverage ------------------------------------------------------------------------------------------------
@register("coverage_by_year", f"""
    SELECT *, {rnd('1.0 * registros / (dias_com_dado * subsistemas)', 2)} AS registros_por_dia_subsistema FROM (
      SELECT CAST(YEAR(din_instante) AS INTEGER) AS ano, COUNT(DISTINCT CAST(din_instante AS DATE)) AS dias_com_dado, COUNT(*) AS registros,
             COUNT(DISTINCT id_subsistema) AS subsistemas FROM s_balanco WHERE NOT eh_agregado GROUP BY 1)""")
def coverage_by_year(spark, d):
    return Q.coverage_by_year(layers.read(spark, d, "s_balanco").filter("NOT eh_agregado"), "din_instante", "id_subsistema")


@register("coverage_by_month", f"""
    SELECT {month('din_instante')} AS mes, COUNT(DISTINCT id_ons) AS usinas, COUNT(*) AS registros, {rnd('1.0 * COUNT(*) / COUNT(DISTINCT id_ons)', 1)} AS registros_por_usina
    FROM s_restricao GROUP BY 1""")
def coverage_by_month(spark, d):
    return Q.coverage_by_month(layers.read(spark, d, "s_restricao"), "din_instante", "id_ons")


@register("coverage_gaps", """
    SELECT id_subsistema, d AS dat_referencia FROM (SELECT id_subsistema, CAST(UNNEST(generate_series(CAST(MIN(dat_referencia) AS TIMESTAMP), CAST(MAX(dat_referencia) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
      FROM s_ear WHERE dat_referencia IS NOT NULL GROUP BY id_subsistema)
    WHERE (id_subsistema, d) NOT IN (SELECT (id_subsistema, dat_referencia) FROM s_ear)""")
def coverage_gaps(spark, d):
    """Missing days of each subsystem's storage series."""
    return Q.gaps(layers.read(spark, d, "s_ear"), "id_subsistema", "dat_referencia", "1 DAY")


_USER_HOURS = "SELECT DISTINCT user_id % 50 AS grupo, date_trunc('hour', ts) AS hora FROM events"


@register("coverage_runs", f"""
    SELECT grupo, MIN(hora) AS inicio, MAX(hora) AS fim, COUNT(*) AS slots, CAST(COALESCE(MAX(falta), 0) AS BIGINT) AS faltantes_antes
    FROM (SELECT *, SUM(CASE WHEN falta = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY grupo ORDER BY hora) AS corrida FROM
      (SELECT *, date_diff('hour', LAG(hora) OVER (PARTITION BY grupo ORDER BY hora), hora) - 1 AS falta FROM ({_USER_HOURS}) u) g) h
    GROUP BY grupo, corrida""")
def coverage_runs(spark, d):
    """Unbroken runs of hours with events of each group of users."""
    e = table(spark, d, "events").select((F.col("user_id") % 50).alias("grupo"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hora"))
    return Q.present_runs(e, "grupo", "hora", "1 HOUR")


@register("totals_overview", f"""
    SELECT eh_agregado, COUNT(DISTINCT id_subsistema) AS qtd_subsistemas, {rnd('SUM(carga_mwmed) / 1e6', 2)} AS carga_total_tw_med,
           MIN(din_instante) AS inicio, MAX(din_instante) AS fim FROM s_balanco GROUP BY eh_agregado""")
def totals_overview(spark, d):
    return Q.totals_overview(layers.read(spark, d, "s_balanco"))
