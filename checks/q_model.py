"""Registered queries: sources, cleaning, silver, dimensions, facts and keys."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from checks import layers
from checks.registry import register
from checks.sqltext import big, corr, day, key, month, num, rnd, stamp, text
from checks.standin import DATASETS, Duck, LATE, MONTHLY_FILES, ORDER_FILES, bronze, monthly_orders, publish, table
from wattfold.config import HEADERS, Period, SOURCE_COLUMNS
from wattfold.functions import clean as C, measures as M
from wattfold.operators import aggregate as A, conform as K, joins as J, ranking as R
from wattfold.plans import dims, facts, keys, silver
from wattfold.sources import landing, partitions
from wattfold.sources.bronze import read_bronze
from wattfold.sources.shared import shared_folder


# --- sources --------------------------------------------------------------------------------
_LATE = f"arquivo >= 'pedidos_{LATE.replace('-', '_')}.csv'"
_ORDER_COLUMNS = list(ORDER_FILES)


def _two_landings(spark, d):
    """Monthly files of all orders: all but the late ones are landed, then the late ones are published; folder and target."""
    base = shared_folder(spark)
    folder, target = f"{base}/pedidos_origem", f"{base}/alvo"
    orders = monthly_orders(spark, d)
    publish(orders.filter(f"NOT {_LATE}"), f"{folder}/pedidos", f"{base}/s1")
    landing.land(spark, folder, "pedidos", _ORDER_COLUMNS, target)
    publish(orders.filter(_LATE), f"{folder}/pedidos", f"{base}/s2")
    return folder, target


def _land_again(spark, folder, target, between=None):
    """Lands what is new and gives the first batch of this landing."""
    since = landing.landed_manifest(spark, target).agg(F.coalesce(F.max("_lote") + 1, F.lit(0))).first()[0]
    landing.land(spark, folder, "pedidos", _ORDER_COLUMNS, target, between=between)
    return since


@register("file_manifest", f"""
    SELECT 'pedidos' AS dataset, arquivo, mes AS periodo, CASE WHEN {_LATE} THEN 'novo' ELSE 'cache' END AS status, linhas, resumo FROM ({MONTHLY_FILES}) f""")
def file_manifest(spark, d):
    """Manifest after two landings of monthly files of orders: new and known files, their rows and content digests."""
    folder, target = _two_landings(spark, d)
    since = _land_again(spark, folder, target)
    status = landing.landing_status(spark, folder, target, since).select("arquivo", "status")
    listed = landing.landed_manifest(spark, target).select("dataset", "arquivo", "periodo", "linhas", "resumo")
    return listed.join(status, "arquivo").select("dataset", "arquivo", "periodo", "status", "linhas", "resumo")


@register("manifest_summary", f"""
    SELECT 'pedidos' AS dataset, CASE WHEN {_LATE} THEN 'novo' ELSE 'cache' END AS status, COUNT(*) AS arquivos, CAST(SUM(linhas) AS BIGINT) AS linhas
    FROM ({MONTHLY_FILES}) f GROUP BY 2""")
def manifest_summary(spark, d):
    folder, target = _two_landings(spark, d)
    return landing.landing_summary(spark, folder, target, _land_again(spark, folder, target))


@register("new_files", f"SELECT 'pedidos' AS dataset, arquivo FROM ({MONTHLY_FILES}) f WHERE {_LATE}")
def new_files(spark, d):
    """Files of orders that were published since the last landing."""
    folder, target = _two_landings(spark, d)
    return landing.pending_files(spark, folder, target)


@register("landing_after_failure", f"SELECT arquivo, linhas, linhas AS linhas_manifesto, resumo FROM ({MONTHLY_FILES}) f")
def landing_after_failure(spark, d):
    """Rows per file where the second landing fails once between rows and manifest, is repeated, and is run once more."""
    folder, target = _two_landings(spark, d)
    failed = []

    def between(batch):
        if not failed:
            failed.append(batch)
            raise RuntimeError("planned failure in the middle of a landing")

    try:
        _land_again(spark, folder, target, between)
    except StreamingQueryException:
        pass
    for _ in range(2):
        _land_again(spark, folder, target, between)
    rows = landing.landed_rows(spark, target).groupBy("arquivo").agg(F.count("*").alias("linhas"), landing.content_digest(_ORDER_COLUMNS).alias("resumo"))
    known = landing.landed_manifest(spark, target).select("arquivo", F.col("linhas").alias("linhas_manifesto"))
    return rows.join(known, "arquivo").filter(F.lit(len(failed) == 1)).select("arquivo", "linhas", "linhas_manifesto", "resumo")


@register("landing_period", f"""
    SELECT arquivo, CASE WHEN mes BETWEEN '1994-03' AND '1996-02' THEN 'selecionado' ELSE 'fora_da_janela' END AS situacao,
           CASE WHEN mes BETWEEN '1994-03' AND '1996-02' THEN linhas ELSE 0 END AS linhas FROM ({MONTHLY_FILES}) f""")
def landing_period(spark, d):
    """Every landed file and whether a window of two years selects it, with the rows read of it through the window."""
    folder, target = _two_landings(spark, d)
    _land_again(spark, folder, target)
    window = Period(first_month="1994-03", last_month="1996-02")
    read = landing.landed_rows(spark, target, period=window).groupBy("arquivo").agg(F.count("*").alias("lidas"))
    status = landing.landing_status(spark, folder, target, period=window).select("arquivo", "situacao")
    return status.join(read, "arquivo", "left").select("arquivo", "situacao", F.coalesce("lidas", F.lit(0)).alias("linhas"))


_MONTHS = f"""
    SELECT SUBSTRING({Duck.day('o_orderdate')}, 1, 7) AS mes, COUNT(*) AS antes,
           COUNT(*) FILTER (WHERE NOT (o_orderkey % 50 = 0 AND o_orderdate >= DATE '1997-01-01')) AS depois
    FROM orders GROUP BY 1"""


@register("partition_refresh", f"""
    SELECT mes, CASE WHEN mes < '1992-04' THEN antes WHEN mes = '1995-05' THEN depois + 1 ELSE depois END AS linhas,
           CASE WHEN mes < '1992-04' THEN 'removida' WHEN antes <> depois OR mes IN ('1995-05', '1996-07') THEN 'gravada' ELSE 'mantida' END AS situacao
    FROM ({_MONTHS}) m""")
def partition_refresh(spark, d):
    """A table of orders by month is refreshed with content in which some months lack rows, gain one, change one or are gone."""
    path = f"{shared_folder(spark)}/pedidos_por_mes"
    month = F.substring(F.date_format("o_orderdate", "yyyy-MM-dd"), 1, 7).alias("mes")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", month)
    partitions.refresh(orders, path, ["mes"])
    first = lambda m: orders.filter(F.col("mes") == m).orderBy("o_orderkey").limit(1)
    changed = orders.join(first("1996-07").select(F.col("o_orderkey").alias("k")), F.col("o_orderkey") == F.col("k"), "left")
    changed = changed.withColumn("o_orderstatus", F.when(F.col("k").isNotNull(), "X").otherwise(F.col("o_orderstatus"))).drop("k")
    changed = changed.filter((F.col("mes") >= "1992-04") & ~((F.col("o_orderkey") % 50 == 0) & (F.col("mes") >= "1997-01"))).unionByName(first("1995-05"))
    return partitions.refresh(changed, path, ["mes"])


@register("partition_refresh_content", f"""
    SELECT SUBSTRING({Duck.day('o_orderdate')}, 1, 7) AS mes, COUNT(*) AS linhas, CAST(SUM(o_orderkey) AS BIGINT) AS chaves, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS fechados
    FROM orders WHERE o_orderkey % 3 > 0 AND o_orderdate >= DATE '1993-01-01' GROUP BY 1""")
def partition_refresh_content(spark, d):
    """What a table holds after three refreshes, the last one with a third of the orders and the first year gone."""
    path = f"{shared_folder(spark)}/pedidos_por_mes"
    month = F.substring(F.date_format("o_orderdate", "yyyy-MM-dd"), 1, 7).alias("mes")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", month)
    partitions.refresh(orders, path, ["mes"])
    for content in (orders.filter("o_orderkey % 3 > 0"), orders.filter("o_orderkey % 3 > 0 AND mes >= '1993-01'")):
        partitions.refresh(content, path, ["mes"])
    return partitions.read(spark, path).groupBy("mes").agg(F.count("*").alias("linhas"), F.sum("o_orderkey").alias("chaves"), F.count_if(F.col("o_orderstatus") == "F").alias("fechados"))


def _csv(spark, d, dataset):
    """A dataset's stand-in written as published CSV and read back as bronze."""
    folder = f"{shared_folder(spark)}/{dataset}"
    header = HEADERS[dataset]
    out = bronze(spark, d, dataset).select(*header)
    out.write.options(
        header=True, sep=";", quote='"', escape='"', quoteAll=True, emptyValue="", ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(folder)
    return read_bronze(spark, f"{folder}/*.csv", dataset, header)


_ROUND_TRIP = ", ".join(f"NULLIF({c}, '') AS {c}" for c in HEADERS["restricao_coff_fotovoltaica"])


@register("bronze_csv_multiline", f"SELECT {_ROUND_TRIP}, 'restricao_coff_fotovoltaica' AS _source_dataset FROM b_restricao_coff_fotovoltaica")
def bronze_csv_multiline(spark, d):
    """Text round trip through CSV with line breaks inside quotes; provenance columns present."""
    df = _csv(spark, d, "restricao_coff_fotovoltaica")
    return df.filter(F.col("_ingest_ts").isNotNull() & F.col("_source_file").endswith(".csv")).drop("_ingest_ts", "_source_file")


# --- cleaning ---------------------------------------------------------------------------------
@register("clean_values", f"""
    SELECT {text('id_subsistema')} AS texto, {num('val_carga')} AS decimal, CAST(TRUNC({num('val_gersolar')}) AS BIGINT) AS inteiro,
           {stamp('din_instante')} AS instante, COALESCE(TRIM(val_gertermica), '<nulo>') AS visivel FROM b_balanco_energia_subsistema""")
def clean_values(spark, d):
    """Trim, no-value texts, thousands separators, NaN, truncation, timestamps and visible NULLs."""
    b = bronze(spark, d, "balanco_energia_subsistema")
    return b.select(
        C.clean_text("id_subsistema").alias("texto"), C.clean_decimal("val_carga").alias("decimal"),
        C.clean_decimal("val_gersolar").try_cast("bigint").alias("inteiro"), C.clean_timestamp("din_instante").alias("instante"),
        C.visible_null("val_gertermica").alias("visivel"),
    )


@register("clean_dates", f"""
    SELECT {day('dat_entradaoperacao')} AS entrada, {day('dat_desativacao')} AS desativacao, {text('nom_combustivel')} AS combustivel,
           CAST(TRUNC({num('val_potenciaefetiva')}) AS INTEGER) AS potencia FROM b_capacidade_geracao""")
def clean_dates(spark, d):
    b = bronze(spark, d, "capacidade_geracao")
    return b.select(
        C.clean_date("dat_entradaoperacao").alias("entrada"), C.clean_date("dat_desativacao").alias("desativacao"),
        C.clean_text("nom_combustivel").alias("combustivel"), C.clean_int("val_potenciaefetiva").alias("potencia"),
    )


@register("reject_accounting", """
    SELECT 'linhas_lidas' AS medida, COUNT(*) AS linhas FROM t_balanco
    UNION ALL SELECT 'linhas_aceitas', COUNT(*) FROM t_balanco WHERE din_instante IS NOT NULL AND carga_mwmed IS NOT NULL
    UNION ALL SELECT 'instante_invalido', COUNT(*) FROM t_balanco WHERE din_instante IS NULL
    UNION ALL SELECT 'carga_ausente', COUNT(*) FROM t_balanco WHERE din_instante IS NOT NULL AND carga_mwmed IS NULL""")
def reject_accounting(spark, d):
    """Rows read, accepted and rejected by the first rule they break."""
    typed = silver.typed_balance(bronze(spark, d, "balanco_energia_subsistema"))
    return K.reject_counts(typed, {**silver.no_instant(), "carga_ausente": F.col("carga_mwmed").isNull()})


@register("rejected_rows", f"""
    SELECT id_ons, _source_file, 'instante_invalido' AS motivo_rejeicao FROM t_restricao WHERE din_instante IS NULL""")
def rejected_rows(spark, d):
    typed = silver.typed_curtailment(bronze(spark, d, "restricao_coff_eolica"), bronze(spark, d, "restricao_coff_fotovoltaica"))
    return K.rejected(typed, silver.no_instant()).select("id_ons", "_source_file", K.REJECT)


@register("conform_union", """
    SELECT 'C' || c_custkey AS codigo, TRIM(c_name) AS nome, CAST(c_acctbal AS DOUBLE) AS saldo, 'cliente' AS papel FROM customer
    UNION ALL SELECT 'S' || s_suppkey, TRIM(s_name), CAST(s_acctbal AS DOUBLE), 'fornecedor' FROM supplier""")
def conform_union(spark, d):
    """Two sources mapped to one schema, tagged and united by column name."""
    customer = table(spark, d, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("k"), "c_name", F.col("c_acctbal").cast("string").alias("b"))
    supplier = table(spark, d, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("k"), "s_name", F.col("s_acctbal").cast("string").alias("b"))
    spec = lambda name: [("b", "saldo", "decimal"), ("k", "codigo", "text"), (name, "nome", "text")]
    return K.union_conformed(
        K.conform(customer, spec("c_name"), tags={"papel": "cliente"}),
        K.conform(supplier, spec("s_name"), tags={"papel": "fornecedor"}),
    )


@register("dedupe_latest", """
    SELECT * EXCLUDE (r) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
           l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS r FROM lineitem) WHERE r = 1""")
def dedupe_latest(spark, d):
    """One row per business key, the latest, whatever the input order."""
    return K.dedupe(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register("dedupe_hot_key", """
    SELECT lang, source, doc_id, n_chars FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang, source ORDER BY n_chars DESC, doc_id DESC) AS r
    FROM documents) WHERE r = 1""")
def dedupe_hot_key(spark, d):
    """Few keys, each with very many rows: reduced in every task before the shuffle."""
    return K.dedupe(table(spark, d, "documents").select("lang", "source", "n_chars", "doc_id"), ["lang", "source"], ["n_chars"])


@register("newline_texts", """
    SELECT lang, COUNT(*) AS documentos, COUNT(*) FILTER (WHERE CONTAINS(text, CHR(10))) AS com_quebra FROM documents GROUP BY lang""")
def newline_texts(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(
        F.count("*").alias("documentos"), F.count_if(C.has_newline("text")).alias("com_quebra"))


@register("collapsed_whitespace", r"""
    SELECT doc_id, LENGTH(t) AS tamanho, MD5(t) AS resumo FROM (SELECT doc_id, REGEXP_REPLACE(text, '[\t\n\x0B\f\r ]+', ' ', 'g') AS t FROM documents)""")
def collapsed_whitespace(spark, d):
    """Whole texts with every run of white space as one space."""
    docs = table(spark, d, "documents").select("doc_id", C.collapse_whitespace("text").alias("t"))
    return docs.select("doc_id", F.length("t").cast("bigint").alias("tamanho"), F.md5(F.col("t").cast("binary")).alias("resumo"))


# --- derived measures ----------------------------------------------------------------------------
_GAP = "CASE WHEN l_returnflag = 'N' THEN 0.0 ELSE GREATEST(l_extendedprice - l_extendedprice * (1 - l_discount), 0.0) END"


@register("shortfall_energy", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, {rnd(_GAP, 4)} AS corte, {rnd(f'({_GAP}) * 0.5', 4)} AS energia,
           CASE WHEN l_quantity - 25 > 0 THEN {rnd('100.0 * l_tax / (l_quantity - 25)', 4)} END AS pct FROM lineitem""", digits=4)
def shortfall_energy(spark, d):
    """Shortfall only with a reason, energy of half an hour, guarded percentage."""
    l = table(spark, d, "lineitem")
    reason = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    gap = M.shortfall("l_extendedprice", F.col("l_extendedprice") * (1 - F.col("l_discount")), reason)
    return l.select(
        "l_orderkey", "l_linenumber", "l_partkey", gap.alias("corte"), M.to_energy(gap).alias("energia"),
        M.guarded_pct("l_tax", F.col("l_quantity") - 25).alias("pct"),
    )


@register("bands_labels_flags", f"""
    SELECT faixa, rotulo, urgente, fim_semana, medio, COUNT(*) AS pedidos, {rnd('SUM(COALESCE(t, 0) + COALESCE(u, 0))', 2)} AS soma FROM (
      SELECT CASE WHEN o_totalprice < 100000 THEN 'baixo' WHEN o_totalprice < 300000 THEN 'médio' ELSE 'alto' END AS faixa,
             CASE o_orderstatus WHEN 'F' THEN 'fechado' WHEN 'O' THEN 'aberto' END AS rotulo, o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgente,
             DAYOFWEEK(o_orderdate) IN (0, 6) AS fim_semana, o_totalprice BETWEEN 50000 AND 150000 AS medio,
             CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS t, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS u FROM orders)
    GROUP BY 1, 2, 3, 4, 5""", digits=2)
def bands_labels_flags(spark, d):
    """Bands with inclusive lower bounds, code labels, membership and range flags, sums with NULL as zero."""
    o = table(spark, d, "orders")
    priced = o.select(
        M.band("o_totalprice", [(100000, "baixo"), (300000, "médio")], "alto").alias("faixa"),
        M.label("o_orderstatus", {"F": "fechado", "O": "aberto"}).alias("rotulo"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("urgente"),
        F.dayofweek("o_orderdate").isin(1, 7).alias("fim_semana"),
        M.in_range("o_totalprice", (50000, 150000)).alias("medio"),
        M.null_as_zero_sum(
            F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")), F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))
        ).alias("soma"),
    )
    return priced.groupBy("faixa", "rotulo", "urgente", "fim_semana", "medio").agg(
        F.count("*").alias("pedidos"), F.round(F.sum("soma"), 2).alias("soma"))


@register("unpivot_long", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, medida, SUM(v) AS valor FROM (
      SELECT l_orderkey, l_linenumber, l_partkey, 'QTD' AS medida, COALESCE(l_quantity, 0) AS v FROM lineitem
      UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'DES', COALESCE(CASE WHEN l_linenumber <> 3 THEN l_discount END, 0) FROM lineitem
      UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'IMP', COALESCE(l_tax, 0) FROM lineitem) GROUP BY 1, 2, 3, 4""", digits=4)
def unpivot_long(spark, d):
    """Three measure columns to rows; a missing value is 0."""
    l = table(spark, d, "lineitem").withColumn("l_discount", F.when(F.col("l_linenumber") != 3, F.col("l_discount")))
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    long = A.unpivot_measures(l, ids, {"l_quantity": "QTD", "l_discount": "DES", "l_tax": "IMP"}, "medida", "valor")
    return long.groupBy(*ids, "medida").agg(F.sum("valor").alias("valor"))


@register("pivot_wide", f"""
    SELECT o_custkey, {', '.join(f"COALESCE({rnd(f'''SUM(o_totalprice) FILTER (WHERE o_orderstatus = '{s}')''', 2)}, 0.0) AS total_{s}" for s in 'FOP')}
    FROM orders GROUP BY o_custkey""", digits=2)
def pivot_wide(spark, d):
    """Long to wide with fixed columns; missing cells are 0."""
    sums = table(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    return A.pivot_matrix(sums, ["o_custkey"], "o_orderstatus", ["F", "O", "P"], "v", "total_")


# --- silver ------------------------------------------------------------------------------------
register("silver_balance", "SELECT * FROM s_balanco", digits=None)(layers.build_balance)
register("silver_storage", "SELECT * FROM s_ear", digits=None)(layers.build_storage)
register("silver_curtailment", "SELECT * FROM s_restricao", digits=None)(layers.build_curtailment)
register("silver_capacity", "SELECT * FROM s_capacidade", digits=None)(layers.build_capacity)

# --- dimensions and facts over the stored silver layer ---------------------------------------------
register("dim_calendar", "SELECT * FROM d_data", digits=None)(layers.build_calendar)
register("dim_plant", "SELECT * FROM d_usina", digits=None)(layers.build_plants)
for _name, _sql in {
    "fato_geracao_horaria": "f_geracao", "fato_balanco_horario": "f_balanco", "fato_restricao_horaria": "f_restricao",
    "fato_reservatorio_diario": "f_reservatorio",
}.items():
    register(_name, f"SELECT * FROM {_sql}", digits=None)(layers.BUILDERS[_name])


@register("hour_dim_on_events", """
    SELECT h.hora_rotulo, h.periodo_dia, h.eh_horario_ponta, h.eh_janela_solar, COUNT(*) AS eventos
    FROM events e JOIN d_hora h ON CAST(HOUR(e.ts) AS INTEGER) = h.sk_hora GROUP BY 1, 2, 3, 4""")
def hour_dim_on_events(spark, d):
    """The hour dimension used on all events."""
    e = table(spark, d, "events").select(F.hour("ts").alias("sk_hora"))
    return J.star_join(e, (dims.hour_dim(spark), "sk_hora")).groupBy(
        "hora_rotulo", "periodo_dia", "eh_horario_ponta", "eh_janela_solar").agg(F.count("*").alias("eventos"))


@register("metadata_dims_on_fact", f"""
    SELECT s.nom_subsistema, f.nom_fonte, f.eh_intermitente, COUNT(*) AS linhas, {rnd('SUM(g.geracao_mwh)', 2)} AS mwh
    FROM f_geracao g JOIN d_subsistema s ON g.sk_subsistema = s.sk_subsistema JOIN d_fonte f ON g.sk_fonte = f.sk_fonte GROUP BY 1, 2, 3""", digits=2)
def metadata_dims_on_fact(spark, d):
    """Subsystem and source dimensions from metadata, joined to the generation fact."""
    s = layers.star(spark, d)
    joined = J.star_join(s.fato_geracao_horaria, (s.dim_subsistema, "sk_subsistema"), (s.dim_fonte_geracao, "sk_fonte"))
    return joined.groupBy("nom_subsistema", "nom_fonte", "eh_intermitente").agg(
        F.count("*").alias("linhas"), F.round(F.sum("geracao_mwh"), 2).alias("mwh"))


@register("hourly_rollup", f"""
    SELECT user_id, DATE_TRUNC('hour', ts) AS hora, {rnd('SUM(value)', 4)} AS total, COUNT(*) AS leituras,
           COUNT(*) FILTER (WHERE value > 10) AS altas, {', '.join(f"{rnd(f'''SUM(CASE WHEN event_type = '{c}' THEN value ELSE 0 END)''', 4)} AS total_{c}" for c in ('click', 'error', 'view'))}
    FROM events GROUP BY 1, 2""", digits=4)
def hourly_rollup(spark, d):
    """Readings to full hours with a fan-out of the measure by code."""
    return A.rollup_hours(table(spark, d, "events"), ["user_id"], "ts", "hora", [
        F.round(F.sum("value"), 4).alias("total"), F.count("*").alias("leituras"), F.count_if(F.col("value") > 10).alias("altas"),
        *A.fan_out("event_type", ["click", "error", "view"], "value", "total_%s", 4),
    ])


@register("most_frequent_code", """
    SELECT user_id, hora, cod FROM (SELECT user_id, DATE_TRUNC('hour', ts) AS hora, event_type AS cod,
      ROW_NUMBER() OVER (PARTITION BY user_id, DATE_TRUNC('hour', ts) ORDER BY COUNT(*) DESC, event_type) AS r FROM events GROUP BY 1, 2, 3) WHERE r = 1""")
def most_frequent_code(spark, d):
    """Most frequent value per group; ties go to the smallest."""
    return A.rollup_hours(table(spark, d, "events"), ["user_id"], "ts", "hora", [A.most_frequent("event_type").alias("cod")])


@register("latest_attributes", f"""
    SELECT u.user_id, u.event_type, u.value, u.props, a.primeiro, a.ultimo, a.maior FROM (
      SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) AS r FROM events) WHERE r = 1) u
    JOIN (SELECT user_id, MIN(ts) AS primeiro, MAX(ts) AS ultimo, MAX(value) AS maior FROM events GROUP BY user_id) a ON a.user_id = u.user_id""")
def latest_attributes(spark, d):
    """Attributes of each key's latest row, with first and last time seen."""
    return A.latest_attributes(
        table(spark, d, "events"), "user_id", "ts", ["event_type", "value", "props"],
        [F.min("ts").alias("primeiro"), F.max("ts").alias("ultimo"), F.max("value").alias("maior")],
    )


# --- joins and keys ---------------------------------------------------------------------------------
@register("enrich_left", f"""
    SELECT c.c_custkey, c.c_nationkey, s.fornecedores, s.saldo FROM customer c
    LEFT JOIN (SELECT s_nationkey AS k, COUNT(*) AS fornecedores, {rnd('SUM(s_acctbal)', 2)} AS saldo FROM supplier WHERE s_acctbal > 3000 GROUP BY 1) s
      ON s.k = CASE WHEN c.c_mktsegment = 'BUILDING' THEN NULL ELSE c.c_nationkey END""", digits=2)
def enrich_left(spark, d):
    """Left join to an aggregate; a NULL or unknown key keeps its row."""
    c = table(spark, d, "customer").select(
        "c_custkey", "c_nationkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey")).alias("k"))
    s = table(spark, d, "supplier").filter("s_acctbal > 3000").groupBy(F.col("s_nationkey").alias("k")).agg(
        F.count("*").alias("fornecedores"), F.round(F.sum("s_acctbal"), 2).alias("saldo"))
    return J.enrich(c, s, "k").drop("k")


@register("star_join_revenue", f"""
    SELECT r.r_name, p.p_type, {rnd('SUM(l.l_extendedprice * (1 - l.l_discount))', 2)} AS receita, COUNT(*) AS itens
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2""", digits=2)
def star_join_revenue(spark, d):
    """Fact summed per key pair before it meets its dimensions."""
    l = table(spark, d, "lineitem").withColumn("receita", F.col("l_extendedprice") * (1 - F.col("l_discount"))).withColumn("itens", F.lit(1))
    sums = J.pre_aggregate(l, ["l_partkey", "l_suppkey"], ["receita", "itens"])
    place = (
        table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
        .join(table(spark, d, "nation"), "n_nationkey").withColumnRenamed("n_regionkey", "r_regionkey")
        .join(table(spark, d, "region"), "r_regionkey").select("l_suppkey", "r_name")
    )
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return J.star_join(sums, (part, "l_partkey"), (place, "l_suppkey")).groupBy("r_name", "p_type").agg(
        F.round(F.sum("receita"), 2).alias("receita"), F.sum("itens").alias("itens"))


_ORPHANS = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"), ("labels", "doc_id", "documents", "doc_id"),
    ("documents", "doc_id", "labels", "doc_id"), ("events", "user_id", "supplier", "s_suppkey"),
]


def _orphan_sql(f, c, dim, k):
    return f"""SELECT '{f}.{c} -> {dim}' AS verificacao, COUNT(*) AS chaves_orfas, COUNT(DISTINCT {c}) AS valores_distintos_orfaos,
        COUNT(*) FILTER (WHERE {c} IS NULL) AS linhas_com_chave_nula FROM {f} WHERE {c} IS NULL OR {c} NOT IN (SELECT {k} FROM {dim})"""


@register("orphan_keys", " UNION ALL ".join(_orphan_sql(*o) for o in _ORPHANS))
def orphan_keys(spark, d):
    """Orphan rows of every foreign key of the given tables, with some that do have orphans."""
    names = {t for o in _ORPHANS for t in (o[0], o[2])}
    return keys.check_foreign_keys({t: table(spark, d, t) for t in names}, _ORPHANS)


_UNIQUE = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "part": ["p_name"], "customer": ["c_custkey"],
           "documents": ["text"], "events": ["ts"]}


def _unique_sql(t, k):
    cols = ", ".join(k)
    return f"""SELECT '{t}' AS tabela, '{" + ".join(k)}' AS chave_negocio, SUM(n)::BIGINT AS linhas, COUNT(*) AS chaves_distintas, (SUM(n) - COUNT(*))::BIGINT AS linhas_duplicadas,
        0::BIGINT AS linhas_com_chave_nula, {rnd('100.0 * (SUM(n) - COUNT(*)) / SUM(n)', 4)} AS pct_duplicado FROM (SELECT {cols}, COUNT(*) AS n FROM {t} GROUP BY {cols})"""


@register("key_uniqueness", " UNION ALL ".join(_unique_sql(t, k) for t, k in _UNIQUE.items()))
def key_uniqueness(spark, d):
    """Rows, distinct key tuples and duplicates, over whole tables and whole texts."""
    return keys.check_uniqueness({t: table(spark, d, t) for t in _UNIQUE}, _UNIQUE)


_GOLD_SQL = {
    "dim_data": "d_data", "dim_hora": "d_hora", "dim_subsistema": "d_subsistema", "dim_fonte_geracao": "d_fonte", "dim_usina": "d_usina",
    "fato_geracao_horaria": "f_geracao", "fato_balanco_horario": "f_balanco", "fato_restricao_horaria": "f_restricao",
    "fato_reservatorio_diario": "f_reservatorio",
}


@register("gold_primary_keys", " UNION ALL ".join(
    f"SELECT *, CASE WHEN linhas_duplicadas = 0 THEN 'OK' ELSE 'ATENÇÃO' END AS status FROM ({_unique_sql(_GOLD_SQL[t], k).replace(repr(_GOLD_SQL[t]), repr(t))})"
    for t, k in keys.PRIMARY_KEYS.items()))
def gold_primary_keys(spark, d):
    return keys.check_primary_keys(layers.star_tables(spark, d))


@register("gold_foreign_keys", " UNION ALL ".join(
    _orphan_sql(_GOLD_SQL[f], c, _GOLD_SQL[dim], k).replace(f"'{_GOLD_SQL[f]}.{c} -> {_GOLD_SQL[dim]}'", f"'{f}.{c} -> {dim}'")
    for f, c, dim, k in keys.FOREIGN_KEYS))
def gold_foreign_keys(spark, d):
    """All fourteen declared foreign keys."""
    return keys.check_foreign_keys(layers.star_tables(spark, d))


@register("role_playing_join", f"""
    SELECT a.dia, {rnd('a.v', 2)} AS total_aberto, {rnd('b.v', 2)} AS total_fechado FROM
      (SELECT {key('o_orderdate')} AS dia, SUM(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) a
      JOIN (SELECT {key('o_orderdate')} AS dia, SUM(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) b ON a.dia = b.dia""", digits=2)
def role_playing_join(spark, d):
    """The same fact under two roles, side by side, from one aggregation."""
    daily = table(spark, d, "orders").groupBy(M.date_key("o_orderdate").alias("dia"), "o_orderstatus").agg(
        F.round(F.sum("o_totalprice"), 2).alias("v"))
    return J.roles_by_key(daily, "dia", "o_orderstatus", {"aberto": "O", "fechado": "F"}, {"total": "v"})
