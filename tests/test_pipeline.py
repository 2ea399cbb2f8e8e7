"""The whole pipeline on a landing folder with planted rows."""

import pytest
from pyspark.sql import functions as F

from tests import grid
from wattfold.config import Layers, Period
from wattfold.operators.conform import dedupe
from wattfold.plans import documentation, keys, pipeline, quality, reports as P, silver
from wattfold.sources import files, tables as T
from wattfold.sources.bronze import CONTROL_COLUMNS, read_bronze

L = Layers("b", "s", "g")
WINDOW = Period(2021, 2026, "2025-01", "2026-08")


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    landing = grid.land(tmp_path_factory.mktemp("landing"))
    return landing, pipeline.run(spark, landing, L, WINDOW)


def gold(spark, name):
    return spark.table(f"g.{name}")


def test_files_outside_the_window_are_not_selected(spark, ran):
    landing, result = ran
    names = {r.arquivo for r in files.selected_files(files.list_files(spark, landing), WINDOW).collect()}
    assert names == {"BALANCO_2025.csv", "BALANCO_2026.csv", "EAR_2025.csv", "EOLICA_2025_06.csv", "SOLAR_2025_06.csv", "CAPACIDADE.csv"}
    assert result["manifesto"]["linhas"] == 6


def test_without_a_window_every_named_file_is_selected(spark, ran):
    landing, _ = ran
    names = {r.arquivo for r in files.selected_files(files.list_files(spark, landing)).collect()}
    assert {"BALANCO_2019.csv", "EOLICA_2024_12.csv", "BALANCO_2025.csv", "SOLAR_2025_06.csv"} <= names and len(names) == 8


def test_manifest_marks_known_files_and_finds_new_ones(spark, ran):
    landing, _ = ran
    pipeline.run_manifest(spark, landing, L, WINDOW)
    m = spark.table("b._manifesto_ingestao")
    assert {r.status for r in m.collect()} == {"cache"} and m.columns[-1] == "_ingest_ts"
    assert files.new_files(files.selected_files(files.list_files(spark, landing), WINDOW), m).count() == 0
    assert files.new_files(files.list_files(spark, landing), m).count() == 2
    assert files.manifest_summary(m).filter("dataset = 'balanco_energia_subsistema'").first().arquivos == 2


def test_bronze_is_text_with_provenance_and_whole_records(spark, ran):
    _, result = ran
    assert result["bronze"] == {
        "balanco_energia_subsistema": 5 * grid.HOURS + 3, "ear_diario_subsistema": 12, "restricao_coff_eolica": 10,
        "restricao_coff_fotovoltaica": 4, "capacidade_geracao": 5}
    wind = spark.table("b.restricao_coff_eolica")
    assert {t for c, t in wind.dtypes if c not in CONTROL_COLUMNS} == {"string"}
    assert wind.filter(F.col("dsc_restricao") == 'Limite "LT 500 kV"\nAçu; III').count() == 2
    assert wind.filter(F.col("_source_file").contains("EOLICA_2025_06") & (F.col("_source_dataset") == "restricao_coff_eolica")).count() == 10


def test_header_names_are_used_without_a_contract(spark, ran):
    landing, _ = ran
    df = read_bronze(spark, f"{landing}/capacidade_geracao/*.csv", "capacidade_geracao")
    assert df.columns == spark.table("b.capacidade_geracao").columns


def test_silver_counts_come_from_the_write(spark, ran):
    s = ran[1]["silver"]
    assert s["balanco_subsistema_horario"] == {
        "linhas_lidas": 243, "instante_invalido": 1, "linhas": 240, "duplicatas_removidas": 2}
    assert s["restricao_coff_usina"]["duplicatas_removidas"] == 1 and s["restricao_coff_usina"]["instante_invalido"] == 1
    assert s["capacidade_instalada_ug"]["potencia_ausente"] == 1
    rejects = {(r.tabela, r.medida): r.linhas for r in pipeline.silver_rejects(spark, L).collect()}
    assert rejects["balanco_subsistema_horario", "instante_invalido"] == 1 and rejects["ear_subsistema_diario", "linhas_aceitas"] == 12


def test_silver_balance_keeps_the_later_file_and_guards_zero_load(spark, ran):
    b = spark.table("s.balanco_subsistema_horario")
    row = b.filter("id_subsistema = 'N' AND din_instante = '2025-06-01 01:00:00'").first()
    assert row.carga_mwmed == 0 and row.pct_intermitente_sobre_carga is None and row._source_file.endswith("2026.csv")
    assert row.ger_termica_mwmed is None and row.ger_total_mwmed == 70
    total = b.filter("eh_agregado").agg(F.count("*"), F.max("carga_mwmed")).first()
    assert tuple(total) == (48, 1000.0)
    check = quality.total_equals_parts(b, "din_instante", "eh_agregado", "carga_mwmed").first()
    assert (check.horas_comparadas, check.maior_diferenca_mwmed) == (48, 100.0)  # the planted zero


def test_curtailment_rules(spark, ran):
    r = {x.din_instante.strftime("%H:%M"): x for x in spark.table("s.restricao_coff_usina").filter("id_ons = 'W1' AND day(din_instante) = 1").collect()}
    assert [r[t].corte_mwh for t in ("00:00", "00:30", "01:00", "01:30", "02:00", "03:00")] == [10.0, 5.0, 0.0, 0.0, 0.0, 1.0]
    assert r["03:00"].dsc_razao_restricao == "Parecer de acesso" and r["01:30"].houve_restricao is False
    assert r["00:00"].num_minutos_ene == 30 and r["00:00"].ceg is None


def test_curtailment_fact_splits_energy_by_reason(spark, ran):
    f = {x.sk_hora: x for x in gold(spark, "fato_restricao_horaria").filter("sk_usina = 'W1' AND sk_data = 20250601").collect()}
    assert (f[0].corte_mwh, f[0].corte_ene_mwh, f[0].corte_cnf_mwh, f[0].corte_sis_mwh, f[0].corte_loc_mwh) == (15.0, 10.0, 5.0, 10.0, 5.0)
    assert f[0].cod_razao_predominante == "CNF" and f[0].intervalos_com_restricao == 2 and f[0].taxa_corte_pct == 60.0
    assert f[3].intervalos_no_periodo == 1 and f[3].corte_par_mwh == 1.0
    assert f[2].taxa_corte_pct is None and f[2].houve_restricao_na_hora
    parts = gold(spark, "fato_restricao_horaria").agg(
        F.sum("corte_mwh"), F.sum(F.col("corte_rel_mwh") + F.col("corte_cnf_mwh") + F.col("corte_ene_mwh") + F.col("corte_par_mwh"))).first()
    assert parts[0] == parts[1] == 10 + 5 + 1 + 2 * 2.5


def test_dimensions(spark, ran):
    u = {x.sk_usina: x for x in gold(spark, "dim_usina").collect()}
    assert set(u) == {"W1", "W2", "S1"}
    assert (u["W1"].nom_usina, u["W1"].id_estado, u["W1"].tem_cadastro_capacidade) == ("Conj. A novo", "CE", False)
    assert (u["W2"].potencia_instalada_mw, u["W2"].qtd_unidades_geradoras) == (1011.0, 2)
    days = gold(spark, "dim_data").orderBy("data").collect()
    assert [d.sk_data for d in days] == [20250601, 20250602, 20250603]  # storage is a day longer
    assert (days[0].nom_dia_semana, days[0].estacao_ano, days[0].nom_mes, days[0].eh_fim_semana) == ("Domingo", "Outono", "Junho", True)
    assert gold(spark, "dim_hora").filter("eh_horario_ponta").count() == 3 and gold(spark, "dim_subsistema").count() == 5


def test_fact_grains(spark, ran):
    rows = ran[1]["gold"]
    assert rows["fato_geracao_horaria"] == 4 * grid.HOURS * 4 and rows["fato_balanco_horario"] == 4 * grid.HOURS
    bands = [r.faixa_armazenamento for r in gold(spark, "fato_reservatorio_diario").filter("sk_subsistema = 'NE'").orderBy("sk_data").collect()]
    assert bands == ["Baixo (30-50%)", "Confortável (50-70%)", "Alto (>70%)"]
    assert gold(spark, "fato_reservatorio_diario").filter("faixa_armazenamento IS NULL").count() == 2


def test_keys_hold(spark, ran):
    checks = pipeline.check_model(spark, L)
    assert {r.status for r in checks["chaves_primarias"].collect()} == {"OK"}
    foreign = checks["chaves_estrangeiras"].collect()
    assert len(foreign) == 14 and {r.chaves_orfas for r in foreign} == {0}
    dup = {r.tabela: r.linhas_duplicadas for r in checks["unicidade"].collect()}
    assert dup["restricao_coff_eolica"] == 1 and dup["ear_diario_subsistema"] == 0
    registry = keys.key_registry(spark)
    assert registry.groupBy("tipo").count().orderBy("tipo").collect()[0]["count"] == 14


def test_quality(spark, ran):
    loss = {(r.tabela, r.coluna): r for r in pipeline.check_model(spark, L)["conversao"].collect()}
    assert len(loss) == 15 and loss["ear_diario_subsistema", "ear_verif_subsistema_percentual"].perdidos_no_cast == 1
    assert loss["restricao_coff_eolica", "val_geracao"].status == "OK"
    rules = {r.teste: r.violacoes for r in pipeline.check_model(spark, L)["plausibilidade"].collect()}
    assert len(rules) == 12
    assert rules["Geração da usina > disponibilidade + 5%"] == 1 and rules["Geração negativa em usina"] == 1
    assert rules["Restrição declarada sem geração de referência"] == 1 and rules["Restrição declarada sem energia cortada"] == 2
    rec = quality.reconcile_curtailment(spark.table("s.restricao_coff_usina")).first()
    assert (rec.registros_divergentes, rec.gnra_sem_razao_declarada, rec.razao_sem_gnra) == (1, 1, 1)
    pads = {r.atributo: r for r in quality.padding(spark.table("b.capacidade_geracao"), ["cod_equipamento", "nom_usina"]).collect()}
    assert pads["cod_equipamento"].com_espaco_extra == 5 and pads["nom_usina"].com_espaco_extra == 0
    lines = quality.newline_records(spark.table("b.restricao_coff_fotovoltaica"), "x", ["dsc_restricao", "nom_pontoconexao"]).first()
    assert lines.registros_com_quebra == 4
    gaps = quality.gaps(spark.table("s.restricao_coff_usina").filter("id_ons = 'S1'"), "id_ons", "din_instante", "10 MINUTES")
    assert gaps.count() == 6


def test_profile_table(spark, ran):
    p = gold(spark, "qualidade_perfil_atributos")
    assert p.count() == 81
    r = p.filter("tabela = 'restricao_coff_eolica' AND coluna = 'ceg'").first()
    assert (r.linhas_totais, r.qtd_sentinelas, r.pct_ausente, r.qtd_valores_distintos) == (10, 9, 90.0, 2)
    exact = quality.profile(spark.table("b.restricao_coff_eolica"), "restricao_coff_eolica", distinct="exact").drop("qtd_valores_distintos")
    approx = quality.profile(spark.table("b.restricao_coff_eolica"), "restricao_coff_eolica").drop("qtd_valores_distintos")
    assert exact.exceptAll(approx).count() == 0 and exact.count() == approx.count() == 24
    s = quality.synthesis(p).filter("tabela = 'restricao_coff_eolica'").first()
    assert s.atributos == 24 == s.completos + s.ausencia_parcial + s.ausencia_estrutural


def test_reports_on_the_grid(spark, ran):
    star = pipeline.load_star(spark, L)
    month = {r.nom_fonte: r for r in P.monthly_rate(star).collect()}
    assert month["Solar"].corte_gwh == 0.01 and month["Eólica"].taxa_corte_pct == round(100 * 16 / 161, 2)
    assert {r.ano: r.horas_negativas for r in P.negative_hours_by_year(star).collect()} == {2025: 8}
    why = P.reason_totals(star).first()
    assert (why.ene * 1000, why.conclusao) == (15.0, "ENERGÉTICO")
    plants = {r.sk_usina for r in P.concentration_by_plant(star).collect()}
    assert plants == {"W1", "W2", "S1"}
    assert P.rate_ranking(star).count() == 0  # nobody reaches the floor
    hours = P.profile_extremes(star, since=2025).first()
    assert hours.hora_mais_negativa == 10 and "09h" in hours.horas_positivas and "10h" not in hours.horas_positivas
    assert P.last_complete_year(star).first()[0] == 2024 and P.last_complete_year(star, calendar_aware=True).first()[0] == 2024
    text = P.top_descriptions(spark.table("s.restricao_coff_usina")).first()
    assert text.descricao == 'Limite "LT 500 kV" Açu; III'


def test_catalog_comments(spark, ran):
    docs = {(r.tabela, r.coluna): r.descricao for r in T.catalog_columns(spark, "g").collect()}
    assert docs["fato_reservatorio_diario", "ear_verificada_mwmes"].startswith("[semiaditiva]")
    assert all(docs[t, c] for t, cs in documentation.COLUMN_COMMENTS.items() for c in cs if (t, c) in docs)
    assert spark.catalog.getTable("g.dim_usina").description == documentation.TABLE_COMMENTS["dim_usina"]
    assert documentation.documentation(spark).filter("coluna IS NULL").count() == len(documentation.TABLE_COMMENTS)
    assert T.list_tables(spark, "g").count() == 10
    with pytest.raises(ValueError):
        documentation.require_additive("fato_reservatorio_diario", ["ear_verificada_mwmes"])
    documentation.require_additive("fato_reservatorio_diario", ["ear_verificada_mwmes"], over_time=False)


def test_rerun_gives_the_same_tables(spark, ran):
    def content(t):
        columns = sorted(c for c in spark.table(t).columns if c != "_ingest_ts")
        return sorted(str(tuple(r)) for r in spark.table(t).select(*columns).collect())

    names = ["s.restricao_coff_usina", "g.fato_restricao_horaria", "g.dim_usina"]
    before = {t: content(t) for t in names}
    pipeline.run_silver(spark, L)
    pipeline.run_gold(spark, L, partition_facts=True)
    assert {t: content(t) for t in names} == before
    files_read = spark.table("g.fato_restricao_horaria").filter("sk_data = 20250602").inputFiles()
    assert files_read and all("sk_data=20250602" in f for f in files_read)


def test_shuffled_input_gives_the_same_silver(spark, ran):
    typed = silver.typed_curtailment(spark.table("b.restricao_coff_eolica"), spark.table("b.restricao_coff_fotovoltaica"))
    a = dedupe(typed, silver.CURTAILMENT_KEY, silver.LATEST)
    b = dedupe(typed.repartition(7, F.rand(3)), silver.CURTAILMENT_KEY, silver.LATEST)
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_rows_without_a_key_are_counted_rejects(spark):
    from wattfold.config import HEADERS
    from wattfold.operators.conform import reject_counts

    head = HEADERS["balanco_energia_subsistema"]
    rows = [{"id_subsistema": i, "din_instante": t} for i, t in (("N", "2025-06-01 00:00:00"), ("SIN", "2025-06-01 00:00:00"), ("-", "2025-06-01 00:00:00"), (None, "2025-06-01 00:00:00"), (None, "x"))]
    bronze = spark.createDataFrame([tuple(r.get(c) for c in head) + ("f",) for r in rows], ", ".join(f"`{c}` string" for c in [*head, "_source_file"])).withColumn("_ingest_ts", F.current_timestamp())
    typed = silver.typed_balance(bronze)
    assert sorted((r.id_subsistema or "", r.eh_agregado) for r in typed.collect()) == [("", False)] * 3 + [("N", False), ("SIN", True)]
    assert {r.id_subsistema for r in silver.silver_balance(bronze).collect()} == {"N", "SIN"}
    counts = {r.medida: r.linhas for r in reject_counts(typed, silver.no_key(silver.no_instant(), silver.BALANCE_KEY)).collect()}
    assert counts == {"linhas_lidas": 5, "linhas_aceitas": 2, "instante_invalido": 1, "chave_ausente": 2}


def test_every_landed_file_has_a_status(spark, ran):
    found = {r.arquivo: r.situacao for r in spark.table("b._situacao_arquivos").collect()}
    assert len(found) == 8 and found["BALANCO_2019.csv"] == found["EOLICA_2024_12.csv"] == "fora_da_janela"
    assert sum(x == "selecionado" for x in found.values()) == 6
    names = [("balanco_energia_subsistema", "BALANCO.csv"), ("restricao_coff_eolica", "EOLICA_2025.csv"), ("outro", "A_2025.csv")]
    some = spark.createDataFrame([(d, n, n, 1) for d, n in names], "dataset string, arquivo string, path string, bytes long")
    assert [r.situacao for r in files.file_status(some).orderBy("arquivo").collect()] == ["conjunto_desconhecido", "sem_periodo", "sem_periodo"]
