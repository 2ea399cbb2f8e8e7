"""Reports answering the eight business questions, over the gold model.

Rates are always recomputed from their sums. Reports by plant sum the fact per plant before they join the plant
dimension, which may be too large to broadcast; the other dimensions are bounded by the calendar or by metadata.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattfold.config import HOUSEHOLD_KWH_PER_MONTH, RATE_FLOOR_MWH
from wattfold.functions.clean import collapse_whitespace
from wattfold.functions.measures import ratio_pct
from wattfold.operators.aggregate import best_row, pivot_matrix, share_of_total, share_within
from wattfold.operators.joins import pre_aggregate, roles_by_key, star_join
from wattfold.operators.ranking import consecutive_blocks, exact_quantiles, series_rank, top_k, top_k_share
from wattfold.operators.stats import correlation_label, linear_trend, safe_corr, without_season
from wattfold.plans.documentation import require_additive

REASON_COLUMNS = {"rel": "corte_rel_mwh", "cnf": "corte_cnf_mwh", "ene": "corte_ene_mwh", "par": "corte_par_mwh"}
ORIGIN_COLUMNS = {"sis": "corte_sis_mwh", "loc": "corte_loc_mwh"}


@dataclass(frozen=True)
class Star:
    """The gold tables a report reads."""

    dim_data: DataFrame
    dim_hora: DataFrame
    dim_subsistema: DataFrame
    dim_fonte_geracao: DataFrame
    dim_usina: DataFrame
    fato_geracao_horaria: DataFrame
    fato_balanco_horario: DataFrame
    fato_restricao_horaria: DataFrame
    fato_reservatorio_diario: DataFrame


def _days(star: Star, *columns: str) -> tuple[DataFrame, str]:
    return star.dim_data.select("sk_data", *columns), "sk_data"


def _sources(star: Star, *columns: str) -> tuple[DataFrame, str]:
    return star.dim_fonte_geracao.select("sk_fonte", *columns), "sk_fonte"


def _sums(star: Star, table: str, keys: list[str], measures: list[str], where: Column | None = None) -> DataFrame:
    """Sums of additive measures of a fact per key combination."""
    require_additive(table, measures)
    fact = getattr(star, table)
    return pre_aggregate(fact if where is None else fact.filter(where), keys, measures)


def _gwh(column: str) -> Column:
    return F.sum(column) / 1000.0


# --- context ----------------------------------------------------------------------------------
def last_complete_year(star: Star, calendar_aware=False) -> DataFrame:
    """One row: the year before the last one; with ``calendar_aware`` the last one itself if it reaches 31 December."""
    limits = star.dim_data.agg(F.max("data").alias("d"))
    year = F.year("d")
    whole = (F.month("d") == 12) & (F.dayofmonth("d") == 31)
    chosen = F.when(whole, year).otherwise(year - 1) if calendar_aware else year - 1
    return limits.select(chosen.alias("ultimo_ano_completo"))


def context(star: Star) -> DataFrame:
    """One row: first and last instant of each fact family, number of plants, last complete year."""
    limits = star.fato_balanco_horario.agg(
        F.min("din_instante").alias("ini_balanco"), F.max("din_instante").alias("fim_balanco")
    )
    cut = star.fato_restricao_horaria
    return limits.select(
        "*",
        cut.agg(F.min("din_instante")).scalar().alias("ini_coff"),
        cut.agg(F.max("din_instante")).scalar().alias("fim_coff"),
        star.dim_usina.agg(F.count("*")).scalar().alias("qtd_usinas"),
        last_complete_year(star).scalar().alias("ultimo_ano_completo"),
    )


# --- generation mix -----------------------------------------------------------------------------
def mix_by_subsystem(star: Star) -> DataFrame:
    """Year × subsystem × source: TWh and share of the subsystem's year."""
    joined = star_join(
        star.fato_geracao_horaria.select("sk_data", "sk_subsistema", "sk_fonte", "geracao_mwh"),
        _days(star, "ano"),
        (star.dim_subsistema.select("sk_subsistema", "nom_subsistema"), "sk_subsistema"),
        _sources(star, "nom_fonte"),
    )
    mwh = joined.groupBy("ano", "nom_subsistema", "nom_fonte").agg(F.sum("geracao_mwh").alias("mwh"))
    shared = share_within(mwh, "mwh", ["ano", "nom_subsistema"], "pct_da_geracao", 2, bounded=True)
    return shared.select(
        "ano", "nom_subsistema", "nom_fonte", F.round(F.col("mwh") / 1e6, 3).alias("geracao_twh"), "pct_da_geracao"
    )


def mix_national(star: Star) -> DataFrame:
    """Year × source: share of the national year."""
    joined = star_join(
        star.fato_geracao_horaria.select("sk_data", "sk_fonte", "geracao_mwh"), _days(star, "ano"), _sources(star, "nom_fonte")
    )
    mwh = joined.groupBy("ano", "nom_fonte").agg(F.sum("geracao_mwh").alias("mwh"))
    return share_within(mwh, "mwh", ["ano"], "pct", 2, bounded=True).select("ano", "nom_fonte", "pct")


def _change(mix: DataFrame, star: Star, keys: list[str], pct: str) -> DataFrame:
    """Share in the first year and in the last complete year, per key; an absent year counts as 0."""
    first = mix.agg(F.min("ano")).scalar()
    last = last_complete_year(star).scalar()
    marked = mix.select("*", first.alias("_first"), last.alias("_last"))
    a = F.coalesce(F.max(F.when(F.col("ano") == F.col("_first"), F.col(pct))), F.lit(0.0))
    b = F.coalesce(F.max(F.when(F.col("ano") == F.col("_last"), F.col(pct))), F.lit(0.0))
    return marked.groupBy(*keys).agg(a.alias("pct_inicial"), b.alias("pct_final")).withColumn(
        "variacao_pp", F.round(F.col("pct_final") - F.col("pct_inicial"), 2)
    )


def mix_change(star: Star) -> DataFrame:
    """Change of each source's share by subsystem, in percentage points."""
    return _change(mix_by_subsystem(star), star, ["nom_subsistema", "nom_fonte"], "pct_da_geracao")


def mix_change_national(star: Star) -> DataFrame:
    return _change(mix_national(star), star, ["nom_fonte"], "pct")


def intermittent_change(star: Star) -> DataFrame:
    """Change of the combined share of intermittent sources by subsystem."""
    kinds = star.dim_fonte_geracao.filter("eh_intermitente").select("nom_fonte")
    parts = mix_change(star).join(kinds, "nom_fonte", "inner")
    return parts.groupBy("nom_subsistema").agg(
        *[F.round(F.sum(c), 2).alias(c) for c in ("pct_inicial", "pct_final", "variacao_pp")]
    )


def largest_rise(star: Star, source="Solar") -> DataFrame:
    """The subsystem where a source's share rose most."""
    return mix_change(star).filter(F.col("nom_fonte") == source).agg(
        best_row("variacao_pp", ["nom_subsistema", "variacao_pp"], True, ["nom_subsistema"]).alias("r")
    ).select("r.*")


# --- intermittent share by month and hour -----------------------------------------------------------
def _balance_of(star: Star, subsystem: str, year: Column | int | None, *day_columns: str, since=False) -> DataFrame:
    """Balance rows of one subsystem, of one year or from a year on; the last complete year if none is given."""
    year = last_complete_year(star).scalar() if year is None else year
    days = star.dim_data.filter((F.col("ano") >= year) if since else (F.col("ano") == year))
    rows = star.fato_balanco_horario.filter(F.col("sk_subsistema") == subsystem)
    return rows.join(days.select("sk_data", *day_columns), "sk_data", "inner")


def heat_cells(star: Star, subsystem="NE", year=None) -> DataFrame:
    """Month × hour: intermittent generation as a percentage of load, from sums."""
    rows = _balance_of(star, subsystem, year, "mes", "nom_mes")
    rows = rows.join(star.dim_hora.select("sk_hora", "hora"), "sk_hora", "inner")
    return rows.groupBy("mes", "nom_mes", "hora").agg(
        ratio_pct(F.sum("ger_intermitente_mwmed"), F.sum("carga_mwmed"), 2).alias("pct_intermitente")
    )


def heat_matrix(star: Star, subsystem="NE", year=None) -> DataFrame:
    """The same as a matrix: one row per month, one column per hour."""
    return pivot_matrix(heat_cells(star, subsystem, year), ["mes"], "hora", range(24), "pct_intermitente", "h", fill=None)


def annual_intermittent(star: Star, subsystem="NE", year=None) -> DataFrame:
    """One row: the year's ratio, and the share of hours in which intermittent generation exceeded load."""
    above = F.avg(F.when(F.col("pct_intermitente_sobre_carga") > 100, 1.0).otherwise(0.0))
    return _balance_of(star, subsystem, year).agg(
        ratio_pct(F.sum("ger_intermitente_mwmed"), F.sum("carga_mwmed"), 2).alias("pct_anual"),
        F.round(100.0 * above, 2).alias("pct_horas_acima_100"),
    )


def heat_extremes(star: Star, subsystem="NE", year=None) -> DataFrame:
    """One row: highest and lowest cell, and the number of cells above 100%."""
    cells = heat_cells(star, subsystem, year)
    at, tie = ["mes", "nom_mes", "hora", "pct_intermitente"], ["mes", "hora"]
    both = cells.agg(
        best_row("pct_intermitente", at, True, tie).alias("pico"),
        best_row("pct_intermitente", at, False, tie).alias("vale"),
        F.count_if(F.col("pct_intermitente") > 100).alias("celulas_acima_100"),
        F.count("*").alias("celulas"),
    )
    return both.select(
        *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("pico", "vale") for c in at],
        "celulas_acima_100", "celulas",
    )


def heat_means(star: Star, by: list[str], subsystem="NE", year=None) -> DataFrame:
    """Unweighted mean of the cells by hour or by month."""
    cells = heat_cells(star, subsystem, year)
    return cells.groupBy(*by).agg(F.round(F.avg("pct_intermitente"), 4).alias("media_pct"))


# --- curtailed volume ------------------------------------------------------------------------------
def monthly_rate(star: Star) -> DataFrame:
    """Month × source: curtailed, official, generated and reference energy, and the curtailment rate."""
    measures = ["corte_mwh", "gnra_oficial_mwh", "geracao_mwh", "geracao_referencia_mwh"]
    joined = star_join(
        star.fato_restricao_horaria.select("sk_data", "sk_fonte", *measures), _days(star, "ano_mes"), _sources(star, "nom_fonte")
    )
    return joined.groupBy("ano_mes", "nom_fonte").agg(
        F.round(_gwh("corte_mwh"), 2).alias("corte_gwh"),
        F.round(_gwh("gnra_oficial_mwh"), 2).alias("gnra_oficial_gwh"),
        F.round(_gwh("geracao_mwh"), 2).alias("geracao_gwh"),
        F.round(_gwh("geracao_referencia_mwh"), 2).alias("referencia_gwh"),
        ratio_pct(F.sum("corte_mwh"), F.sum("geracao_referencia_mwh"), 2).alias("taxa_corte_pct"),
    )


def curtailment_matrix(star: Star) -> DataFrame:
    """Month × source matrix of curtailed GWh; a missing cell is 0."""
    return pivot_matrix(
        monthly_rate(star).select("ano_mes", "nom_fonte", "corte_gwh"), ["ano_mes"], "nom_fonte", ["Eólica", "Solar"],
        "corte_gwh", "corte_gwh_",
    )


def period_totals(star: Star) -> DataFrame:
    """One row: totals of the whole period."""
    return star.fato_restricao_horaria.agg(
        _gwh("corte_mwh").alias("corte_gwh"),
        _gwh("gnra_oficial_mwh").alias("gnra_gwh"),
        _gwh("geracao_mwh").alias("geracao_gwh"),
        _gwh("geracao_referencia_mwh").alias("referencia_gwh"),
        ratio_pct(F.sum("corte_mwh"), F.sum("geracao_referencia_mwh")).alias("taxa_pct"),
        F.count_distinct("sk_data").alias("dias"),
    )


def totals_by_source(star: Star) -> DataFrame:
    sums = _sums(star, "fato_restricao_horaria", ["sk_fonte"], ["corte_mwh", "geracao_referencia_mwh"])
    named = star_join(sums, _sources(star, "nom_fonte")).groupBy("nom_fonte").agg(
        F.sum("corte_mwh").alias("mwh"), F.sum("geracao_referencia_mwh").alias("ref")
    )
    shared = share_of_total(named, "mwh", "pct_do_corte")
    return shared.select(
        "nom_fonte", (F.col("mwh") / 1000.0).alias("corte_gwh"), ratio_pct(F.col("mwh"), F.col("ref")).alias("taxa_pct"),
        "pct_do_corte",
    )


def _by_year_month(star: Star) -> DataFrame:
    """Curtailed and reference energy per calendar month: one row per month of the period."""
    joined = star_join(
        star.fato_restricao_horaria.select("sk_data", "corte_mwh", "geracao_referencia_mwh"), _days(star, "ano", "mes")
    )
    return pre_aggregate(joined, ["ano", "mes"], ["corte_mwh", "geracao_referencia_mwh"])


def same_months_by_year(star: Star) -> DataFrame:
    """Each year up to the last month of the last year, with the change from the year before."""
    months = _by_year_month(star)
    last = months.agg(F.max(F.struct("ano", "mes")).alias("u")).select("u.mes").scalar()
    years = (
        months.withColumn("ate_mes", last).filter(F.col("mes") <= F.col("ate_mes")).groupBy("ano").agg(
            _gwh("corte_mwh").alias("corte_gwh"),
            ratio_pct(F.sum("corte_mwh"), F.sum("geracao_referencia_mwh")).alias("taxa_pct"),
            F.max("ate_mes").alias("ate_mes"),
        )
    )
    before = F.lag("corte_gwh").over(Window.orderBy("ano"))  # one row per year
    return years.withColumn("variacao_pct", ratio_pct(F.col("corte_gwh") - before, before))


def yearly_totals(star: Star) -> DataFrame:
    """Full-year curtailed energy and rate."""
    return _by_year_month(star).groupBy("ano").agg(
        _gwh("corte_mwh").alias("corte_gwh"),
        ratio_pct(F.sum("corte_mwh"), F.sum("geracao_referencia_mwh")).alias("taxa_pct"),
        F.count("*").alias("meses"),
    )


def month_extremes(star: Star, household_kwh=HOUSEHOLD_KWH_PER_MONTH) -> DataFrame:
    """One row: months with the most and least curtailment, months covered, and the equivalent number of households."""
    months = monthly_rate(star).groupBy("ano_mes").agg(F.round(F.sum("corte_gwh"), 2).alias("corte_gwh"))
    at, tie = ["ano_mes", "corte_gwh"], ["ano_mes"]
    total = period_totals(star).select("corte_gwh").scalar()
    both = months.agg(
        best_row("corte_gwh", at, True, tie).alias("a"),
        best_row("corte_gwh", at, False, tie).alias("b"),
        F.count("*").alias("meses"),
    )
    return both.select(
        F.col("a.ano_mes").alias("maior_mes"), F.col("a.corte_gwh").alias("maior_gwh"),
        F.col("b.ano_mes").alias("menor_mes"), F.col("b.corte_gwh").alias("menor_gwh"), "meses",
        F.try_divide(total * 1e6 / household_kwh, F.col("meses")).alias("domicilios"),
    )


# --- where -----------------------------------------------------------------------------------------
def _per_plant(star: Star) -> DataFrame:
    return _sums(star, "fato_restricao_horaria", ["sk_usina"], ["corte_mwh", "geracao_referencia_mwh"])


def _concentration(sums: DataFrame, keys: list[str], plants: Column) -> DataFrame:
    grouped = sums.groupBy(*keys).agg(
        F.sum("corte_mwh").alias("mwh"), F.sum("geracao_referencia_mwh").alias("ref"), plants.alias("usinas")
    )
    shared = share_of_total(grouped, "mwh", "pct_do_corte_nacional", 2)
    return shared.select(
        *keys, F.round(F.col("mwh") / 1000.0, 1).alias("corte_gwh"), "pct_do_corte_nacional",
        ratio_pct(F.col("mwh"), F.col("ref"), 2).alias("taxa_corte_pct"), "usinas",
    )


def concentration_by_subsystem(star: Star) -> DataFrame:
    sums = _sums(star, "fato_restricao_horaria", ["sk_subsistema", "sk_usina"], ["corte_mwh", "geracao_referencia_mwh"])
    named = star_join(sums, (star.dim_subsistema.select("sk_subsistema", "nom_subsistema"), "sk_subsistema"))
    return _concentration(named, ["nom_subsistema"], F.count_distinct("sk_usina"))


def concentration_by_state(star: Star) -> DataFrame:
    plants = star.dim_usina.select("sk_usina", "nom_estado", "id_estado")
    return _concentration(star_join(_per_plant(star), (plants, "sk_usina")), ["nom_estado", "id_estado"], F.count("*"))


def concentration_by_plant(star: Star, merge_names=False) -> DataFrame:
    """One row per plant; with ``merge_names`` plants that share name, source and state are one row."""
    names = ["nom_usina", "nom_fonte", "id_estado"]
    keys = names if merge_names else ["sk_usina", *names]
    sums = star_join(_per_plant(star), (star.dim_usina.select("sk_usina", *names), "sk_usina"))
    grouped = sums.groupBy(*keys).agg(F.sum("corte_mwh").alias("mwh"))
    return share_of_total(grouped, "mwh", "pct_do_corte_nacional", 2).select(
        *keys, F.round(F.col("mwh") / 1000.0, 1).alias("corte_gwh"), "pct_do_corte_nacional"
    )


def top_plants(star: Star, k=10) -> DataFrame:
    return top_k(concentration_by_plant(star), "corte_gwh", k, ["sk_usina"])


def concentration_summary(star: Star) -> DataFrame:
    """One row: leading subsystem, the one with the highest rate, shares of the top 3 states and top 10 plants."""
    subs = concentration_by_subsystem(star)
    states = concentration_by_state(star)
    plants = concentration_by_plant(star)
    lead = subs.agg(
        best_row("corte_gwh", ["nom_subsistema", "pct_do_corte_nacional"], True, ["nom_subsistema"]).alias("l"),
        best_row("taxa_corte_pct", ["nom_subsistema", "taxa_corte_pct"], True, ["nom_subsistema"]).alias("t"),
    )
    return lead.select(
        F.col("l.nom_subsistema").alias("lider"), F.col("l.pct_do_corte_nacional").alias("pct_lider"),
        F.col("t.nom_subsistema").alias("maior_taxa"), F.col("t.taxa_corte_pct").alias("taxa_maior"),
        F.round(top_k(states, "corte_gwh", 3, ["id_estado"]).agg(F.sum("pct_do_corte_nacional")).scalar(), 2).alias("pct_top3_estados"),
        F.round(top_k(plants, "corte_gwh", 10, ["sk_usina"]).agg(F.sum("pct_do_corte_nacional")).scalar(), 2).alias("pct_top10_usinas"),
        plants.agg(F.count_if(F.col("corte_gwh") > 0)).scalar().alias("usinas_com_corte"),
        plants.agg(F.count("*")).scalar().alias("usinas"),
    )


def top_plants_share(star: Star, k=10) -> DataFrame:
    return top_k_share(_per_plant(star), "corte_mwh", k, ["sk_usina"], "pct_do_total")


# --- why -------------------------------------------------------------------------------------------
def reason_totals(star: Star) -> DataFrame:
    """One row: GWh by reason and origin, shares by reason, grid share (REL + CNF), systemic share, and the conclusion."""
    sums = star.fato_restricao_horaria.agg(*[_gwh(c).alias(k) for k, c in {**REASON_COLUMNS, **ORIGIN_COLUMNS}.items()])
    total = F.col("rel") + F.col("cnf") + F.col("ene") + F.col("par")
    shares = sums.select(
        "*",
        *[ratio_pct(F.col(k), total).alias(f"pct_{k}") for k in REASON_COLUMNS],
        ratio_pct(F.col("rel") + F.col("cnf"), total).alias("pct_rede"),
        ratio_pct(F.col("sis"), F.col("sis") + F.col("loc")).alias("pct_sistemica"),
    )
    return shares.withColumn("conclusao", conclusion("pct_ene", "pct_rede"))


def conclusion(energetic: str, grid: str) -> Column:
    """Predominant motive: energetic only if it outweighs both grid reasons together."""
    return F.when(F.col(energetic) > F.col(grid), "ENERGÉTICO").otherwise("REDE")


def _reasons_by_month(star: Star) -> DataFrame:
    fact = star.fato_restricao_horaria.select("sk_data", *REASON_COLUMNS.values())
    return star_join(fact, _days(star, "ano_mes")).groupBy("ano_mes").agg(
        *[_gwh(c).alias(k) for k, c in REASON_COLUMNS.items()]
    )


def reasons_by_month(star: Star) -> DataFrame:
    """Month × reason, each month as percentages of its total."""
    total = F.col("rel") + F.col("cnf") + F.col("ene") + F.col("par")
    return _reasons_by_month(star).select("ano_mes", *[ratio_pct(F.col(k), total, 1).alias(k) for k in REASON_COLUMNS])


def reasons_by_source(star: Star) -> DataFrame:
    sums = _sums(star, "fato_restricao_horaria", ["sk_fonte"], ["corte_mwh", *REASON_COLUMNS.values()])
    named = star_join(sums, _sources(star, "nom_fonte"))
    return named.groupBy("nom_fonte").agg(*[
        ratio_pct(F.sum(REASON_COLUMNS[k]), F.sum("corte_mwh"), 1).alias(f"pct_{k}") for k in ("rel", "cnf", "ene")
    ])


def top_descriptions(readings: DataFrame, k=12, width: int | None = None, reason: str | None = None) -> DataFrame:
    """Descriptions with the most curtailed energy, grouped by the whole text with white space collapsed.

    ``width`` only adds a short text for display; different descriptions with one beginning stay apart.
    """
    rows = readings.filter(F.col("dsc_restricao").isNotNull())
    if reason:
        rows = rows.filter(F.col("cod_razao_restricao") == reason)
    grouped = rows.groupBy("cod_razao_restricao", collapse_whitespace("dsc_restricao").alias("descricao")).agg(
        F.round(_gwh("corte_mwh"), 1).alias("corte_gwh")
    )
    found = top_k(grouped, "corte_gwh", k, ["cod_razao_restricao", "descricao"])
    return found if width is None else found.withColumn("descricao_curta", F.substring("descricao", 1, width))


def reasons_by_block(star: Star, blocks=3) -> DataFrame:
    """Energetic and grid shares in consecutive blocks of months, with the change since the first block."""
    months = consecutive_blocks(_reasons_by_month(star), "ano_mes", blocks, "bloco")
    sums = months.groupBy("bloco").agg(
        F.min("ano_mes").alias("de"), F.max("ano_mes").alias("ate"), *[F.sum(k).alias(k) for k in REASON_COLUMNS]
    )
    total = F.col("rel") + F.col("cnf") + F.col("ene") + F.col("par")
    shares = sums.select(
        "bloco", "de", "ate", ratio_pct(F.col("ene"), total).alias("pct_ene"),
        ratio_pct(F.col("rel") + F.col("cnf"), total).alias("pct_rede"),
    )
    first = F.first("pct_ene").over(Window.orderBy("bloco"))  # one row per block
    return shares.withColumn("tendencia_pp", F.col("pct_ene") - first)


# --- storage hypothesis --------------------------------------------------------------------------------
def storage_series(star: Star, subsystem="NE", roles=None) -> DataFrame:
    """Daily curtailment of a subsystem beside the storage level of two subsystems: one row per day."""
    roles = roles or {"ne": "NE", "se": "SE"}
    cut = _sums(
        star, "fato_restricao_horaria", ["sk_data"], ["corte_mwh", "geracao_referencia_mwh"], F.col("sk_subsistema") == subsystem
    )
    levels = roles_by_key(
        star.fato_reservatorio_diario, "sk_data", "sk_subsistema", roles,
        {"ear": "ear_percentual", "faixa": "faixa_armazenamento"},
    )
    joined = star_join(cut, _days(star, "data", "mes"), (levels, "sk_data"))
    return joined.select(
        "data", "mes", (F.col("corte_mwh") / 1000.0).alias("corte_gwh"),
        ratio_pct(F.col("corte_mwh"), F.col("geracao_referencia_mwh")).alias("taxa_corte_pct"),
        "ear_ne", "ear_se", "faixa_ne",
    )


def storage_correlations(star: Star) -> DataFrame:
    """One row per storage series: Pearson, Spearman and deseasonalised Pearson against curtailment, and in words.

    The daily series is bounded by the calendar, so ranks and season means are windows over it and it is computed once.
    """
    measured = ["corte_gwh", "ear_ne", "ear_se"]
    daily = storage_series(star).select("mes", *measured).select(
        "*", *[without_season(c, "mes").alias(f"{c}_des") for c in measured], *[series_rank(c).alias(f"{c}_posto") for c in measured]
    )
    wide = daily.agg(F.count("*").alias("dias"), *[
        safe_corr(f"{name}{kind}", f"corte_gwh{kind}").alias(f"{name}{kind}") for name in measured[1:] for kind in ("", "_posto", "_des")
    ])
    rows = wide.select(F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("serie"), "dias", F.col(name).alias("pearson"), F.col(f"{name}_posto").alias("spearman"),
            F.col(f"{name}_des").alias("pearson_dessazonalizado"),
        )
        for name in measured[1:]
    ])))
    return rows.withColumn("qualificacao", correlation_label(F.col("pearson")))


def storage_trend(star: Star, series="ear_ne") -> DataFrame:
    """Linear trend of curtailment over a storage series."""
    return storage_series(star).agg(*linear_trend("corte_gwh", series))


def storage_bands(star: Star) -> DataFrame:
    """Days, mean storage, mean curtailment and mean rate by storage band."""
    return storage_series(star).groupBy("faixa_ne").agg(
        F.count("data").alias("dias"), F.avg("ear_ne").alias("ear_medio"), F.avg("corte_gwh").alias("corte_medio_gwh"),
        F.avg("taxa_corte_pct").alias("taxa_media_pct"),
    )


def storage_hypothesis(star: Star, threshold=0.3) -> DataFrame:
    """One row: the hypothesis holds if some raw and some deseasonalised correlation exceed the threshold."""
    return storage_correlations(star).agg(
        F.max("pearson").alias("maior_pearson"), F.max("pearson_dessazonalizado").alias("maior_dessazonalizado")
    ).withColumn(
        "hipotese_sustentada",
        F.coalesce((F.col("maior_pearson") > threshold) & (F.col("maior_dessazonalizado") > threshold), F.lit(False)),
    )


# --- net load ------------------------------------------------------------------------------------------
def _share_true(flag: str) -> Column:
    return 100.0 * F.avg(F.when(F.col(flag), 1.0).otherwise(0.0))


def hourly_profile(star: Star, subsystem="NE", since=None) -> DataFrame:
    """By hour of day: share of hours with negative net load, and mean load, intermittent, net load and exchange."""
    rows = _balance_of(star, subsystem, since, since=True)
    rows = rows.join(star.dim_hora.select("sk_hora", "hora"), "sk_hora", "inner")
    return rows.groupBy("hora").agg(
        F.count("*").alias("horas_observadas"),
        F.round(_share_true("carga_liquida_negativa"), 2).alias("pct_horas_negativas"),
        F.round(F.avg("carga_mwmed"), 1).alias("carga_media_mwmed"),
        F.round(F.avg("ger_intermitente_mwmed"), 1).alias("intermitente_media_mwmed"),
        F.round(F.avg("carga_liquida_mwmed"), 1).alias("carga_liquida_media_mwmed"),
        F.round(F.avg("intercambio_mwmed"), 1).alias("intercambio_medio_mwmed"),
    )


def negative_hours_by_year(star: Star, subsystem="NE") -> DataFrame:
    rows = star.fato_balanco_horario.filter(F.col("sk_subsistema") == subsystem)
    return star_join(rows, _days(star, "ano")).groupBy("ano").agg(
        F.count_if("carga_liquida_negativa").alias("horas_negativas"),
        F.round(_share_true("carga_liquida_negativa"), 2).alias("pct_horas_negativas"),
    )


def net_load_summary(star: Star, subsystem="NE", since=None) -> DataFrame:
    """One row: extremes, correlation with exchange, and exchange when net load is negative or not."""
    negative = F.col("carga_liquida_negativa")
    return _balance_of(star, subsystem, since, since=True).agg(
        F.count("*").alias("horas"),
        F.count_if(negative).alias("negativas"),
        _share_true("carga_liquida_negativa").alias("pct_negativas"),
        F.min("carga_liquida_mwmed").alias("carga_liquida_min"),
        F.max("intercambio_mwmed").alias("intercambio_max"),
        safe_corr("carga_liquida_mwmed", "intercambio_mwmed").alias("corr_cl_interc"),
        F.avg(F.when(negative, F.col("intercambio_mwmed"))).alias("interc_quando_negativa"),
        F.avg(F.when(~negative, F.col("intercambio_mwmed"))).alias("interc_quando_positiva"),
        (100.0 * F.avg(F.when(F.col("intercambio_mwmed") > 0, 1.0).otherwise(0.0))).alias("pct_horas_exportando"),
    )


def curtailment_by_net_load(star: Star, subsystem="NE") -> DataFrame:
    """One row: curtailment against net load, hour by hour. The fact is summed per hour before the join."""
    cut = _sums(star, "fato_restricao_horaria", ["sk_data", "sk_hora"], ["corte_mwh"], F.col("sk_subsistema") == subsystem)
    load = star.fato_balanco_horario.filter(F.col("sk_subsistema") == subsystem).select(
        "sk_data", "sk_hora", "carga_liquida_mwmed", "carga_liquida_negativa"
    )
    negative, cut_mwh = F.col("carga_liquida_negativa"), F.col("corte_mwh")
    result = cut.join(load, ["sk_data", "sk_hora"], "inner").agg(
        safe_corr("corte_mwh", "carga_liquida_mwmed").alias("corr_corte_cl"),
        F.avg(F.when(negative, cut_mwh)).alias("corte_medio_negativa"),
        F.avg(F.when(~negative, cut_mwh)).alias("corte_medio_positiva"),
        ratio_pct(F.sum(F.when(negative, cut_mwh).otherwise(0.0)), F.sum("corte_mwh")).alias("pct_corte_em_negativas"),
    )
    return result.withColumn("razao_medias", F.try_divide(F.col("corte_medio_negativa"), F.col("corte_medio_positiva")))


def profile_extremes(star: Star, subsystem="NE", since=None) -> DataFrame:
    """One row: hours of lowest mean net load and highest mean exchange, and the hours with positive mean net load."""
    hours = hourly_profile(star, subsystem, since)
    return hours.agg(
        best_row("carga_liquida_media_mwmed", ["hora"], False, ["hora"])["hora"].alias("hora_mais_negativa"),
        best_row("intercambio_medio_mwmed", ["hora"], True, ["hora"])["hora"].alias("hora_maior_exportacao"),
        F.array_join(
            F.sort_array(F.collect_list(F.when(F.col("carga_liquida_media_mwmed") > 0, F.format_string("%02dh", "hora")))), ", "
        ).alias("horas_positivas"),
    )


# --- who loses -------------------------------------------------------------------------------------------
def rate_ranking(star: Star, floor=RATE_FLOOR_MWH, merge_names=False) -> DataFrame:
    """Curtailment rate of every plant whose reference energy exceeds a floor."""
    names = ["nom_usina", "nom_fonte", "id_estado", "potencia_instalada_mw"]
    keys = names if merge_names else ["sk_usina", *names]
    sums = star_join(_per_plant(star), (star.dim_usina.select("sk_usina", *names), "sk_usina"))
    grouped = sums.groupBy(*keys).agg(F.sum("corte_mwh").alias("mwh"), F.sum("geracao_referencia_mwh").alias("ref"))
    return grouped.filter(F.col("ref") > floor).select(
        *keys, F.round(F.col("mwh") / 1000.0, 2).alias("corte_gwh"), F.round(F.col("ref") / 1000.0, 2).alias("referencia_gwh"),
        ratio_pct(F.col("mwh"), F.col("ref"), 2).alias("taxa_corte_pct"),
    )


def top_rates(star: Star, k=20, floor=RATE_FLOOR_MWH) -> DataFrame:
    return top_k(rate_ranking(star, floor), "taxa_corte_pct", k, ["sk_usina"])


def rate_distribution(star: Star, floor=RATE_FLOOR_MWH, high=20, low=5) -> DataFrame:
    """One row: median, 90th percentile and maximum rate, plants above and below thresholds, worst rate to system rate."""
    rates = rate_ranking(star, floor).select("taxa_corte_pct")
    quantiles = exact_quantiles(rates, "taxa_corte_pct", {"mediana": 0.5, "p90": 0.9})
    system = period_totals(star).select("taxa_pct").scalar()
    counts = rates.agg(
        F.count("*").alias("usinas"), F.max("taxa_corte_pct").alias("maxima"),
        F.count_if(F.col("taxa_corte_pct") > high).alias("acima_20"),
        F.count_if(F.col("taxa_corte_pct") < low).alias("abaixo_5"),
    )
    return counts.select(
        "usinas", quantiles.select("mediana").scalar().alias("mediana"), quantiles.select("p90").scalar().alias("p90"),
        "maxima", "acima_20", ratio_pct(F.col("acima_20"), F.col("usinas")).alias("pct_acima_20"), "abaixo_5",
        system.alias("media_sistema"), F.try_divide(F.col("maxima"), system).alias("maxima_sobre_media"),
    )


def top_rate_composition(star: Star, column: str, k=20, floor=RATE_FLOOR_MWH) -> DataFrame:
    """How the plants with the highest rates split by state or source."""
    return top_rates(star, k, floor).groupBy(column).agg(F.count("*").alias("usinas"))
