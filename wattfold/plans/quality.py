"""Data-quality checks. Each table is read once per check family: many measures in one aggregate, then unpivoted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattfold.config import RECONCILE_TOLERANCE, SENTINELS
from wattfold.functions.clean import CLEANERS, clean_text, has_newline, is_sentinel, visible_null
from wattfold.functions.measures import month_text, ratio_pct
from wattfold.operators.ranking import approximate_quantiles, exact_quantiles
from wattfold.operators.selection import FIT, quantiles_of
from wattfold.operators.sketches import rank_bounds, within_rank_error
from wattfold.operators.stats import safe_corr


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rows_of(df: DataFrame, groups: Mapping[str, Mapping[str, Column]], label: str) -> DataFrame:
    """One aggregate holding every group's measures, turned into one row per group."""
    names = list(next(iter(groups.values())))
    wide = df.agg(*[F.struct(*[m.alias(n) for n, m in ms.items()]).alias(f"_{i}") for i, ms in enumerate(groups.values())])
    entries = [F.struct(F.lit(g).alias(label), *[F.col(f"_{i}")[n].alias(n) for n in names]) for i, g in enumerate(groups)]
    return wide.select(F.inline(F.array(*entries)))


# --- completeness --------------------------------------------------------------
def profile(df: DataFrame, table: str, distinct="approx", sentinels=SENTINELS) -> DataFrame:
    """One row per business column (names not starting with ``_``): NULLs, no-value texts, share absent, distinct values.

    Columns become rows inside each task and are reduced there to one row per column, so one small compiled loop serves
    any number of columns. ``distinct="approx"`` uses sketches. ``distinct="exact"`` counts each (column, value) pair
    first, so a value that fills a third of a column is one row per task before the shuffle.
    """
    columns = [c for c in df.columns if not c.startswith("_")]
    pairs = df.select(*columns).unpivot([], columns, "coluna", "valor")
    absent = is_sentinel(F.trim("valor"), sentinels)
    if distinct == "approx":
        rows = pairs.groupBy("coluna").agg(
            F.count(F.lit(1)).alias("linhas_totais"),
            F.count_if(F.col("valor").isNull()).alias("qtd_nulos"),
            F.count_if(absent).alias("qtd_sentinelas"),
            F.approx_count_distinct("valor").alias("qtd_valores_distintos"),
        )
    else:
        counted = pairs.groupBy("coluna", "valor").agg(F.count("*").alias("n"))
        rows = counted.groupBy("coluna").agg(
            F.sum("n").alias("linhas_totais"),
            F.sum(F.when(F.col("valor").isNull(), F.col("n")).otherwise(0)).alias("qtd_nulos"),
            F.sum(F.when(absent, F.col("n")).otherwise(0)).alias("qtd_sentinelas"),
            F.count("valor").alias("qtd_valores_distintos"),
        )
    missing = F.col("qtd_nulos") + F.col("qtd_sentinelas")
    return rows.select(
        F.lit(table).alias("tabela"), "coluna", "linhas_totais", "qtd_nulos", "qtd_sentinelas",
        F.round(F.try_divide(F.lit(100.0) * missing, F.col("linhas_totais")), 4).alias("pct_ausente"),
        "qtd_valores_distintos",
    )


def profile_tables(tables: Mapping[str, DataFrame], distinct="approx") -> DataFrame:
    return stack([profile(df, name, distinct) for name, df in tables.items()])


def absent_columns(profiled: DataFrame) -> DataFrame:
    """Columns with any absence, most absent first within each table."""
    return (
        profiled.filter(F.col("pct_ausente") > 0)
        .orderBy("tabela", F.desc("pct_ausente"), "coluna")
        .select("tabela", "coluna", "linhas_totais", "qtd_nulos", "qtd_sentinelas", "pct_ausente")
    )


def synthesis(profiled: DataFrame) -> DataFrame:
    """Per table: columns that are complete, partly absent (< 50%) and structurally absent."""
    pct = F.col("pct_ausente")
    return profiled.groupBy("tabela").agg(
        F.count("*").alias("atributos"),
        F.count_if(pct == 0).alias("completos"),
        F.count_if((pct > 0) & (pct < 50)).alias("ausencia_parcial"),
        F.count_if(pct >= 50).alias("ausencia_estrutural"),
        F.max("linhas_totais").alias("linhas"),
    )


def availability_by_month(df: DataFrame, ts: str, fields: Mapping[str, str]) -> DataFrame:
    """Share of rows with each field filled, per month; ``fields`` maps output name to column."""
    shares = [ratio_pct(F.count(c), F.count(F.lit(1)), 2).alias(name) for name, c in fields.items()]
    return df.groupBy(month_text(ts).alias("mes")).agg(*shares)


# --- conversion ------------------------------------------------------------------
# --- fixed values: columns whose conversion is tested, by dataset: (column, kind)
CAST_TESTS = {
    "balanco_energia_subsistema": [
        ("din_instante", "timestamp"), ("val_carga", "decimal"), ("val_gereolica", "decimal"),
        ("val_gersolar", "decimal"), ("val_intercambio", "decimal"),
    ],
    "ear_diario_subsistema": [("ear_data", "date"), ("ear_verif_subsistema_percentual", "decimal")],
    "restricao_coff_eolica": [
        ("din_instante", "timestamp"), ("val_geracao", "decimal"), ("val_geracaoreferencia", "decimal"),
        ("val_geracaonaorealizadaapurada", "decimal"),
    ],
    "restricao_coff_fotovoltaica": [("din_instante", "timestamp"), ("val_geracao", "decimal")],
    "capacidade_geracao": [("val_potenciaefetiva", "decimal"), ("dat_entradaoperacao", "date")],
}
TARGET_TYPE = {"timestamp": "timestamp", "date": "date", "decimal": "double", "int": "int"}


def cast_loss(df: DataFrame, table: str, tests: Sequence[tuple[str, str]]) -> DataFrame:
    """Values present before conversion and NULL after it, all tested columns in one pass."""
    def measures(column, kind):
        return {
            "ja_ausente": F.count_if(clean_text(column).isNull()),
            "nulo_depois": F.count_if(CLEANERS[kind](column).isNull()),
            "total": F.count(F.lit(1)),
        }
    rows = _rows_of(df, {c: measures(c, k) for c, k in tests}, "coluna")
    kinds = F.create_map(*[F.lit(x) for c, k in tests for x in (c, TARGET_TYPE[k])])
    lost = F.col("nulo_depois") - F.col("ja_ausente")
    return rows.select(
        F.lit(table).alias("tabela"), "coluna", kinds[F.col("coluna")].alias("tipo_alvo"), "ja_ausente",
        lost.alias("perdidos_no_cast"),
        F.coalesce(F.round(F.try_divide(F.lit(100.0) * lost, F.col("total")), 6), F.lit(0.0)).alias("pct_perdido"),
        F.when(lost == 0, "OK").otherwise("ATENÇÃO").alias("status"),
    )


def cast_loss_tables(tables: Mapping[str, DataFrame], tests=CAST_TESTS) -> DataFrame:
    return stack([cast_loss(tables[t], t, ts) for t, ts in tests.items()])


# --- domains and text ----------------------------------------------------------------
# --- fixed values: categorical columns listed, by dataset
DOMAIN_COLUMNS = {
    "restricao_coff_eolica": ["cod_razaorestricao", "cod_origemrestricao"],
    "restricao_coff_fotovoltaica": ["cod_razaorestricao", "cod_origemrestricao"],
    "balanco_energia_subsistema": ["id_subsistema"],
    "ear_diario_subsistema": ["id_subsistema"],
    "capacidade_geracao": ["nom_tipousina"],
}


def domain_values(df: DataFrame, table: str, columns: Sequence[str], allowed: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Every value of the given columns with its count; with ``allowed`` also whether the value is expected."""
    values = df.select(*[visible_null(c).alias(c) for c in columns]).unpivot([], list(columns), "coluna", "valor")
    counted = values.groupBy("coluna", "valor").agg(F.count("*").alias("linhas"))
    result = counted.select(F.lit(table).alias("tabela"), "coluna", "valor", "linhas")
    if allowed:
        expected = reduce(lambda a, b: a | b, [
            (F.col("coluna") == c) & F.col("valor").isin(list(vs)) for c, vs in allowed.items()
        ])
        result = result.withColumn("esperado", expected | ~F.col("coluna").isin(list(allowed)))
    return result


def domain_head(domain: DataFrame, k=12) -> DataFrame:
    """The ``k`` most frequent values of a single column's listing."""
    return domain.orderBy(F.desc("linhas"), "valor").limit(k)


def padding(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with surrounding spaces, and distinct values with and without them, from one count per (column, value)."""
    pairs = df.select(*columns).unpivot([], list(columns), "atributo", "valor")
    counted = pairs.groupBy("atributo", "valor").agg(F.count("*").alias("n"))
    text = F.trim("valor")
    per_text = counted.groupBy("atributo", text.alias("_texto")).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("valor") != text, F.col("n")).otherwise(0)).alias("extra"),
        F.count("valor").alias("brutos"),
    )
    return per_text.groupBy("atributo").agg(
        F.sum("n").alias("linhas"),
        F.sum("extra").alias("com_espaco_extra"),
        F.sum("brutos").alias("distintos_sem_trim"),
        F.count("_texto").alias("distintos_com_trim"),
    )


def newline_records(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Records with a line break inside any of the given texts."""
    broken = reduce(lambda a, b: a | b, [F.coalesce(has_newline(c), F.lit(False)) for c in columns])
    return df.agg(F.lit(table).alias("tabela"), F.count_if(broken).alias("registros_com_quebra"))


# --- consistency between rows and columns ------------------------------------------------
def total_equals_parts(df: DataFrame, key: str, is_total: str, value: str) -> DataFrame:
    """Total rows against the sum of their parts, in one aggregation per key instead of a self-join."""
    per_key = df.groupBy(key).agg(
        F.sum(F.when(~F.col(is_total), F.col(value))).alias("partes"),
        F.count_if(~F.col(is_total)).alias("_n_partes"),
        F.max(F.when(F.col(is_total), F.col(value))).alias("total"),
        F.count_if(F.col(is_total)).alias("_n_total"),
    )
    both = per_key.filter((F.col("_n_partes") > 0) & (F.col("_n_total") > 0))
    return both.agg(
        F.count("*").alias("horas_comparadas"),
        F.round(F.max(F.abs(F.col("total") - F.col("partes"))), 3).alias("maior_diferenca_mwmed"),
        F.round(F.try_divide(F.sum("total"), F.sum("partes")), 6).alias("razao_sin_sobre_soma"),
    )


def balance_identity(balance: DataFrame) -> DataFrame:
    """Does exchange equal generation minus load? Correlation and errors per subsystem."""
    surplus = F.col("ger_total_mwmed") - F.col("carga_mwmed")
    return balance.filter(~F.col("eh_agregado")).groupBy("id_subsistema").agg(
        F.round(safe_corr("intercambio_mwmed", surplus), 4).alias("correlacao"),
        F.round(F.avg(F.abs(F.col("intercambio_mwmed") - surplus)), 1).alias("erro_medio_abs_mwmed"),
        F.round(F.avg(F.abs("intercambio_mwmed")), 1).alias("intercambio_medio_abs_mwmed"),
    )


def _night_solar() -> Column:
    return F.hour("din_instante").between(0, 4) & (F.col("ger_solar_mwmed") > 1)


def balance_rules() -> dict[str, Column]:
    return {
        "Carga negativa": F.col("carga_mwmed") < 0,
        "Geração hidráulica negativa": F.col("ger_hidraulica_mwmed") < 0,
        "Geração térmica negativa": F.col("ger_termica_mwmed") < 0,
        "Geração eólica negativa": F.col("ger_eolica_mwmed") < 0,
        "Geração solar negativa": F.col("ger_solar_mwmed") < 0,
        "Geração solar > 1 MWmed entre 0h e 4h": _night_solar(),
    }


def storage_rules() -> dict[str, Column]:
    return {"EAR fora de 0-100%": (F.col("ear_percentual") < 0) | (F.col("ear_percentual") > 100)}


def curtailment_rules() -> dict[str, Column]:
    declared = F.col("houve_restricao")
    return {
        "Geração da usina > disponibilidade + 5%": F.col("geracao_mwmed") > F.col("disponibilidade_mwmed") * 1.05,
        "Geração negativa em usina": F.col("geracao_mwmed") < 0,
        "Corte calculado negativo": F.col("corte_mwh") < 0,
        "Restrição declarada sem energia cortada": declared & (F.col("corte_mwh") == 0),
        "Restrição declarada sem geração de referência": declared & F.col("geracao_referencia_mwmed").isNull(),
    }


def check_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations and evaluated rows of every rule of a table, in one pass. A rule is true for a bad row."""
    return _rows_of(
        df, {name: {"violacoes": F.count_if(bad), "avaliados": F.count(F.lit(1))} for name, bad in rules.items()}, "teste"
    )


def plausibility(balance: DataFrame, storage: DataFrame, curtailment: DataFrame) -> DataFrame:
    """The twelve plausibility rules, one scan per table."""
    return stack([
        check_rules(balance.filter(~F.col("eh_agregado")), balance_rules()),
        check_rules(storage.filter(~F.col("eh_agregado")), storage_rules()),
        check_rules(curtailment, curtailment_rules()),
    ])


def night_solar(balance: DataFrame) -> DataFrame:
    """Solar generation before dawn, by subsystem and year."""
    return (
        balance.filter(~F.col("eh_agregado") & _night_solar())
        .groupBy("id_subsistema", F.year("din_instante").alias("ano"))
        .agg(
            F.count("*").alias("horas"),
            F.round(F.avg("ger_solar_mwmed"), 1).alias("media_mwmed"),
            F.round(F.max("ger_solar_mwmed"), 1).alias("maximo_mwmed"),
        )
    )


def night_solar_share(balance: DataFrame) -> DataFrame:
    """Share of all solar energy that appears before dawn."""
    night = F.sum(F.when(_night_solar(), F.col("ger_solar_mwmed")).otherwise(0.0))
    return balance.filter(~F.col("eh_agregado")).agg(
        ratio_pct(night, F.sum("ger_solar_mwmed"), 4).alias("pct_da_energia_solar_na_madrugada")
    )


# --- agreement with an outside figure ---------------------------------------------------
def reconcile(
    df: DataFrame, computed: str, official: str, computed_energy: str, official_energy: str, declared: str,
    tolerance=RECONCILE_TOLERANCE,
) -> DataFrame:
    """Computed against official measure: totals, difference, correlation, rows apart, rows present on one side only."""
    has = F.col(official).isNotNull()
    total, other = F.sum(computed_energy), F.sum(official_energy)
    return df.agg(
        F.count("*").alias("registros"),
        F.round(total, 1).alias("corte_calculado_mwh"),
        F.round(other, 1).alias("gnra_oficial_mwh"),
        ratio_pct(total - other, other, 4).alias("diferenca_pct"),
        F.round(safe_corr(computed, official), 6).alias("correlacao"),
        F.count_if(has & (F.abs(F.col(computed) - F.col(official)) > tolerance)).alias("registros_divergentes"),
        F.count_if(has & ~F.col(declared)).alias("gnra_sem_razao_declarada"),
        F.count_if(~has & F.col(declared)).alias("razao_sem_gnra"),
    )


def reconcile_curtailment(curtailment: DataFrame) -> DataFrame:
    return reconcile(
        curtailment, "corte_mwmed", "gnra_oficial_mwmed", "corte_mwh", "gnra_oficial_mwh", "houve_restricao"
    )


def official_without_reason(curtailment: DataFrame) -> DataFrame:
    """Where the official figure exists without a declared reason, by source and month."""
    return (
        curtailment.filter(F.col("gnra_oficial_mwmed").isNotNull() & ~F.col("houve_restricao"))
        .groupBy("cod_fonte", month_text("din_instante").alias("mes"))
        .agg(F.count("*").alias("registros"), F.round(F.sum("gnra_oficial_mwh"), 1).alias("gnra_mwh"))
    )


def presence_by_category(df: DataFrame, category: str, field: str, name: str, empty="<sem restrição>") -> DataFrame:
    """How often a field is filled, per category."""
    return df.groupBy(visible_null(category, empty, trim=False).alias("razao")).agg(
        F.count("*").alias("registros"),
        F.count(field).alias(name),
        ratio_pct(F.count(field), F.count(F.lit(1)), 2).alias("pct"),
    )


# --- outliers --------------------------------------------------------------------------
_QUARTILES = {"q1": 0.25, "mediana": 0.5, "q3": 0.75}


def outliers(df: DataFrame, column: str, label: str, condition: str | Column | None = None, exact=False) -> DataFrame:
    """Tukey fences at 1.5 interquartile ranges: one pass for the quartiles, one that counts rows outside."""
    if condition is not None:
        df = df.filter(condition)
    values = df.select(F.col(column).alias("x")).filter(F.col("x").isNotNull())
    find = exact_quantiles if exact else approximate_quantiles
    quartiles = find(values, "x", _QUARTILES)
    spread = F.col("q3") - F.col("q1")
    fences = quartiles.select(
        F.struct(  # nine digits: a fence that falls on a value must not move with the last bit
            "q1", "mediana", "q3", F.round(F.col("q1") - 1.5 * spread, 9).alias("lo"),
            F.round(F.col("q3") + 1.5 * spread, 9).alias("hi"),
        )
    ).scalar()
    counted = values.withColumn("f", fences).agg(
        F.count("*").alias("n"),
        F.min("x").alias("minimo"),
        F.max("x").alias("maximo"),
        F.first("f").alias("f"),
        F.count_if((F.col("x") < F.col("f.lo")) | (F.col("x") > F.col("f.hi"))).alias("qtd_outliers"),
    )
    return counted.select(*_outlier_columns(label, {c: F.col(c) for c in counted.columns}))


def _outlier_columns(label: str, at: Mapping[str, Column]) -> list[Column]:
    f = at["f"]
    return [
        F.lit(label).alias("metrica"), at["n"].alias("n"), F.round(at["minimo"], 3).alias("minimo"), F.round(f["q1"], 3).alias("q1"),
        F.round(f["mediana"], 3).alias("mediana"), F.round(f["q3"], 3).alias("q3"), F.round(at["maximo"], 3).alias("maximo"),
        F.round(f["lo"], 3).alias("limite_inferior"), F.round(f["hi"], 3).alias("limite_superior"), at["qtd_outliers"].alias("qtd_outliers"),
        F.coalesce(F.round(F.try_divide(F.lit(100.0) * at["qtd_outliers"], at["n"]), 3), F.lit(0.0)).alias("pct_outliers"),
    ]


def outliers_together(df: DataFrame, measures: Sequence[tuple[str, str, str]], fit: int = FIT) -> DataFrame:
    """Tukey fences from exact quartiles for all (column, label, condition) measures of a table.

    ``quantiles_of`` finds the quartiles of all measures in the same few scans, run when called; the result is one more scan.
    """
    values = {label: F.when(F.expr(condition), F.col(column)).cast("double") for column, label, condition in measures}
    quartiles = quantiles_of(df, values, _QUARTILES, fit)
    aggs, rows = [], []
    for i, (label, x) in enumerate(values.items()):
        q = {name: F.lit(quartiles[label][name]).cast("double") for name in _QUARTILES}
        spread = q["q3"] - q["q1"]
        fences = q | {"lo": F.round(q["q1"] - 1.5 * spread, 9), "hi": F.round(q["q3"] + 1.5 * spread, 9)}
        found = {"n": F.count(x), "minimo": F.min(x), "maximo": F.max(x), "qtd_outliers": F.count_if((x < fences["lo"]) | (x > fences["hi"]))}
        aggs += [value.alias(f"{name}_{i}") for name, value in found.items()]
        rows.append(F.struct(*_outlier_columns(label, {name: F.col(f"{name}_{i}") for name in found} | {"f": F.struct(*[v.alias(k) for k, v in fences.items()])})))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def outlier_measures(balance: DataFrame, storage: DataFrame, curtailment: DataFrame) -> list[tuple[DataFrame, str, str, str]]:
    """The six measures checked for outliers: frame, column, label and condition."""
    real = "NOT eh_agregado"
    return [
        (balance, "carga_mwmed", "Carga do subsistema (MWmed)", real),
        (balance, "ger_eolica_mwmed", "Geração eólica (MWmed)", real),
        (balance, "ger_solar_mwmed", "Geração solar (MWmed)", real),
        (balance, "intercambio_mwmed", "Intercâmbio (MWmed)", real),
        (storage, "ear_percentual", "EAR (%)", real),
        (curtailment, "corte_mwh", "Corte por usina / 30 min (MWh)", "houve_restricao"),
    ]


def outlier_report(balance: DataFrame, storage: DataFrame, curtailment: DataFrame, exact=False) -> DataFrame:
    """Quartiles, fences and outliers of every measure; exact ones table by table."""
    measures = outlier_measures(balance, storage, curtailment)
    if not exact:
        return stack([outliers(*t) for t in measures])
    return stack([outliers_together(t, [m[1:] for m in measures if m[0] is t]) for t in (balance, storage, curtailment)])


def quartile_ranks(df: DataFrame, column: str, label: str, condition: str, accuracy=1000) -> DataFrame:
    """One row: the rows of a measure, and whether each sketched quartile has the rank that the sketch's accuracy promises."""
    values = df.filter(condition).select(F.col(column).alias("x")).filter(F.col("x").isNotNull())
    found = approximate_quantiles(values, "x", _QUARTILES, accuracy).select(F.struct(*_QUARTILES).alias("q")).scalar()
    counted = values.withColumn("q", found).agg(
        F.count("*").alias("n"),
        *[side.alias(f"{name}_{k}") for name in _QUARTILES for k, side in enumerate(rank_bounds("x", F.col("q")[name]))],
    )
    near = [within_rank_error(F.col(f"{name}_0"), F.col(f"{name}_1"), p, 1 / accuracy, F.col("n")).alias(f"{name}_no_erro") for name, p in _QUARTILES.items()]
    return counted.select(F.lit(label).alias("metrica"), "n", *near)


# --- coverage over time -----------------------------------------------------------------
def coverage_by_year(df: DataFrame, ts: str, entity: str) -> DataFrame:
    """Days, rows, entities and rows per day and entity of each year, counted from (year, day, entity) groups."""
    cells = df.groupBy(F.year(ts).alias("ano"), F.to_date(ts).alias("_dia"), F.col(entity).alias("_e")).agg(
        F.count("*").alias("_n")
    )
    return cells.groupBy("ano").agg(
        F.count_distinct("_dia").alias("dias_com_dado"),
        F.sum("_n").alias("registros"),
        F.count_distinct("_e").alias("subsistemas"),
    ).withColumn(
        "registros_por_dia_subsistema",
        F.round(F.try_divide(F.col("registros"), F.col("dias_com_dado") * F.col("subsistemas")), 2),
    )


def coverage_by_month(df: DataFrame, ts: str, entity: str) -> DataFrame:
    """Entities and rows per entity of each month, counted from (month, entity) groups."""
    cells = df.groupBy(month_text(ts).alias("mes"), F.col(entity).alias("_e")).agg(F.count("*").alias("_n"))
    return cells.groupBy("mes").agg(F.count("_e").alias("usinas"), F.sum("_n").alias("registros")).withColumn(
        "registros_por_usina", F.round(F.try_divide(F.col("registros"), F.col("usinas")), 1)
    )


# --- fixed values: seconds of a step's unit
_UNIT_SECONDS = {"SECOND": 1, "MINUTE": 60, "HOUR": 3600, "DAY": 86400}
#: Slots of a range: what one window or one generated array holds at most.
RANGE_SLOTS = 1024


def _grid(df: DataFrame, slot: str, step: str):
    """(slot as seconds, a column's slot ``n`` steps after ``_first``) for a date or timestamp column and a step like ``30 MINUTES``."""
    amount, _, unit = step.upper().partition(" ")
    unit = unit.strip().removesuffix("S")
    if unit not in _UNIT_SECONDS or int(amount) < 1:
        raise ValueError(f"a step is a number of seconds, minutes, hours or days: {step}")
    size, is_date = int(amount) * _UNIT_SECONDS[unit], df.schema[slot].dataType.typeName() == "date"
    if is_date and size % 86400:
        raise ValueError(f"dates lie whole days apart: {step}")
    seconds = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long") * 86400 + (
        F.lit(0) if is_date else F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c))
    if is_date:
        return size, seconds, lambda n: F.date_add("_first", (F.col(n) * (size // 86400)).cast("int"))
    return size, seconds, lambda n: F.expr(f"_first + INTERVAL {size} SECONDS * {n}")


def _placed(df: DataFrame, entity: str, slot: str, step: str) -> DataFrame:
    """Present slots of each entity with their number on its grid ``_n``, the one present before it and the range they lie in.

    Slots off the grid that an entity's first slot sets, and NULL slots, do not count. Neighbours are found inside ranges of the
    grid; a range's first slot follows the last one of the range before, taken from one row per entity and range.
    """
    size, seconds, _ = _grid(df, slot, step)
    present = df.filter(F.col(slot).isNotNull()).select(F.col(entity).alias("_e"), F.col(slot).alias("_slot")).distinct()
    first = present.groupBy(F.col("_e").alias("_owner")).agg(F.min("_slot").alias("_first"))
    away = seconds(F.col("_slot")) - seconds(F.col("_first"))
    placed = present.join(first, F.col("_e").eqNullSafe(F.col("_owner"))).withColumn("_away", away).filter(F.col("_away") % size == 0)
    placed = placed.select("_e", "_slot", "_first", F.expr(f"_away DIV {size}").alias("_n")).withColumn("_r", F.expr(f"_n DIV {RANGE_SLOTS}"))
    edges = placed.groupBy(F.col("_e").alias("_owner"), F.col("_r").alias("_range")).agg(F.max("_n").alias("_last"))
    edges = edges.withColumn("_edge", F.lag("_last").over(Window.partitionBy("_owner").orderBy("_range"))).drop("_last")
    near = F.lag("_n").over(Window.partitionBy("_e", "_r").orderBy("_n"))
    met = placed.withColumn("_near", near).join(edges, F.col("_e").eqNullSafe(F.col("_owner")) & (F.col("_r") == F.col("_range")))
    return met.select("_e", "_slot", "_first", "_n", "_r", F.coalesce("_near", "_edge").alias("_before"))


def gaps(df: DataFrame, entity: str, slot: str, step: str) -> DataFrame:
    """Slots missing between each entity's first and last slot.

    What is missing is told from neighbouring present slots; expected slots are never generated, and a long gap is
    written out in pieces, so neither a long series nor a long gap is held in one row or task.
    """
    _, _, at = _grid(df, slot, step)
    holes = _placed(df, entity, slot, step).filter(F.col("_n") - F.col("_before") > 1)
    pieces = holes.select("_e", "_first", "_n", F.explode(F.sequence(F.col("_before") + 1, F.col("_n") - 1, F.lit(RANGE_SLOTS))).alias("_a"))
    missing = pieces.select("_e", "_first", F.explode(F.sequence("_a", F.least(F.col("_a") + (RANGE_SLOTS - 1), F.col("_n") - 1))).alias("_k"))
    return missing.select(F.col("_e").alias(entity), at("_k").alias(slot))


def present_runs(df: DataFrame, entity: str, slot: str, step: str) -> DataFrame:
    """Unbroken runs of present slots of each entity: first and last slot, slots, and slots missing before the run (0 for the first).

    Runs are numbered inside ranges and shifted by the runs that earlier ranges begin, so a run crosses ranges freely.
    """
    placed = _placed(df, entity, slot, step)
    begins = F.col("_before").isNull() | (F.col("_n") - F.col("_before") > 1)
    placed = placed.withColumn("_begins", begins.cast("long"))
    per_range = placed.groupBy(F.col("_e").alias("_owner"), F.col("_r").alias("_range")).agg(F.sum("_begins").alias("_c"))
    earlier = Window.partitionBy("_owner").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_range.select("_owner", "_range", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_e", "_r").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    numbered = placed.withColumn("_local", F.sum("_begins").over(inside)).join(
        shifts, F.col("_e").eqNullSafe(F.col("_owner")) & (F.col("_r") == F.col("_range")))
    missing = F.when(F.col("_begins") == 1, F.col("_n") - F.col("_before") - 1)
    return numbered.groupBy("_e", (F.col("_local") + F.col("_shift")).alias("_run")).agg(
        F.min("_slot").alias("inicio"), F.max("_slot").alias("fim"), F.count("*").alias("slots"),
        F.coalesce(F.max(missing), F.lit(0)).alias("faltantes_antes"),
    ).select(F.col("_e").alias(entity), "inicio", "fim", "slots", "faltantes_antes")


# --- aggregate rows against real rows -----------------------------------------------------
def totals_overview(balance: DataFrame) -> DataFrame:
    """Load, subsystems and period of real rows and of total rows."""
    return balance.groupBy("eh_agregado").agg(
        F.count_distinct("id_subsistema").alias("qtd_subsistemas"),
        F.round(F.sum("carga_mwmed") / 1e6, 2).alias("carga_total_tw_med"),
        F.min("din_instante").alias("inicio"),
        F.max("din_instante").alias("fim"),
    )
