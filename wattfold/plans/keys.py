"""Declared keys of the gold model, and the jobs that check them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattfold.operators.joins import orphan_counts

# --- fixed values: table -> primary key --------------------------------------
PRIMARY_KEYS = {
    "dim_data": ["sk_data"],
    "dim_hora": ["sk_hora"],
    "dim_subsistema": ["sk_subsistema"],
    "dim_fonte_geracao": ["sk_fonte"],
    "dim_usina": ["sk_usina"],
}
_DIM_OF = {
    "sk_data": "dim_data", "sk_hora": "dim_hora", "sk_subsistema": "dim_subsistema",
    "sk_fonte": "dim_fonte_geracao", "sk_usina": "dim_usina",
}
# --- fixed values: fact -> foreign keys; a key column has the same name in its dimension
FACT_KEYS = {
    "fato_geracao_horaria": ["sk_data", "sk_hora", "sk_subsistema", "sk_fonte"],
    "fato_balanco_horario": ["sk_data", "sk_hora", "sk_subsistema"],
    "fato_restricao_horaria": ["sk_data", "sk_hora", "sk_usina", "sk_subsistema", "sk_fonte"],
    "fato_reservatorio_diario": ["sk_data", "sk_subsistema"],
}
FOREIGN_KEYS = [(fact, key, _DIM_OF[key], key) for fact, keys in FACT_KEYS.items() for key in keys]


def key_registry(spark: SparkSession, primary=PRIMARY_KEYS, foreign=FOREIGN_KEYS) -> DataFrame:
    """Declared constraints as data (parquet tables cannot hold them)."""
    rows = [("PK", t, ",".join(k), None, None) for t, k in primary.items()]
    rows += [("FK", *fk) for fk in foreign]
    return spark.createDataFrame(
        rows, "tipo string, tabela string, colunas string, tabela_referida string, coluna_referida string"
    )


def uniqueness(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: rows, distinct keys, surplus rows and rows with a NULL in the key, from one aggregation by key."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    per_key = df.groupBy(*key).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("linhas"),
        F.count("*").alias("chaves_distintas"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count("*")).alias("linhas_duplicadas"),
        F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("linhas_com_chave_nula"),
    ).withColumn(
        "pct_duplicado",
        F.coalesce(F.round(F.try_divide(F.lit(100.0) * F.col("linhas_duplicadas"), F.col("linhas")), 4), F.lit(0.0)),
    )


def check_uniqueness(tables: Mapping[str, DataFrame], keys: Mapping[str, list[str]]) -> DataFrame:
    """Business-key uniqueness of several tables, one row each."""
    return reduce(DataFrame.unionByName, [
        uniqueness(tables[t], key).select(F.lit(t).alias("tabela"), F.lit(" + ".join(key)).alias("chave_negocio"), "*")
        for t, key in keys.items()
    ])


def check_primary_keys(tables: Mapping[str, DataFrame], keys=PRIMARY_KEYS) -> DataFrame:
    """Primary keys must be unique and never NULL."""
    checked = check_uniqueness(tables, keys)
    good = (F.col("linhas_duplicadas") == 0) & (F.col("linhas_com_chave_nula") == 0)
    return checked.withColumn("status", F.when(good, "OK").otherwise("ATENÇÃO"))


def check_foreign_keys(tables: Mapping[str, DataFrame], keys=FOREIGN_KEYS) -> DataFrame:
    """Orphan rows of every declared foreign key; each fact and each dimension is read once."""
    return orphan_counts(tables, keys)
