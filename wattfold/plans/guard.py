"""Loads that stop themselves: rows are counted by rule while they are staged, and a table is replaced only below stated limits."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattfold.operators.conform import REJECT, reject_reason
from wattfold.sources.shared import shared_folder
from wattfold.sources.tables import observed

LOAD = "carga"
WRITTEN, REFUSED = "gravada", "recusada"


def over_limit(seen: Mapping[str, int], limits: Mapping[str, float], limit_pct: float, rules: Mapping[str, Column]) -> list[str]:
    """Names of the limits, in per cent of the rows read, that a load exceeds; ``rejeitadas`` is the limit on all rejects together."""
    rows = seen["linhas_lidas"]
    counts = {**seen, "rejeitadas": sum(seen[r] for r in rules)}
    return sorted(n for n, most in {"rejeitadas": limit_pct, **limits}.items() if 100.0 * counts[n] > most * rows)


def guarded_load(
    df: DataFrame, load: str, rules: Mapping[str, Column], replace: Callable[[DataFrame], object], quarantine: str, limit_pct: float,
    warnings: Mapping[str, Column] | None = None, limits: Mapping[str, float] | None = None,
) -> dict:
    """Stages a load, and calls ``replace`` with its accepted rows unless too many rows break a rule.

    ``rules`` reject a row (it counts for the first it breaks), ``warnings`` only count it; ``limits`` holds the most per cent of
    rows of single rules and warnings, ``limit_pct`` of all rejects. Everything is counted by an ``Observation`` during the one
    pass that stages the rows, partitioned by reason, in the shared folder, so accepted rows are read back as one partition and
    the source is not computed again. Rejected rows go to the folder ``quarantine`` under the load's name, whether the load is
    refused or not; repeating a load replaces its own part there. A refused load does not touch the table. An empty load is within
    all limits.
    """
    warnings, limits = dict(warnings or {}), dict(limits or {})
    unknown = set(limits) - set(rules) - set(warnings)
    if unknown:
        raise ValueError(f"limits of rules that do not exist: {sorted(unknown)}")
    spark, why = df.sparkSession, reject_reason(rules)
    counts = {
        "linhas_lidas": F.count(F.lit(1)), **{r: F.count_if(F.coalesce(why == r, F.lit(False))) for r in rules},
        **{w: F.count_if(F.coalesce(c, F.lit(False))) for w, c in warnings.items()},
    }
    watched, watch = observed(df, f"load_{load}", counts)
    staged = f"{shared_folder(spark)}/carga"
    marked = watched.withColumn(REJECT, why)
    marked.write.partitionBy(REJECT).parquet(staged)
    seen = watch.get
    broken = over_limit(seen, limits, limit_pct, rules)
    rows = spark.read.schema(marked.schema).parquet(staged)
    bad = rows.filter(F.col(REJECT).isNotNull()).withColumn(LOAD, F.lit(load))
    if any(seen[r] for r in rules):
        bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD, REJECT).parquet(quarantine)
    if not broken:
        replace(rows.filter(F.col(REJECT).isNull()).drop(REJECT))
    return {LOAD: load, "situacao": REFUSED if broken else WRITTEN, "limites_excedidos": broken, **seen}


def quarantined(spark: SparkSession, quarantine: str) -> DataFrame:
    """Rejected rows of all loads with their load and the rule each broke."""
    return spark.read.parquet(quarantine).withColumns({LOAD: F.col(LOAD).cast("string"), REJECT: F.col(REJECT).cast("string")})
