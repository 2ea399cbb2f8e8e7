"""Landed files as DataFrames: listing, selection by period, manifest and the files not loaded yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattfold.config import PERIODICITY, Period

MEGABYTE = 1 << 20


def list_files(spark: SparkSession, folder: str, pattern="*.csv") -> DataFrame:
    """Path, name, parent folder name, size and time of all files below a folder. File contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return files.select(
        F.col("path"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("arquivo"),
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("dataset"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modificado_em"),
    )


def named_period(periodicity: str) -> Column:
    """The year (yearly) or month (monthly) that a file's name ends in; NULL where it gives none."""
    if periodicity == "yearly":
        return F.regexp_extract("arquivo", r"_(\d+)\.[^.]+$", 1).try_cast("int")
    if periodicity == "monthly":
        return F.nullif(F.regexp_replace(F.regexp_extract("arquivo", r"_(\d+_\d+)\.[^.]+$", 1), "_", "-"), F.lit(""))
    raise ValueError(f"unknown periodicity: {periodicity}")


def _inside(periodicity: str, period: Period) -> Column:
    bounds = (period.first_year, period.last_year) if periodicity == "yearly" else (period.first_month, period.last_month)
    return named_period(periodicity).between(*bounds)


def in_period(files: DataFrame, periodicity: str, period: Period = Period()) -> DataFrame:
    """Files whose name ends in a period inside the window: ``_2025.csv`` (yearly) or ``_2025_06.csv`` (monthly)."""
    if periodicity == "single":
        return files
    return files.filter(_inside(periodicity, period))


def file_status(files: DataFrame, period: Period = Period(), periodicity=PERIODICITY) -> DataFrame:
    """Every landed file and its ``situacao``: selecionado, fora_da_janela, sem_periodo or conjunto_desconhecido."""
    status = F.lit("conjunto_desconhecido")
    for name, kind in periodicity.items():
        own = F.lit("selecionado") if kind == "single" else (
            F.when(named_period(kind).isNull(), "sem_periodo").when(_inside(kind, period), "selecionado").otherwise("fora_da_janela"))
        status = F.when(F.col("dataset") == name, own).otherwise(status)
    return files.select("dataset", "arquivo", F.col("path").alias("caminho_volume"), "bytes", status.alias("situacao"))


def selected_files(files: DataFrame, period: Period = Period(), periodicity=PERIODICITY) -> DataFrame:
    """Files of every known dataset inside the window."""
    chosen = [in_period(files.filter(F.col("dataset") == name), kind, period) for name, kind in periodicity.items()]
    result = chosen[0]
    for part in chosen[1:]:
        result = result.unionByName(part)
    return result


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Non-empty files that the manifest does not have with the same path and size."""
    known = manifest.select(F.col("caminho_volume").alias("path"), "bytes")
    return files.filter(F.col("bytes") > 0).join(known, ["path", "bytes"], "left_anti")


def manifest(files: DataFrame, known: DataFrame | None = None, origin: str | None = None) -> DataFrame:
    """One row per landed file: where it came from, where it is, how big it is and whether it was there before."""
    status = F.lit("novo")
    if known is not None:
        seen = known.select(F.col("caminho_volume").alias("path"), "bytes").distinct().withColumn("_seen", F.lit(True))
        files = files.join(seen, ["path", "bytes"], "left")
        status = F.when(F.col("_seen"), "cache").otherwise("novo")
    source = F.concat(F.lit(f"{origin}/"), "arquivo") if origin else F.lit(None).cast("string")
    return files.select(
        "dataset",
        "arquivo",
        source.alias("url_origem"),
        F.col("path").alias("caminho_volume"),
        "bytes",
        status.alias("status"),
        F.date_format("modificado_em", "yyyy-MM-dd'T'HH:mm:ss").alias("ingest_ts"),
        F.current_timestamp().alias("_ingest_ts"),
    )


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Files and megabytes per dataset."""
    return manifest.groupBy("dataset").agg(
        F.count("*").alias("arquivos"), F.round(F.sum("bytes") / MEGABYTE, 1).alias("mb_total")
    )
