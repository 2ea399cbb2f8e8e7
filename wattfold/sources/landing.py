"""Landing of new files, each exactly once, with a manifest of what was landed.

Spark's file source remembers in a checkpoint which files it has handed out, and repeats a batch under its number until the batch
is done. A batch writes to folders of that number and replaces what an earlier attempt left there, so a run that fails anywhere
and is started again lands nothing twice and nothing less. All new files are landed, whatever their period: the window is applied
when rows are read, as a partition filter, so that a wider window later finds them.

``<target>/linhas/_lote=<batch>/_periodo=<period>`` holds rows, ``<target>/manifesto/_lote=<batch>`` one row per file.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattfold.config import Period
from wattfold.sources.files import _inside, list_files, named_period

_FIELD = "\x1f"
_MANIFEST = "dataset string, arquivo string, caminho_volume string, bytes long, periodo string, linhas long, resumo string, ingest_ts timestamp, _lote int"


def row_digest(columns: Sequence[str]) -> Column:
    """60 bits of the MD5 of a row's texts, NULL being empty."""
    text = F.concat_ws(_FIELD, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")


def content_digest(columns: Sequence[str]) -> Column:
    """Aggregate: a digest of a group's rows that does not depend on their order and tells how often each occurs."""
    return F.sum(row_digest(columns)).cast("string")


def _period_of(periodicity: str) -> Column:
    return F.lit("unico") if periodicity == "single" else F.coalesce(named_period(periodicity).cast("string"), F.lit("sem_periodo"))


def land(
    spark: SparkSession, landing: str, dataset: str, columns: Sequence[str], target: str, periodicity="monthly", sep=";",
    files_per_batch: int = 1000, between: Callable[[int], None] | None = None,
) -> None:
    """Lands the files of ``<landing>/<dataset>`` that earlier runs with the same target have not landed.

    ``between`` is called with the batch number after its rows and before its manifest are written.
    """
    stream = (
        spark.readStream.schema(", ".join(f"`{c}` STRING" for c in columns))
        .options(header=True, sep=sep, encoding="UTF-8", multiLine=True, quote='"', escape='"', maxFilesPerTrigger=files_per_batch, latestFirst=False)
        .csv(f"{landing}/{dataset}")
        .select(
            *columns, F.current_timestamp().alias("_ingest_ts"), F.col("_metadata.file_path").alias("_source_file"),
            F.col("_metadata.file_name").alias("arquivo"), F.col("_metadata.file_size").alias("_bytes"), F.lit(dataset).alias("_source_dataset"),
        )
    )

    def write(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        rows = f"{target}/linhas/_lote={number}"
        named = batch.withColumn("_periodo", _period_of(periodicity))
        named.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_periodo").parquet(rows)
        if between:
            between(number)
        # What is stated of a file is read back from what was written of it.
        written = own.read.option("recursiveFileLookup", "false").parquet(rows)
        listed = written.groupBy("_source_dataset", "arquivo", "_source_file", "_bytes", F.col("_periodo").cast("string").alias("periodo")).agg(
            F.count("*").alias("linhas"), content_digest(columns).alias("resumo"), F.max("_ingest_ts").alias("ingest_ts"),
        )
        listed.select(
            F.col("_source_dataset").alias("dataset"), "arquivo", F.col("_source_file").alias("caminho_volume"), F.col("_bytes").alias("bytes"), "periodo", "linhas", "resumo", "ingest_ts",
        ).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{target}/manifesto/_lote={number}")

    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{target}/_checkpoint").foreachBatch(write).start()
    query.awaitTermination()


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether there is a file or folder, in whatever store it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


def landed_manifest(spark: SparkSession, target: str) -> DataFrame:
    """One row per landed file with rows: name, path, size, period, rows, content digest and batch; empty before the first landing."""
    if not exists(spark, f"{target}/manifesto"):
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).parquet(f"{target}/manifesto")


def landed_rows(spark: SparkSession, target: str, periodicity="monthly", period: Period | None = None) -> DataFrame:
    """Landed rows, those of files inside the window if one is given; other periods' folders are not read."""
    rows = spark.read.option("basePath", f"{target}/linhas").parquet(f"{target}/linhas").withColumn("_periodo", F.col("_periodo").cast("string"))
    if period is None or periodicity == "single":
        return rows
    bounds = (period.first_year, period.last_year) if periodicity == "yearly" else (period.first_month, period.last_month)
    return rows.filter(F.col("_periodo").between(*map(str, bounds)))


def landing_status(spark: SparkSession, landing: str, target: str, since: int = 0, periodicity="monthly", period: Period | None = None) -> DataFrame:
    """Every file that lies in the landing folder or was landed before, with its ``status`` and ``situacao``.

    status: novo (landed in batch ``since`` or later), cache (landed before), pendente (not landed yet, or landed without a
    row: a header alone), alterado (its size is not the landed one: a published file was replaced under its name; it is not
    landed again), ausente (landed, and no longer there). A file without a byte is not listed. situacao: selecionado, fora_da_janela or sem_periodo.
    """
    listed = list_files(spark, landing).select("dataset", "arquivo", F.col("bytes").alias("agora"))
    known = landed_manifest(spark, target).select("dataset", "arquivo", "bytes", "linhas", "resumo", F.col("_lote").alias("lote"))
    both = listed.join(known, ["dataset", "arquivo"], "full")
    status = (
        F.when(F.col("agora").isNull(), "ausente").when(F.col("lote").isNotNull() & (F.col("agora") != F.col("bytes")), "alterado")
        .when(F.col("lote") >= since, "novo").when(F.col("lote").isNotNull(), "cache")
        .otherwise("pendente")
    )
    inside = F.lit("selecionado") if period is None or periodicity == "single" else (
        F.when(named_period(periodicity).isNull(), "sem_periodo").when(_inside(periodicity, period), "selecionado").otherwise("fora_da_janela"))
    return both.select("dataset", "arquivo", status.alias("status"), inside.alias("situacao"), F.coalesce("linhas", F.lit(0)).cast("long").alias("linhas"), "resumo", "lote")


def pending_files(spark: SparkSession, landing: str, target: str) -> DataFrame:
    """Non-empty files of the landing folder that are not landed yet."""
    return landing_status(spark, landing, target).filter(F.col("status") == "pendente").select("dataset", "arquivo")


def landing_summary(spark: SparkSession, landing: str, target: str, since: int = 0) -> DataFrame:
    """Files and rows per dataset and status."""
    return landing_status(spark, landing, target, since).groupBy("dataset", "status").agg(F.count("*").alias("arquivos"), F.sum("linhas").alias("linhas"))
