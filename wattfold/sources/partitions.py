"""Full refresh of a partitioned table that rewrites only what changed.

A table is a folder of Parquet partitions and, beside it, a digest of each partition's content. A refresh compares the digests of
the new content with the stored ones in one aggregate, writes the partitions that differ by dynamic partition overwrite, removes
those that the new content lacks, and leaves all others alone.

The digests of partitions about to change are dropped before anything is written, and stated again at the end. A refresh that
fails in between so leaves partitions without a digest, which the next one writes anew, and never one whose digest is not its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattfold.sources.shared import checkpointed


def partition_digests(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and an order-free content digest of each partition, combined in each task before the shuffle."""
    own = [c for c in df.columns if c not in by]
    one = F.xxhash64(*own).cast("decimal(38,0)")
    other = F.xxhash64(F.lit(1), *own).cast("decimal(38,0)")
    return df.groupBy(*by).agg(F.count("*").alias("linhas"), F.concat_ws(":", F.sum(one).cast("string"), F.sum(other).cast("string")).alias("resumo"))


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def stored_digests(spark: SparkSession, path: str, by: Sequence[str], like: DataFrame) -> DataFrame:
    folder, fs = _path(spark, f"{path}/_resumos")
    schema = like.select(*by).schema.add("linhas", "long").add("resumo", "string")
    if not fs.exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/_resumos")


def _replace_digests(digests: DataFrame, path: str) -> None:
    """Written beside the old ones first; a folder without them in between makes the next refresh write more, never less."""
    spark = digests.sparkSession
    digests.write.mode("overwrite").parquet(f"{path}/_resumos_novos")
    old, fs = _path(spark, f"{path}/_resumos")
    new, _ = _path(spark, f"{path}/_resumos_novos")
    fs.delete(old, True)
    fs.rename(new, old)


def refresh(df: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Makes the table at ``path`` hold ``df``; returns each partition's key, ``linhas`` and ``situacao``.

    situacao: gravada (new or changed, written), mantida (unchanged, not written), removida (not in the new content). A NULL
    key is a partition of its own. ``df`` is computed twice unless it is a stored table.
    """
    spark, by = df.sparkSession, list(by)
    stored = checkpointed(stored_digests(spark, path, by, df)).withColumnsRenamed({c: f"_o_{c}" for c in (*by, "linhas", "resumo")})
    now = checkpointed(partition_digests(df, by))
    same = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in by]
    both = now.withColumn("_n", F.lit(1)).join(stored.withColumn("_o", F.lit(1)), same, "full")
    status = F.when(F.col("_n").isNull(), "removida").when(F.col("resumo") == F.col("_o_resumo"), "mantida").otherwise("gravada")
    key = [F.when(F.col("_n").isNull(), F.col(f"_o_{c}")).otherwise(F.col(c)).alias(c) for c in by]
    plan = checkpointed(both.select(*key, F.coalesce("linhas", "_o_linhas").alias("linhas"), F.coalesce("resumo", "_o_resumo").alias("resumo"), status.alias("situacao")))

    kept = plan.filter("situacao = 'mantida'").select(*by, "linhas", "resumo")
    _replace_digests(kept, path)
    changed = plan.filter("situacao = 'gravada'").select(*[F.col(c).alias(f"_w_{c}") for c in by])
    rows = df.join(changed, [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in by], "left_semi")
    rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{path}/dados")
    # One metadata call per partition that is gone: as many as there are folders to remove, whatever they hold.
    for gone in plan.filter("situacao = 'removida'").select(*by).toLocalIterator():
        folder, fs = _path(spark, "/".join([f"{path}/dados", *[f"{c}={_folder(spark, gone[c])}" for c in by]]))
        fs.delete(folder, True)
    _replace_digests(plan.filter("situacao <> 'removida'").select(*by, "linhas", "resumo"), path)
    return plan.select(*by, "linhas", "situacao")


def _folder(spark: SparkSession, value) -> str:
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows; filters on its partition columns prune folders."""
    return spark.read.parquet(f"{path}/dados")
