"""Reading published CSV files as text, with provenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

CONTROL_COLUMNS = ["_ingest_ts", "_source_file", "_source_dataset"]


def read_bronze(
    spark: SparkSession, paths: str | list[str], dataset: str, columns: Sequence[str] | None = None, sep=";",
) -> DataFrame:
    """All columns as text plus load time, source file and dataset name.

    Quoted fields may contain line breaks, so a file is one task: parallelism is the number of files. ``columns`` fixes the schema; without it the header names are used.
    """
    reader = spark.read.options(
        header=True, sep=sep, encoding="UTF-8", multiLine=True, quote='"', escape='"', inferSchema=False,
        enforceSchema=False,
    )
    if columns:
        reader = reader.schema(", ".join(f"`{c}` STRING" for c in columns))
    df = reader.csv(paths)
    return df.select(
        *df.columns,
        F.current_timestamp().alias("_ingest_ts"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(dataset).alias("_source_dataset"),
    )
