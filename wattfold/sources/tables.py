"""Catalog tables: full-refresh writes that count rows on the way, documentation, scans and listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def scan(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"{database}.{name}")


def sql_text(text: str) -> str:
    """Text as the inside of a SQL literal."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def observed(df: DataFrame, name: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """The frame with metrics collected while some later job runs over it."""
    watch = Observation(name)
    return df.observe(watch, *[c.alias(k) for k, c in metrics.items()]), watch


def write_table(
    df: DataFrame, table: str, comment: str, columns: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (), path: str | None = None,
) -> dict:
    """Replaces a table, with its comments, and returns its row count taken during the same write.

    Column comments travel in the schema. With ``partition_by`` rows are first rebalanced by the partition columns:
    Spark then writes few files per partition and splits a partition that is much larger than the others.
    """
    columns = columns or {}
    unknown = set(columns) - set(df.columns)
    if unknown:
        raise ValueError(f"comments for columns that do not exist: {sorted(unknown)}")
    documented = df.select(*[
        F.col(c).alias(c, metadata={"comment": columns[c]}) if c in columns else F.col(c) for c in df.columns
    ])
    if partition_by:
        documented = documented.hint("rebalance", *partition_by)
    documented, watch = observed(documented, f"write_{table}", {"linhas": F.count(F.lit(1))})
    writer = documented.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    df.sparkSession.sql(f"COMMENT ON TABLE {table} IS '{sql_text(comment)}'")
    return watch.get


def sample(df: DataFrame, rows=10) -> DataFrame:
    return df.limit(rows)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def catalog_columns(spark: SparkSession, database: str) -> DataFrame:
    """Documentation as data: table, column, type and comment, read from the catalog (metadata only)."""
    rows = [
        (t.name, c.name, c.dataType, c.description)
        for t in spark.catalog.listTables(database)
        for c in spark.catalog.listColumns(f"{database}.{t.name}")
    ]
    return spark.createDataFrame(rows, "tabela string, coluna string, tipo string, descricao string")
