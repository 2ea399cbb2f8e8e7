"""Collects registered queries and their SQL texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks.sqltext import query
from wattfold.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def rounded(df: DataFrame, digits=6) -> DataFrame:
    """Doubles rounded for comparison: a floating sum depends on the order of its terms in the last bits."""
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema
    ])


def register(name: str, sql: str | None = None, digits: int | None = 6):
    """Decorator: registers a query and, if SQL can say it, its oracle text."""
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(tune(spark), sf_dir)
            return df if digits is None else rounded(df, digits)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = query(sql)
        return fn
    return add
