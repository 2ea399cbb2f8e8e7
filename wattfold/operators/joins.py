"""Join shapes of the star schema.

No side is broadcast by hint unless its row count is fixed by construction. For the rest Spark chooses: it broadcasts
a stored dimension whose file size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides,
with adaptive execution splitting hot keys. Single values reach other rows as scalar subqueries, not as joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def enrich(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Left equi-join; a NULL key matches nothing and keeps its row."""
    return df.join(other, on=on, how="left")


def star_join(fact: DataFrame, *dims: tuple[DataFrame, str]) -> DataFrame:
    """Inner join of a fact to ``(dimension, key)`` pairs; key columns share their name on both sides."""
    for dim, key in dims:
        fact = fact.join(dim, key, "inner")
    return fact


def pre_aggregate(fact: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums of measures per key combination, taken before a join so that only one row per combination is joined."""
    return fact.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def orphan_count(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """One row: keys and rows of the fact without a dimension row, and rows whose key is NULL.

    The fact is first counted per key, so the anti-join handles distinct keys and a hot key is one row.
    """
    per_key = fact.groupBy(F.col(fact_key).alias("_key")).agg(F.count("*").alias("_rows"))
    known = dim.select(F.col(dim_key).alias("_key"))
    return per_key.join(known, "_key", "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("chaves_orfas"),
        F.count("*").alias("valores_distintos_orfaos"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_rows"))), F.lit(0)).alias("linhas_com_chave_nula"),
    )


def _key_text(column: str, kind: T.DataType) -> Column:
    """A key as text, so that keys of all types stack; equal keys of one type have equal texts."""
    value = F.col(column).cast(kind)
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    return (value + F.lit(0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else value).cast("string")


def orphan_counts(tables: Mapping[str, DataFrame], keys: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """What ``orphan_count`` says of many ``(fact, fact key, dimension, dimension key)``, with one scan per fact and dimension.

    A fact's keys are turned into rows of (key, value) inside the task and counted there, so a hot key leaves it as one row, and
    a single anti-join meets the distinct values of all facts with the stacked keys of all dimensions. A key without orphans has
    a row of zeros. Both sides of a key are compared in the type Spark would give their union.
    """
    asked: dict[str, list] = {}
    offered: dict[str, dict] = {}
    numbers: dict[tuple, str] = {}
    for at, (fact, column, dim, dim_column) in enumerate(keys):
        kind = tables[fact].select(F.col(column).alias("k")).union(tables[dim].select(F.col(dim_column).alias("k"))).schema[0].dataType
        name = numbers.setdefault((dim, dim_column, kind.simpleString()), str(len(numbers)))
        asked.setdefault(fact, []).append((str(at), name, _key_text(column, kind)))
        offered.setdefault(dim, {})[name] = _key_text(dim_column, kind)
    facts = [tables[f].select(*[text.alias(at) for at, _, text in rows]).unpivot([], [at for at, *_ in rows], "_at", "_key") for f, rows in asked.items()]
    known = [tables[d].select(*[text.alias(n) for n, text in rows.items()]).unpivot([], list(rows), "_dim", "_key") for d, rows in offered.items()]
    dim_of = F.create_map(*[F.lit(x) for rows in asked.values() for at, name, _ in rows for x in (at, name)])
    per_key = reduce(DataFrame.unionAll, facts).groupBy("_at", "_key").agg(F.count("*").alias("_rows"))
    orphans = per_key.withColumn("_dim", dim_of[F.col("_at")]).join(reduce(DataFrame.unionAll, known), ["_dim", "_key"], "left_anti")
    found = orphans.select("_at", "_rows", F.lit(1).alias("_one"), F.when(F.col("_key").isNull(), F.col("_rows")).alias("_null"))
    labels = [(str(at), f"{fact}.{column} -> {dim}") for at, (fact, column, dim, _) in enumerate(keys)]
    spark = tables[keys[0][0]].sparkSession
    none = spark.createDataFrame(labels, "_at string, verificacao string").select("_at", F.lit(0).alias("_rows"), F.lit(0).alias("_one"), F.lit(0).alias("_null"))
    label_of = F.create_map(*[F.lit(x) for row in labels for x in row])
    zero = F.lit(0).cast("long")
    sums = found.unionAll(none).groupBy("_at").agg(*[
        F.coalesce(F.sum(c), zero).alias(name)
        for c, name in (("_rows", "chaves_orfas"), ("_one", "valores_distintos_orfaos"), ("_null", "linhas_com_chave_nula"))
    ])
    return sums.select(label_of[F.col("_at")].alias("verificacao"), "chaves_orfas", "valores_distintos_orfaos", "linhas_com_chave_nula")


def roles_by_key(fact: DataFrame, key: str, role_column: str, roles: dict[str, str], values: dict[str, str]) -> DataFrame:
    """A fact used in several roles at once, one row per key.

    ``roles`` maps an output suffix to the literal that selects the role, ``values`` an output prefix to the column;
    the result has ``<prefix>_<suffix>``. One aggregate replaces one self-join per role. Keys lacking a role are
    dropped, as an inner join would. The fact must have one row per (key, role).
    """
    aggs = [
        F.max(F.when(F.col(role_column) == literal, F.col(column))).alias(f"{prefix}_{suffix}")
        for suffix, literal in roles.items()
        for prefix, column in values.items()
    ]
    present = [F.count_if(F.col(role_column) == literal).alias(f"_n_{suffix}") for suffix, literal in roles.items()]
    wanted = fact.filter(F.col(role_column).isin(list(roles.values())))
    result = wanted.groupBy(key).agg(*aggs, *present)
    for suffix in roles:
        result = result.filter(F.col(f"_n_{suffix}") > 0).drop(f"_n_{suffix}")
    return result
