"""Mixing sources to target weights.

Every document gets a key from a hash of its id. Within a source, documents stand in key order; running sums of their sizes
are built from sums of key ranges, so no task holds a source. A source's budget is cut exactly where its running sum reaches
it; a budget above the source's size takes whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattfold.llm import texts as T

#: Weights by rank of the source name (code points, null last), repeating; share of all sizes; epochs at most.
WEIGHTS, SHARE, EPOCHS = (3, 1, 2), 1.5, 2
#: Documents in a key range of the largest source, at most about; it sets how many ranges there are, not what is taken.
RANGE_ROWS = 1000
#: Up to so many sources, their budgets are broadcast; beyond, joined by a shuffle that adaptive execution splits.
BROADCAST_SOURCES = 10_000
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def key(seed: str = SEED) -> Column:
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")))


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> dict[str | None, float]:
    """The budget of each source: ``share`` of all sizes by weight, none above ``epochs`` times its own size.

    What is cut off goes to the other sources by weight until none is above. The result is min(cap, level * weight) with one
    level for all, found by going through the sources in the order in which they reach their caps. Six decimals.
    """
    ranked = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {name: weights[i % len(weights)] for i, (name, _) in enumerate(ranked)}
    left, among = share * sum(n for _, n in ranked), sum(weight.values())
    out = {}
    for name, n in sorted(ranked, key=lambda x: (epochs * x[1] / weight[x[0]], x[0] is None, x[0] or "")):
        w = weight[name]
        out[name] = round(min(float(epochs * n), left * w / among), 6)
        left, among = left - min(float(epochs * n), left * w / among), among - w
    return out


def sized(df: DataFrame) -> DataFrame:
    """doc_id, source, size (words) of every document."""
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def mix(df: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words, repeats counted) of every document.

    The narrow table of sizes is written once to the shared checkpoint folder and all steps read it. A row a source comes to the driver
    to set the budgets. Documents of one doc_id share a key and stand by size; a null source is a source of its own, a null
    id has the key of an empty one; a document without words takes nothing. Reruns give the same rows.
    """
    spark = df.sparkSession
    docs = T.checkpointed(sized(df).withColumn("key", key(seed)))
    by_source = [(r["source"], r["n"], r["rows"]) for r in docs.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()]
    budget = targets([(s, n) for s, n, _ in by_source], weights, share, epochs)
    digits = next(d for d in range(1, 33) if max([rows for *_, rows in by_source], default=0) <= RANGE_ROWS * 16**d)
    plan = spark.createDataFrame([(s, n, budget[s]) for s, n, _ in by_source], "of string, source_size long, target double")
    if len(by_source) <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    docs = docs.join(plan, docs["source"].eqNullSafe(F.col("of"))).drop("of")
    docs = docs.withColumns({"s": F.coalesce("source", F.lit("")), "none": F.col("source").isNull(), "range": F.substring("key", 1, digits)})
    starts = _starts(docs.groupBy("s", "none", "range").agg(F.sum("size").alias("n")), digits)
    within = Window.partitionBy("s", "none", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranged = docs.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = ranged.join(starts, ["s", "none", "range"]).withColumn("at", F.col("start") + F.col("inside"))
    whole = F.floor("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0)
    rest = whole - full * F.col("source_size")
    taken = full * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("at")))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def _starts(sums: DataFrame, digits: int) -> DataFrame:
    """The running sum before each key range, from ranges one digit shorter: a window never holds more than 16 rows."""
    if digits == 0:
        return sums.select("s", "none", "range", F.lit(0).cast("long").alias("start"))
    cut = sums.withColumn("parent", F.substring("range", 1, digits - 1) if digits > 1 else F.lit(""))
    above = _starts(cut.groupBy("s", "none", F.col("parent").alias("range")).agg(F.sum("n").alias("n")), digits - 1)
    before = F.sum("n").over(Window.partitionBy("s", "none", "parent").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    inside = cut.select("s", "none", "range", "parent", F.coalesce(before, F.lit(0)).alias("before"))
    return inside.join(above.select("s", "none", F.col("range").alias("parent"), F.col("start").alias("base")), ["s", "none", "parent"]).select(
        "s", "none", "range", (F.col("base") + F.col("before")).alias("start"),
    )
