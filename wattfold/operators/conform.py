"""Mapping raw frames to a common schema, splitting off rejected rows, and removing duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wattfold.functions.clean import CLEANERS

REJECT = "motivo_rejeicao"


def conform(df: DataFrame, spec: Sequence[tuple[str, str, str]], keep=(), tags: Mapping | None = None, once: Sequence[str] = ()) -> DataFrame:
    """Select ``(source, target, kind)`` columns, cleaned by kind, plus kept columns and constant tags.

    Texts are trimmed in a projection of their own: each is trimmed once, and the generated code of a wide table stays
    in several methods small enough for the JVM to compile. Targets named in ``once`` come out of an ``inline``, which
    filters cannot pass: a filter below it would clean them again at each place that names them.
    """
    trimmed = df.select(*[F.trim(source).alias(target) for source, target, _ in spec], *[F.col(c) for c in keep])
    cleaned = {target: CLEANERS[kind](F.col(target), trimmed=True).alias(target) for _, target, kind in spec}
    if once:
        first = F.inline(F.array(F.struct(*[cleaned[target].alias(f"_{target}") for target in once])))
        trimmed = trimmed.select(*[F.col(c) for c in trimmed.columns if c not in once], first)
        cleaned |= {target: F.col(f"_{target}").alias(target) for target in once}
    constants = [F.lit(value).alias(name) for name, value in (tags or {}).items()]
    return trimmed.select(*cleaned.values(), *[F.col(c) for c in keep], *constants)


def union_conformed(*frames: DataFrame) -> DataFrame:
    """Union by column name; a frame with other columns is an error."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=False)
    return result


def reject_reason(rules: Mapping[str, Column]) -> Column:
    """Name of the first rule a row breaks (a rule is true for a bad row), NULL for a good row."""
    return F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])


def accepted(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break no rule."""
    return df.filter(reject_reason(rules).isNull())


def rejected(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break a rule, with its name."""
    return df.withColumn(REJECT, reject_reason(rules)).filter(F.col(REJECT).isNotNull())


def reject_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows in, accepted and rejected per rule, in one pass."""
    why = reject_reason(rules)
    counts = [F.count_if(why == name).alias(name) for name in rules]
    return (
        df.agg(F.count("*").alias("linhas_lidas"), F.count_if(why.isNull()).alias("linhas_aceitas"), *counts)
        .unpivot([], ["linhas_lidas", "linhas_aceitas", *rules], "medida", "linhas")
    )


def dedupe(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``latest_by``, then by all other columns.

    The whole row travels in one struct maximum, which combines on the map side: a key with very many copies is
    reduced in every task before the shuffle, and the survivor does not depend on the order of the input.
    """
    keys = list(keys)
    order = [c for c in latest_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order + rest:
        return df.dropDuplicates(keys)
    row = F.struct(*[F.col(c) for c in order + rest])
    kept = df.groupBy(*keys).agg(F.max(row).alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


#: Bits of the map of repeated keys: 64 in a word, 256 words in a chunk. It takes 8 MB at most, however many keys repeat.
MAP_BITS, CHUNK_WORDS = 1 << 26, 256


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hashes of the keys that occur more than once. Only hashes are shuffled; two keys with one hash count as repeated."""
    return df.select(F.xxhash64(*keys).alias("resumo")).groupBy("resumo").agg(F.count("*").alias("_rows")).filter("_rows > 1").select("resumo")


def _place(digest: Column) -> tuple[Column, Column, Column]:
    """Chunk, word of the chunk and bit of the word that a hash has in the map."""
    bit = F.pmod(digest, F.lit(MAP_BITS))
    word = F.shiftright(bit, 6)
    return F.shiftright(word, CHUNK_WORDS.bit_length() - 1).cast("int"), (word % CHUNK_WORDS).cast("int"), (bit % 64).cast("int")


def _dense(entries: Column, size: int, missing: Column) -> Column:
    """An array from (position, value) pairs."""
    found = F.map_from_entries(entries)
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at(found, i), missing))


def key_map(repeated: DataFrame) -> DataFrame:
    """One row: the bits of all given hashes, as an array of chunks of words. It is of fixed size, so it can go to every task."""
    chunk, word, bit = _place(F.col("resumo"))
    words = repeated.select(chunk.alias("chunk"), word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bits"))
    words = words.groupBy("chunk", "word").agg(F.bit_or("bits").alias("bits"))
    chunks = words.groupBy("chunk").agg(_dense(F.collect_list(F.struct("word", "bits")), CHUNK_WORDS, F.lit(0).cast("bigint")).alias("words"))
    return chunks.agg(_dense(F.collect_list(F.struct("chunk", "words")), MAP_BITS // 64 // CHUNK_WORDS, F.lit(None).cast("array<bigint>")).alias("chunks"))


def apart(df: DataFrame, keys: Sequence[str], repeated: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """For wide tables in which few keys repeat: rows whose key occurs once, and the others with the few that share a bit with them.

    Only the second part needs :func:`dedupe`, so the first stays where it is. The more keys repeat, the more is shuffled.
    ``repeated`` holds the frame's :func:`repeated_keys` where they are stored. The frame must give the same rows each time.
    """
    chunk, word, bit = _place(F.xxhash64(*keys))
    bits = F.get(F.get(key_map(repeated_keys(df, keys) if repeated is None else repeated).scalar(), chunk), word)
    several = F.coalesce(F.getbit(bits, bit), F.lit(0)) == 1
    return df.filter(~several), df.filter(several)
