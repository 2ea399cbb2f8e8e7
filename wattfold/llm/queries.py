"""The registered query of each operator over its whole table."""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattfold.llm import (  # noqa: E501
    bwt_dedup, chat_format, fingerprints, hard_negatives, jaccard_join, language_id, mixture, piece_codec, pq_dedup, prefix_trie, sql, texts as T, token_counts, vantage_search, window_dedup,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = dict(sql.ORACLE)
#: The most tokens that a document may have before it is over the limit.
TOKEN_LIMIT = 1024


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this library from where the driver has it, as PYTHONPATH would; keeps Arrow batches small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def register(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(importable(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def tokenizer(name: str) -> str:
    """Where a public vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every text, decodes the ids, and gives digests of both in place of the ids."""
    path = tokenizer("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec.codec(path)
        names = [str(i) for i in range(len(codec.text_of))]
        digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in T.chunks(batches):
            out = []
            for text in batch.column(1).to_pylist():
                ids = codec.encode(text)
                out.append((len(ids), digest(",".join(map(names.__getitem__, ids))), digest(codec.decode(ids))))
            n, a, b = map(list, zip(*out))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, type=pa.int64()), pa.array(a), pa.array(b)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = T.documents(T.table(spark, sf_dir, "documents"))
    found = docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return found.select(T.public_id(), "n_tokens", "ids_sha256", "decoded_sha256")


@register
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness."""
    return fingerprints.compare_with_next(T.table(spark, sf_dir, "documents"))


@register
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text."""
    found = token_counts.count_tokens(T.table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return found.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@register
def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixture.mix(T.table(spark, sf_dir, "documents"))


@register
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from every formatted conversation and from one that holds control strings."""
    own = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    rows = T.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                text, turns = r["formatted"], chat_format.turns(r["formatted"])
                learnt = "".join(chat_format.unescape(text[s["start"] : s["stop"]]) for s in r["loss_spans"])
                out.append((r["conv_id"], len(turns), digest("".join(f"{role}\n{said}\n" for role, said in turns)), len(learnt), digest(learnt), len(text)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) if i in (2, 4) else pa.array(list(c), type=pa.int64()) for i, c in enumerate(zip(*out))], names=names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [x.split()[0] for x in schema.split(", ")]
    return chat_format.format_chats(chat_format.text_messages(rows)).mapInArrow(run, schema)


@register
def op3_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that repeated windows take out of every document."""
    found = window_dedup.remove_repeats(T.table(spark, sf_dir, "documents"))
    return found.select(T.public_id(), "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


@register
def op7_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that repeated strings take out of every document."""
    found = bwt_dedup.remove_repeats(T.table(spark, sf_dir, "documents"))
    return found.select(T.public_id(), "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@register
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose sets of three-word shingles are linked."""
    found = jaccard_join.classes(T.table(spark, sf_dir, "documents"))
    return found.select(T.public_id(), "n_shingles", T.public_id("component_id"))


@register
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text."""
    return language_id.identify(T.table(spark, sf_dir, "documents"))


@register
def op9_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of the whole table."""
    return pq_dedup.near_duplicates(T.table(spark, sf_dir, "embeddings"))


@register
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix that rebuilt conversations share, with what it would save to store it once."""
    return prefix_trie.trie(T.table(spark, sf_dir, "conversations"))


@register
def op11_vantage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every fiftieth vector."""
    return vantage_search.nearest(T.table(spark, sf_dir, "embeddings"))


@register
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each anchor and each of its five positives."""
    return hard_negatives.mine(T.table(spark, sf_dir, "embeddings"))
