"""From raw documents to encoded training text, in five stages.

Each stage reads what the one before it wrote and is a DataFrame program over all of it; ``run`` writes every stage's result as
Parquet under the cluster's shared folder, so a lost executor costs at most the stage that is running.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattfold.llm import jaccard_join, language_id, mixture, piece_codec, queries, texts as T, window_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Stretches of text and pairs that a task of the last stage remembers, about 70 MB.
REMEMBERED = 300_000
#: No SQL: the language model, the hashed sample order and the encoding are beyond it. tests/llm holds brute-force versions.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, their lang as the model tells it; those without a text or a letter go, whatever their words otherwise.

    Where no label could be learnt, lang stays as it came.
    """
    queries.importable(spark)
    model = language_id.fit(docs)
    found = language_id.identified(docs, model, *COLUMNS)
    lang = F.col("lang_pred") if model.languages else F.col("lang").cast("string")
    return found.where("letters").withColumn("lang", lang).select(*COLUMNS)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id: word shingles of five, likeness 0.8 or more.

    Texts that share an id, null above all, are documents of their own, ordered by a digest of the text. Rows of one id and
    text are the same document and stay as they are; documents without words stay.
    """
    found = jaccard_join.documents_of_classes(docs, size=5, percent=80)
    leaders = T.checkpointed(found.where("leader").select(F.col("doc_id").alias("id"), F.col("twin").alias("of")).distinct())
    keyed = docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(T.NO_ID))).withColumn("_twin", F.xxhash64(F.coalesce("text", F.lit(""))))
    return keyed.join(leaders, (keyed["_id"] == leaders["id"]) & (keyed["_twin"] == leaders["of"]), "left_semi").select(*COLUMNS)


def remove_repeated_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words that repeat earlier passages; texts that repeat nothing stay as they are."""
    keep = ("text", "lang", "source", "n_chars")
    plain = docs.select("doc_id", *(F.col(c).alias(f"own_{c}") for c in keep), "text")
    found = window_dedup.remove_repeats(plain, keep=tuple(f"own_{c}" for c in keep))
    touched = F.col("n_removed") > 0
    return found.select(
        T.public_id(), F.when(touched, F.col("kept_text")).otherwise(F.col("own_text")).alias("text"), F.col("own_lang").alias("lang"), F.col("own_source").alias("source"),
        F.when(touched, F.length("kept_text").cast("long")).otherwise(F.col("own_n_chars").cast("long")).alias("n_chars"),
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in whole documents: a document stands once for each epoch that takes it, and a cut one if at least half is taken.

    Rows that share id, source and size get the same number of copies.
    """
    taken = mixture.mix(docs).where("taken > 0").groupBy("doc_id", "source", "size").agg(F.max("taken").alias("taken"))
    copies = T.checkpointed(taken.select(F.col("doc_id").alias("id"), F.col("source").alias("of"), F.col("size").alias("words"), F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("copies")).where("copies > 0"))
    sized = docs.select(*COLUMNS, F.coalesce(F.regexp_count("text", F.lit(mixture.WORD)), F.lit(0)).cast("long").alias("words"))
    same = sized["doc_id"].eqNullSafe(copies["id"]) & sized["source"].eqNullSafe(copies["of"]) & (sized["words"] == copies["words"])
    return sized.join(copies, same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the ids of every text, their number, and whether decoding them gives the text back."""
    path = queries.tokenizer("piece_bpe_32k.model")

    def run(batches):
        codec = piece_codec.codec(path, REMEMBERED)
        for batch in T.chunks(batches):
            texts = batch.column(1).to_pylist()
            ids = [codec.encode(x) for x in texts]
            back = [codec.decode(i) == x for i, x in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(ids, pa.list_(pa.int32())), pa.array([len(i) for i in ids], pa.int64()), pa.array(back, pa.bool_())],
                names=["doc_id", "source", "ids", "n_tokens", "round_trip"],
            )
        codec.forget()  # the worker lives on, into other stages

    found = T.documents(docs, "source").mapInArrow(T.leaving_nothing(run), "doc_id long, source string, ids array<int>, n_tokens long, round_trip boolean")
    return found.select(T.public_id(), "source", "ids", "n_tokens", "round_trip")


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", join_near_copies),
    ("window_dedup", remove_repeated_windows),
    ("mixture", mix_sources),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    queries.importable(spark)
    folder = f"{T.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = T.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
