"""Document fingerprints: a threshold-scaled sketch of five-word shingles.

Every shingle hash below a fixed fraction of the hash range is kept, so a sketch grows with its document: two sketches of
very unequal documents are comparable, and the sketch of a union is the union of sketches. A text whose hashes all lie above
the threshold keeps its smallest one, so that no text with words has an empty sketch; ``merged`` keeps that rule.

A fingerprint is the ascending 48-bit hashes, six bytes each, in base64. Texts of fewer than five words have one shingle, the
whole sequence; texts without words have the empty fingerprint. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from wattfold.llm import texts as T

SHINGLE = 5
#: One hash in so many is kept.
SCALE = 4
_BITS, _KEY = 48, b"fingerprints"


def sketches(texts: T.Utf8, size: int = SHINGLE, scale: int = SCALE) -> list[np.ndarray]:
    """For each text its kept hashes, ascending and distinct."""
    doc, value, _ = T.shingles(texts, size, _KEY)
    value >>= np.uint64(64 - _BITS)
    smallest = np.full(len(texts), np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(smallest, doc, value)
    keep = (value < np.uint64((1 << _BITS) // scale)) | (value == smallest[doc])
    order = np.lexsort((value[keep], doc[keep]))
    value, doc = value[keep][order], doc[keep][order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return np.split(value, np.searchsorted(doc, np.arange(1, len(texts)))) if len(texts) else []


def written(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - _BITS // 8 :].tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, _BITS // 8)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, 8 - _BITS // 8 :] = raw
    return out.view(">u8").ravel().astype(np.uint64)


def merged(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of two documents put together (shingles across the seam aside)."""
    both = np.union1d(a, b)
    below = both[both < np.uint64((1 << _BITS) // scale)]
    return below if len(below) else both[:1]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True)) if len(a) and len(b) else 0


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard likeness of two shingle sets: 1 for equal sketches, 0 where only one is empty."""
    both = _common(a, b)
    union = len(a) + len(b) - both
    return both / union if union else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has; of an empty a, 1."""
    return _common(a, b) / len(a) if len(a) else 1.0


def fingerprint(df: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every whole text (null: empty), without a shuffle.

    Repeated rows give repeated rows; an empty table gives an empty one; other columns are left behind.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            made = [written(x) for x in sketches(T.Utf8(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, type=pa.string())], names=["doc_id", "fingerprint"])

    return T.documents(df).mapInArrow(run, "doc_id long, fingerprint string").select(T.public_id(), "fingerprint")


def beside_next(df: DataFrame) -> DataFrame:
    """Every document in a partition where its successor by doc_id follows it: columns part, ahead, doc_id, text.

    Rows are dealt out by ranges of doc_id (cuts from percentiles, one for each shuffle partition), so each text moves once.
    The first document of a range is also sent to the end of the range before, marked ``ahead``, and the very first to the
    end of the last. Rows of one doc_id follow each other by text.
    """
    spark, docs = df.sparkSession, T.documents(df)
    parts = T.partitions(spark)
    at = [i / parts for i in range(1, parts)] or [0.5]
    cuts = docs.agg(F.percentile_approx("doc_id", at, 20 * parts)).first()[0] or []
    cuts = np.unique(np.array(cuts, dtype=np.int64))
    range_of = pandas_udf(lambda ids: pd.Series(np.searchsorted(cuts, ids.to_numpy(), side="right").astype(np.int32)), "int")
    found = docs.groupBy(range_of("doc_id").alias("part")).agg(F.min("doc_id").alias("first")).orderBy("part").collect()  # a row a range
    before = {r["first"]: found[i - 1]["part"] for i, r in enumerate(found)}

    @pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, ids.to_numpy(), side="right")
        return pd.Series([[2 * p] if (b := before.get(i)) is None else [2 * p, 2 * b + 1] for p, i in zip(own.tolist(), ids.tolist())])

    dealt = docs.select("doc_id", "text", F.explode(places("doc_id")).alias("place")).select(
        F.shiftright("place", 1).alias("part"), (F.col("place") % 2).alias("ahead"), "doc_id", "text",
    )
    return dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "ahead", "doc_id", "text")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the following text's first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(df: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; the columns of query op2.

    Null ids come first and are given back as null; a lone document is its own successor.
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_kept long, containment_edited double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in T.chunks(batches):
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            held = batch.slice(batch.num_rows - 1)
            part, ahead, ids = (batch.column(i).to_pylist() for i in range(3))
            column = batch.column(3)
            texts = column.to_pylist()
            rows = [i for i in range(len(ids) - 1) if not ahead[i] and part[i] == part[i + 1]]
            if not rows:
                continue
            own = sketches(T.Utf8(column))
            made = [edited(texts[i], texts[i + 1]) for i in rows]
            other = sketches(T.Utf8(pa.array(made, type=pa.large_string())))
            out = [
                (ids[i], len(texts[i]), hashlib.sha256(e.encode()).hexdigest(), written(own[i]), written(x), likeness(own[i], x), likeness(own[i], own[i + 1]), len(own[i]), containment(own[i], x))
                for i, e, x in zip(rows, made, other, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)], names=[x.split()[0] for x in schema.split(", ")])

    found = beside_next(df).mapInArrow(run, schema)
    return found.select(T.public_id(), *found.columns[1:])
