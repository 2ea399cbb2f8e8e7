"""Language identification with a string kernel.

The kernel of two texts is the number of byte n-grams (one to four, of the lower-cased UTF-8 text) that both contain, over
the geometric mean of their numbers: a blended-spectrum presence kernel. N-grams are hashed to ``SLOTS`` slots. Nyström
landmarks turn a text into kernel values with few texts, whitened by the landmarks' own kernel matrix; one-versus-rest kernel
ridge regression on these values scores every language. Texts are scored in batches, by matrix products.

The classifier is fitted on a bounded sample: for each language at most ``SAMPLE`` documents, those with the smallest hash of
their id, of which ``LANDMARKS`` are landmarks. Everything else covers whole texts and all documents.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wattfold.llm import texts as T

ORDERS, SLOTS = (1, 2, 3, 4), 2**15
#: Sampled documents and landmarks for each language, and the ridge.
SAMPLE, LANDMARKS, RIDGE = 250, 24, 0.01
#: How sharply regression values turn into a score; texts in one matrix product.
SHARPNESS, ROWS = 5.0, 128
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def presence(texts: list[str]) -> np.ndarray:
    """A row of 0 and 1 for each text: which slots its n-grams fill."""
    raw = [x.lower().encode("utf-8", "replace") for x in texts]
    out = np.zeros((len(raw), SLOTS), np.float32)
    start = 0
    while start < len(raw):
        stop, held = start + 1, len(raw[start])
        while stop < len(raw) and held + len(raw[stop]) <= T.CHUNK_BYTES:
            held += len(raw[stop])
            stop += 1
        data = np.frombuffer(b"".join(raw[start:stop]), np.uint8)
        lengths = np.array([len(x) for x in raw[start:stop]])
        doc = np.repeat(np.arange(start, stop, dtype=np.int32), lengths)
        code = np.zeros(len(data), np.uint64)
        for n in ORDERS:
            if len(data) < n:
                break
            code = (code[: len(data) - n + 1] << np.uint64(8)) | data[n - 1 :]
            inside = doc[: len(code)] == doc[n - 1 :]
            slot = ((code + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)
            out[doc[: len(code)][inside], slot[inside].astype(np.int32)] = 1
        start = stop
    return out


class Model:
    """Landmarks and weights; ``scores`` gives one value for each text and language."""

    def __init__(self, rows: np.ndarray, languages: list[str]):
        self.languages = sorted(set(languages))
        label = np.array([self.languages.index(x) for x in languages], int)
        seen = np.zeros(len(self.languages), int)
        chosen = []
        for i, k in enumerate(label):
            if seen[k] < LANDMARKS:
                chosen.append(i)
                seen[k] += 1
        if not self.languages:
            return
        self.landmarks = rows[chosen].T.copy()
        self.norm = np.sqrt(np.maximum(rows[chosen].sum(1), 1))
        values, vectors = np.linalg.eigh(self.kernel(rows[chosen]).astype(np.float64))
        keep = values > 1e-6 * values.max()
        self.whiten = vectors[:, keep] / np.sqrt(values[keep])
        features = self.features(rows)
        # Each language has the same weight in the fit, however many documents it has.
        weight = (1.0 / np.bincount(label))[label][:, None]
        target = np.where(label[:, None] == np.arange(len(self.languages)), 1.0, -1.0)
        gram = features.T @ (weight * features)
        self.weights = np.linalg.solve(gram + RIDGE * np.eye(len(gram)), features.T @ (weight * target))

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        return (rows @ self.landmarks) / (np.sqrt(np.maximum(rows.sum(1), 1))[:, None] * self.norm)

    def features(self, rows: np.ndarray) -> np.ndarray:
        values = self.kernel(rows) @ self.whiten
        return np.concatenate([values, np.ones((len(values), 1))], 1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """A language and a score from 0 to 1 for each text; UNKNOWN and 0 for null texts and texts without a letter."""
        languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [i for i, x in enumerate(texts) if x is not None and _LETTER.search(x)] if self.languages else []
        for at in range(0, len(known), ROWS):
            own = known[at : at + ROWS]
            value = SHARPNESS * (self.features(presence([texts[i] for i in own])) @ self.weights)
            value = np.exp(value - value.max(1, keepdims=True))
            value /= value.sum(1, keepdims=True)
            for i, k, s in zip(own, value.argmax(1), value.max(1)):
                languages[i], scores[i] = self.languages[k], float(s)
        return languages, scores


def held_out(name: str = "doc_id") -> Column:
    """True for documents that are never learnt from."""
    return F.coalesce(F.crc32(F.col(name).cast("string")) % 5 == 0, F.lit(False))


def fit(df: DataFrame) -> Model:
    """A model from the text and non-null lang of documents that are not held out; null ids are not learnt from.

    The ids of the sample are chosen on ids and languages alone, at most SAMPLE a language in each task before anything is
    shuffled. Only the sample's n-gram bits come to the driver, SLOTS / 8 bytes each.
    """
    usable = df.select("doc_id", F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = [r["doc_id"] for r in usable.withColumn("k", F.row_number().over(first)).where(F.col("k") <= SAMPLE).select("doc_id").collect()]

    def run(batches):
        for batch in T.chunks(batches):
            rows = [np.packbits(presence([x])[0].astype(bool)).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.binary())], names=["doc_id", "lang", "bits"])

    if not ids:
        return Model(np.zeros((0, SLOTS), np.float32), [])
    chosen = df.where(F.col("doc_id").isin(ids) & F.col("lang").isNotNull())
    found = T.documents(chosen, F.col("lang").cast("string").alias("lang")).mapInArrow(run, "doc_id long, lang string, bits binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["lang"], bytes(r["bits"])))
    bits = np.array([np.frombuffer(r["bits"], np.uint8) for r in found])
    return Model(np.unpackbits(bits, axis=1).astype(np.float32), [r["lang"] for r in found])


def identified(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """lang_pred, score, letters (whether the text has one) and the columns ``keep`` of every row with a text column.

    One pass over Arrow batches cut by bytes of text: each text is scored once, whatever is filtered or selected afterwards.
    The model, of bounded size for each language, is a broadcast variable.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "lang_pred string, score double, letters boolean" + "".join(f", `{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    names = ["lang_pred", "score", "letters", *keep]

    def run(batches):
        for batch in T.chunks(batches, column="_text"):
            texts = batch.column(0).to_pylist()
            languages, scores = shared.value.predict(texts)
            found = [pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array([x is not None and _LETTER.search(x) is not None for x in texts], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*found, *(batch.column(1 + k) for k in range(len(keep)))], names=names)

    return docs.select(F.col("text").cast("string").alias("_text"), *keep).mapInArrow(T.leaving_nothing(run), schema)


def identify(df: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    Null and empty texts get ``und``; whole texts are read, however long; repeated rows give equal rows; without a labelled
    row every text gets ``und``; an empty table gives an empty one; other columns are left behind. Null ids are not held out,
    nor learnt from.
    """
    return identified(df, model or fit(df), "doc_id").select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
