"""Shared helpers of the text operators: clean input columns, Arrow batches in bounded chunks, words and their hashes."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: A null doc_id is carried as this value inside an operator, so that joins and sorts see it, and given back as null.
NO_ID = -(2**63)
#: Bytes of text that are turned into numpy arrays at a time. A longer text is one chunk of its own.
CHUNK_BYTES = 1_000_000
#: The ASCII characters that separate words: blank and 9 to 13, the set that bytes.split() uses.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True


def documents(df: DataFrame, *more: str) -> DataFrame:
    """doc_id (null: NO_ID), text (null: empty) and further columns; every other column of the input is left behind."""
    return df.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more,
    )


def public_id(name: str = "doc_id"):
    """The id column as it came in."""
    return F.nullif(F.col(name), F.lit(NO_ID)).alias(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle of this session makes."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set, one under the warehouse, which all executors share as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints").rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Written to the shared folder and cut from its sources."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


class Utf8:
    """The bytes of one Arrow string column: text i is data[bounds[i]:bounds[i + 1]]."""

    def __init__(self, column: pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if column.null_count:
            column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        _, offsets, values = column.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        first = int(offsets[0]) if len(offsets) else 0
        self.bounds = offsets - first
        self.raw = bytes(memoryview(values)[first : int(offsets[-1])]) if values is not None and len(column) else b""
        if not len(offsets):
            self.bounds = np.zeros(1, dtype=np.int64)
        self.data = np.frombuffer(self.raw, dtype=np.uint8)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def text(self, i: int) -> bytes:
        return self.raw[self.bounds[i] : self.bounds[i + 1]]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds at most ``limit`` bytes of the text column, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        sizes = np.diff(Utf8(batch.column(at)).bounds)
        start = held = 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n + 1
        yield batch.slice(start)


def give_back() -> None:
    """Hands memory that is free back to the system.

    A Python worker lives on into other stages, and its allocators keep what a task has freed: two workers so held several
    hundred MB of an executor while the JVM needed them.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def leaving_nothing(run):
    """A step over Arrow batches that gives its memory back when a task is through."""
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return clean


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Roller:
    """Hashes of any stretch of a sequence from running sums: sum(value[i] * base**i) modulo 2**64, shifted to position 0.

    For choosing minimisers and for sorting likely equals together only: patterned sequences can collide, so whoever takes
    equal hashes for equal contents compares the contents.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(1 << 60, 1 << 63)) * 2 + 1
        self.inverse = pow(self.base, -1, 2**64)
        self.letters = rng.integers(0, 2**64, size=256, dtype=np.uint64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, dtype=np.uint64)]), dtype=np.uint64) for b in (np.uint64(self.base), np.uint64(self.inverse)))

    def forget(self) -> None:
        """The powers go; they are made again when needed."""
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """n + 1 running sums of n values (uint64)."""
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def stretch(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of values[start:end] for each pair of positions."""
        return mixed((sums[end] - sums[start]) * self.down[start])

    def windows(self, sums: np.ndarray, size: int) -> np.ndarray:
        """The hash of each stretch of ``size`` values."""
        n = len(sums) - size
        return mixed((sums[size:] - sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, dtype=np.uint64)


class Words:
    """The words [^\\x20\\x09-\\x0D]+ of a chunk of texts: their byte ranges, the text of each, and where each text's words begin."""

    def __init__(self, texts: Utf8):
        data, bounds = texts.data, texts.bounds
        if len(data):
            inside = ~SEPARATOR[data]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            starts_of_texts = bounds[:-1][bounds[:-1] < bounds[1:]]
            first[starts_of_texts] = inside[starts_of_texts]
            last = inside.copy()
            last[:-1] &= ~inside[1:]
            ends_of_texts = starts_of_texts[1:] - 1
            last[ends_of_texts] = inside[ends_of_texts]
            self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        else:
            self.start = self.end = np.zeros(0, dtype=np.int64)
        self.bounds = np.searchsorted(self.start, bounds)
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self, texts: Utf8, roller: Roller) -> np.ndarray:
        return roller.stretch(roller.sums(roller.letters[texts.data]), self.start, self.end)

    def numbered(self, texts: Utf8) -> tuple[np.ndarray, list[bytes]]:
        """A number for each word, the same exactly where words are equal, and the distinct words by number."""
        if not len(self.start):
            return np.zeros(0, np.int64), []
        cuts = np.empty(2 * len(self.start), np.int64)
        cuts[::2], cuts[1::2] = self.start, self.end
        between = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(texts.raw)])
        coded = between.take(pa.array(np.arange(0, len(cuts), 2))).dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def digests(words: list[bytes], key: bytes) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of a keyed digest of each word, as two 64-bit numbers."""
    both = np.frombuffer(b"".join([hashlib.blake2b(w, digest_size=16, key=key).digest() for w in words]), "<u8").reshape(-1, 2)
    return both[:, 0].astype(np.uint64), both[:, 1].astype(np.uint64)


def shingles(texts: Utf8, size: int, key: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text, and 128 bits as two numbers, of every shingle of ``size`` words; a text with fewer words is one shingle.

    Every word is digested with a key and spread anew for its place in the shingle, so that neither characters nor words
    that repeat in a pattern can cancel out.
    """
    words = Words(texts)
    number, distinct = words.numbered(texts)
    first, doc = windows_within(words.counts, size)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    halves = []
    for half, value in enumerate(digests(distinct, key)):
        whole, part = np.zeros(len(first), np.uint64), words.counts[short].astype(np.uint64)
        for k in range(size):
            spread = mixed(value + np.uint64((2 * k + half + 1) * 0x9E3779B97F4A7C15 % 2**64))
            whole += spread[number[first + k]]
            has = words.counts[short] > k
            part[has] += spread[number[words.bounds[short[has]] + k]]
        halves.append(mixed(np.concatenate([whole, part])))
    return np.concatenate([doc, short]), *halves


def windows_within(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For groups of ``counts`` items in a row: the first item of every window of ``size`` items inside one group, and its group."""
    n = np.maximum(counts - size + 1, 0)
    group = np.repeat(np.arange(len(counts)), n)
    before = np.cumsum(counts) - counts
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + before[group], group


def sliding_minimum(x: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each ``size`` neighbouring values, by doubling."""
    if len(x) < size:
        return x[:0]
    have, out = 1, x
    while have < size:
        step = min(have, size - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out
