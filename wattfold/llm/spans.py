"""Packed blocks that travel to buckets, and removed spans on their way back to their documents.

A document of op3 and op7 is an id and a text: its inner key is doc_id and a 64-bit digest of the text, its twin, so that
texts that share an id (null ids above all) stay apart. Keys are ordered by id, then twin. Equal rows have equal keys.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from wattfold.llm import texts as T

#: What the first step emits and the second returns: a block for a bucket, or a span of a document.
ROW = "bucket int, doc_id long, first long, last long, block binary"
_NAMES = ["bucket", "doc_id", "first", "last", "block"]


def documents(df: DataFrame, *more: str) -> DataFrame:
    """doc_id, text, twin and further columns, see texts.documents."""
    return T.documents(df, *more).select("doc_id", "text", F.xxhash64("text").alias("twin"), *more)


def numbered(ids: np.ndarray, twins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each key, in their order, and the id and twin of each number."""
    order = np.lexsort((twins, ids))
    ids, twins = ids[order], twins[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (twins[1:] != twins[:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, ids[new], twins[new]


def packed(ids: list[int], starts: list[int], marks: list[int], parts: list[bytes], twins: list[int] = (), level: int = 3) -> bytes:
    """Stretches of documents in one compressed block: ids, places, a 32-bit mark each, lengths, contents, and twins if given."""
    arrays = (np.array(ids, np.int64), np.array(starts, np.int64), np.array(marks, np.uint32), np.array([len(x) for x in parts], np.uint32))
    raw = b"".join([struct.pack("<q", len(parts)), np.diff(arrays[0], prepend=0).tobytes(), arrays[1].astype(np.uint32).tobytes(), *(a.tobytes() for a in arrays[2:]), *parts, np.diff(np.array(twins, np.int64), prepend=0).tobytes()])
    return zstandard.compress(raw, level)


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """ids, places, marks, lengths, and the contents in a row, with what twins() reads after them."""
    raw = zstandard.decompress(block)
    (n,), at = struct.unpack_from("<q", raw), 8
    ids = np.cumsum(np.frombuffer(raw, np.int64, n, at))
    at += 8 * n
    starts, marks, lengths = (np.frombuffer(raw, np.uint32, n, at + 4 * n * k) for k in range(3))
    return ids, starts.astype(np.int64), marks, lengths.astype(np.int64), raw[at + 12 * n :]


def twins(lengths: np.ndarray, contents: bytes) -> np.ndarray:
    """The twins that follow the contents of a block."""
    return np.cumsum(np.frombuffer(contents, np.int64, len(lengths), int(lengths.sum())))


def block_rows(buckets: list[int], blocks: list[bytes]) -> pa.RecordBatch:
    n = len(buckets)
    empty = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), empty, empty, empty, pa.array(blocks, pa.binary())], names=_NAMES)


def span_rows(ids: np.ndarray, first: np.ndarray, last: np.ndarray, buckets: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array((ids % buckets).astype(np.int32)), pa.array(ids.astype(np.int64)), pa.array(first.astype(np.int64)), pa.array(last.astype(np.int64)), pa.nulls(len(ids), pa.binary())], names=_NAMES,
    )


def document_rows(ids: np.ndarray, twins: np.ndarray, first: np.ndarray, last: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Spans of documents: id, twin, and the span in one number, see document_spans."""
    bucket = pa.array(((ids ^ twins) % buckets).astype(np.int32))
    return pa.RecordBatch.from_arrays([bucket, *(pa.array(x.astype(np.int64)) for x in (ids, twins, first << 32 | last)), pa.nulls(len(ids), pa.binary())], names=_NAMES)


def document_spans(found: DataFrame) -> DataFrame:
    """doc_id, twin and span (first * 2**32 + last) of rows made by document_rows."""
    return found.select("doc_id", F.col("first").alias("twin"), F.col("last").alias("span"))


def runs(ids: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``size`` items at (ids, starts), in any order, as spans [first, last) that neither touch nor overlap."""
    if not len(ids):
        return ids, starts, starts
    order = np.lexsort((starts, ids))
    ids, starts = ids[order], starts[order]
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (starts[1:] > starts[:-1] + size)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(ids)) - 1
    return ids[begin], starts[begin], starts[end] + size


def later_copies(keys: list[np.ndarray], ids: np.ndarray, starts: np.ndarray, raw: bytes | None = None, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
    """Which rows have an equal key at a smaller (id, start); keys are compared as tuples.

    With ``raw``, row i stands for raw[begin[i] : end[i]]: keys then only bring likely equals together, and rows are equal
    where these contents are.
    """
    order = np.lexsort((starts, ids, *reversed(keys)))
    same = np.ones(max(0, len(order) - 1), dtype=bool)
    for k in keys:
        same &= k[order[1:]] == k[order[:-1]]
    group = np.concatenate([[0], np.cumsum(~same)]) if len(order) else np.zeros(0, np.int64)
    lead = order[np.searchsorted(group, group)]  # the first of each group
    if raw is not None:
        mine = np.flatnonzero(lead != order)
        pairs = zip(*(x.tolist() for x in (begin[order[mine]], end[order[mine]], begin[lead[mine]], end[lead[mine]])))
        other = np.fromiter((raw[a:b] != raw[c:d] for a, b, c, d in pairs), bool, len(mine))
        for g in np.unique(group[mine[other]]).tolist():  # contents that share a key: told apart one by one
            firsts: dict[bytes, int] = {}
            for place in range(*np.searchsorted(group, [g, g + 1]).tolist()):
                row = int(order[place])
                lead[place] = firsts.setdefault(raw[begin[row] : end[row]], row)
    out = np.zeros(len(order), dtype=bool)
    out[order] = (ids[order] != ids[lead]) | (starts[order] != starts[lead])
    return out


def with_spans(docs: DataFrame, found: DataFrame, *keep: str) -> DataFrame:
    """Each document with the spans found in it, as one array of numbers (null: none)."""
    spans = found.groupBy("doc_id", "twin").agg(F.collect_set("span").alias("spans"))
    return docs.join(spans, ["doc_id", "twin"], "left").select("doc_id", "text", *keep, "spans")


def span_lists(column: pa.Array) -> Iterator[list[tuple[int, int]]]:
    """Sorted spans of each row, with touching ones joined."""
    for row in column.to_pylist():
        out: list[list[int]] = []
        for s in ((x >> 32, x & 0xFFFFFFFF) for x in sorted(row or ())):
            if out and s[0] <= out[-1][1]:
                out[-1][1] = max(out[-1][1], s[1])
            else:
                out.append([*s])
        yield [(a, b) for a, b in out]
