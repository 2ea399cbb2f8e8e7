"""Blocks of stated rows against shards of all rows: what the searches over embeddings have in common.

Rows are sent as (key columns, looks, id, twin, vector, ...): members of a shard with looks = 0, rows that look into it with 1.
A vector is the bytes of its doubles; ``twin`` is a hash of them, so that rows that share an id stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattfold.llm import texts as T


def usable(df: DataFrame, *more: str) -> DataFrame:
    """vec_id (null: NO_ID), embedding (array of doubles) and columns ``more`` of rows whose vectors have components, all of them finite numbers."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where((F.size("embedding") > 0) & finite)
    return rows.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(T.NO_ID)).alias("vec_id"), vector.alias("embedding"), *more)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of a binary column, a row each."""
    return np.frombuffer(T.Utf8(column).raw, np.float64).reshape(-1, size)


def by_length(batch: pa.RecordBatch, name: str = "embedding") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors in the batch: row numbers and the vectors, a row each."""
    column = batch.column(batch.schema.get_field_index(name))
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        yield at, flat[starts[at][:, None] + np.arange(n)]


def twins(x: np.ndarray) -> np.ndarray:
    """A hash of each row."""
    bits = np.ascontiguousarray(x).view(np.uint64)
    total = np.zeros(len(x), np.uint64)
    for k in range(bits.shape[1]):
        total = T.mixed(total * np.uint64(3) + bits[:, k] + np.uint64(k + 1))
    return total.view(np.int64)


def meetings(batches: Iterator[pa.RecordBatch], keys: int, block: int) -> Iterator[tuple[tuple, pa.Table, pa.Table]]:
    """(key, members, rows that look) of rows sorted by key and looks; those that look come in blocks of about ``block`` rows.

    Members are the same object while the key lasts. A shard into which nothing looks, or without members, is passed over.
    """
    now, members, looking, held, whole = None, [], [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys + 1)]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(int(c[a]) for c in columns[:keys])
            if key != now:
                if whole is not None and looking:
                    yield now, whole, pa.Table.from_batches(looking)
                now, members, looking, held, whole = key, [], [], 0, None
            part = batch.slice(a, b - a)
            if columns[keys][a] == 0:
                members.append(part)
            elif members:
                whole = pa.Table.from_batches(members) if whole is None else whole
                while part.num_rows:
                    looking.append(part.slice(0, block - held))
                    held += looking[-1].num_rows
                    part = part.slice(looking[-1].num_rows)
                    if held == block:
                        yield now, whole, pa.Table.from_batches(looking)
                        looking, held = [], 0
    if whole is not None and looking:
        yield now, whole, pa.Table.from_batches(looking)


def distinct_rows(ids: np.ndarray, twin: np.ndarray) -> np.ndarray:
    """The positions of distinct (id, twin) pairs, ascending by them."""
    order = np.lexsort((twin, ids))
    new = np.ones(len(order), bool)
    new[1:] = (ids[order[1:]] != ids[order[:-1]]) | (twin[order[1:]] != twin[order[:-1]])
    return order[new]
