"""Hard-negative mining with Fagin's threshold algorithm over integer vectors.

A shard holds its rows once and, for each dimension, their order by that component. For an anchor the lists are read from the
end that its component's sign favours (sorted access); every row that turns up is scored whole, as an integer inner product
(random access). What no list has shown yet scores no more than the threshold, the inner product of the anchor with the values
that the lists stand at. Reading stops once the threshold lies strictly below the k-th score kept, or below all that is wanted.

Two rounds: positives are searched in shards of the anchor's label, negatives in shards of all rows. A negative search serves
all positives of an anchor at once, a window of scores for each, and stops when every window is done.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wattfold.llm import meetings as M, texts as T

EVERY, POSITIVES, NEGATIVES = 100, 5, 10
#: A component is scaled by this and rounded down. Of a positive's score, the least and most that a negative may have, in percent.
SCALE, LEAST, MOST = 256, 30, 90
#: Rows of a shard on average; anchors that look into a shard in one task, and how many come at a time; first depth of sorted access.
SHARD, LOOKING, BLOCK, DEPTH = 8192, 8192, 512, 16
_LIMIT = 2**63 - 1
_SENT = "size int, label long, sub int, salt int, looks int, vec_id long, twin long, vector binary, own_label long, low array<long>, high array<long>"


class Lists:
    """Rows of integers with a list for each dimension, ascending by its component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.order = np.argsort(x, axis=0, kind="stable")
        self.largest = float(np.abs(x).max(initial=0))

    def windows(self, own: int, a: np.ndarray, wanted: np.ndarray, low: list, high: list, k: int) -> list[tuple[np.ndarray, list]]:
        """For each window [low, high] the best k rows of ``wanted`` but ``own``: positions and scores, best first, ties to the smaller id."""
        n, used = len(self.ids), np.flatnonzero(a)
        exact = self.largest * float(np.abs(a).max(initial=0)) * len(a) < 2**53  # else whole numbers of any size
        x, a = (self.x, a) if exact else (None, np.array([int(v) for v in a], object))
        up = a[used] > 0
        seen = ~wanted | (self.ids == own)
        kept: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64 if exact else object)) for _ in low]
        open_ = list(range(len(low)))
        depth = done = 0
        while open_ and done < n:
            depth = min(n, max(DEPTH, 4 * depth))
            # Sorted access: the next stretch of every list.
            shown = np.concatenate([self.order[n - depth : n - done][:, used[up]].ravel(), self.order[done:depth][:, used[~up]].ravel()]) if len(used) else np.arange(n)
            fresh = np.zeros(n, bool)
            fresh[shown] = True
            fresh = np.flatnonzero(fresh & ~seen)
            seen[fresh] = True
            # Random access.
            scores = (x[fresh] @ a).astype(np.int64) if exact else np.array([sum(int(v) * w for v, w in zip(self.x[r].tolist(), a)) for r in fresh.tolist()], object)
            for w in open_:
                fits = (scores >= low[w]) & (scores <= high[w])
                rows, values = np.concatenate([kept[w][0], fresh[fits]]), np.concatenate([kept[w][1], scores[fits]])
                best = np.lexsort((self.ids[rows], [-v for v in values.tolist()]))[:k] if exact else np.array(sorted(range(len(rows)), key=lambda i: (-values[i], self.ids[rows[i]]))[:k], np.int64)
                kept[w] = rows[best], values[best]
            done = depth if len(used) else n
            at = np.where(up, self.order[n - done, used], self.order[done - 1, used])
            threshold = sum(int(v) * int(c) for v, c in zip(self.x[at, used].tolist(), a[used].tolist()))
            open_ = [w for w in open_ if not (threshold < low[w] or (len(kept[w][0]) == k and threshold < kept[w][1][-1]))]
        return [(rows, [int(v) for v in values]) for rows, values in kept]


def _dealt(counts: dict, looking: dict, members: bool, by_label: bool):
    """Members of shards, or anchors that look into the shards of their label or of all rows."""
    def shards(size: int, label: int) -> int:
        return max(1, -(-counts.get((size, label), 0) // SHARD))

    def salts(size: int, label: int) -> int:
        return max(1, -(-looking.get((size, label), 0) // LOOKING))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
            windows = None if members or by_label else [batch.column(batch.schema.get_field_index(c)) for c in ("low", "high")]
            for at, x in M.by_length(batch):
                size, twin, key = x.shape[1], M.twins(x), T.mixed(ids[at].view(np.uint64)).tolist()
                where: list[tuple] = []
                for i, (label, h) in enumerate(zip(labels[at].tolist() if by_label else [0] * len(at), key)):
                    n, m = shards(size, label), salts(size, label)
                    where += [(label, h % n, s, i) for s in range(m)] if members else [(label, s, (h >> 32) % m, i) for s in range(n)]
                scaled = np.floor(SCALE * x)
                for first in range(0, len(where), 4096):
                    label, sub, salt, i = (np.array(v) for v in zip(*where[first : first + 4096]))
                    width = 8 * size
                    raw = pa.Array.from_buffers(pa.binary(), len(i), [None, pa.py_buffer(np.arange(0, (len(i) + 1) * width, width, dtype=np.int32)), pa.py_buffer(scaled[i].tobytes())])
                    ranges = [pa.nulls(len(i), pa.list_(pa.int64()))] * 2 if windows is None else [w.take(pa.array(at[i])) for w in windows]
                    flat = (np.full(len(i), size), label, sub, salt, np.full(len(i), 0 if members else 1))
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(v, pa.int64() if k == 1 else pa.int32()) for k, v in enumerate(flat)), pa.array(ids[at][i]), pa.array(twin[i]), raw, pa.array(labels[at][i]), *ranges],
                        names=[v.split()[0] for v in _SENT.split(", ")],
                    )

    return run


def _searched(k: int, positives: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lists = None, None
        for now, members, looking in M.meetings(batches, 4, BLOCK):
            if now != key:
                table = members.combine_chunks()
                ids, twin, labels = (table.column(n).to_numpy() for n in ("vec_id", "twin", "own_label"))
                # A repeated row is one row; the label tells rows apart as well.
                rows = M.distinct_rows(ids, T.mixed(labels.view(np.uint64)).view(np.int64) ^ twin)
                key, lists = now, Lists(ids[rows], labels[rows], M.matrix(table.column("vector").combine_chunks(), now[0])[rows])
            looking = looking.combine_chunks()
            ids, twin, labels = (looking.column(n).to_numpy() for n in ("vec_id", "twin", "own_label"))
            low, high = (looking.column(n).to_pylist() for n in ("low", "high"))
            vectors, out, done = M.matrix(looking.column("vector").combine_chunks(), now[0]), [], set()
            for j, (i, t, label) in enumerate(zip(ids.tolist(), twin.tolist(), labels.tolist())):
                if (i, t, label) in done:
                    continue
                done.add((i, t, label))
                wanted = (lists.labels == label) == positives
                ranges = ([-np.inf], [np.inf]) if positives else (low[j], high[j])
                for w, (found, scores) in enumerate(lists.windows(i, vectors[j], wanted, *ranges, k)):
                    out += [(i, t, label, w, r, max(-_LIMIT, min(_LIMIT, s))) for r, s in zip(lists.ids[found].tolist(), scores)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)], names=["anchor_id", "twin", "own_label", "place", "vec_id", "score"])

    return run


def _found(rows: DataFrame, anchors: DataFrame, k: int, positives: bool) -> DataFrame:
    """anchor_id, twin, own_label, place (of the window), vec_id, score and rank of the best k rows of each window."""
    spark = rows.sparkSession
    group = ("size", "label") if positives else ("size", F.lit(0).cast("long").alias("label"))
    sized = lambda df: {(r["size"], r["label"]): r["count"] for r in df.select("*", F.size("embedding").alias("size")).groupBy(*group).count().collect()}  # noqa: E731 - a row a label and length
    counts, looking = sized(rows.select("vec_id", "embedding", "label")), sized(anchors.select("vec_id", "embedding", "label"))
    columns = ["vec_id", "embedding", "label"]
    members = rows.select(*columns).mapInArrow(_dealt(counts, looking, True, positives), _SENT)
    asking = anchors.select(*columns, *([] if positives else ["low", "high"])).mapInArrow(_dealt(counts, looking, False, positives), _SENT)
    keys = ("size", "label", "sub", "salt")
    sent = members.union(asking).repartition(T.partitions(spark), *keys).sortWithinPartitions(*keys, "looks")
    found = sent.mapInArrow(_searched(k, positives), "anchor_id long, twin long, own_label long, place long, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "twin", "own_label", "place").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _twin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors with their twins, so that what was found for them can be joined."""
    for batch in batches:
        twin = np.zeros(batch.num_rows, np.int64)
        for at, x in M.by_length(batch):
            twin[at] = M.twins(x)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(twin)], names=[*batch.schema.names, "twin"])


def mine(df: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: hard negatives of each anchor and positive.

    Labels of every seventh vec_id become (label + 1) % 10 first. Rows with a null label, a null or empty vector, or a null
    or non-finite component take no part; zero vectors do. Vectors of different lengths never meet. Anchors are rows whose
    vec_id is divisible by ``every``; rows of the anchor's own vec_id are no partners; a repeated row is one row, different
    vectors or labels of one vec_id are rows and anchors of their own. A null id keeps its label and comes first in ties.
    Scores beyond 64 bits are stated as the largest number of their sign. An empty table gives an empty one; other columns
    are left behind.
    """
    label = F.col("label").cast("long")
    rows = M.usable(df.where("label is not null"), F.when(F.col("vec_id").cast("long") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    anchors = rows.where(F.col("vec_id") % every == 0)
    near = T.checkpointed(_found(rows, anchors, positives, True).select("anchor_id", "twin", "own_label", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # 30 p <= 100 n <= 90 p, as whole numbers n from low to high.
    step = lambda x, y: F.floor(F.col("positive_score").cast("decimal(25,0)") * x / y).cast("long")
    low = -F.floor(-F.col("positive_score").cast("decimal(25,0)") * LEAST / 100).cast("long")
    windows = near.withColumn("w", F.struct("place", low.alias("low"), step(MOST, 100).alias("high")))
    windows = windows.groupBy("anchor_id", "twin", "own_label").agg(F.sort_array(F.collect_list("w")).alias("w"))  # at most ``positives`` each
    windows = windows.select(F.col("anchor_id").alias("vec_id"), "twin", F.col("own_label").alias("label"), F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    known = anchors.mapInArrow(_twin, "vec_id long, embedding array<double>, label long, twin long")
    asking = known.join(windows, ["vec_id", "twin", "label"])
    far = T.checkpointed(_found(rows, asking, negatives, False).withColumn("place", F.col("place") + 1))
    both = far.join(near, ["anchor_id", "twin", "own_label", "place"])
    return both.select("anchor_id", T.public_id("positive_id"), "rank", T.public_id("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
