"""Embedding near-dedup with coarse inverted lists and product-quantised residuals.

Vectors are put on the unit sphere. Coarse centroids, fitted for each length of vectors on a bounded sample, make the inverted
lists; what is left of a vector after its centroid is coded by a small codebook in each subspace. A vector looks into every
list that is near enough: a partner in another list lies beyond the plane midway between the two centroids, so the list can be
left out when that plane is farther away than a partner can be (``reach``). In many dimensions a partner hardly ever lies
straight ahead; lists are left out when the plane is farther than ``margin`` times that reach, and with margin 1 no link can
be missed. Looked-up dot products of a vector's own parts with the codebooks add up to an estimated cosine with each coded
vector. A code also carries the length of what it leaves out, so an estimate is off by at most that: every pair that may reach
the threshold is reranked by its exact cosine in double precision, and in the lists looked into nothing is lost.

A pair is counted in one place: in the list of the one that the other looks into, or, where both would, in the smaller list
(inside a list, where the smaller one looks). Large lists are cut into chunks, and the many that look into one are dealt out,
so no task holds a list. Tasks return counts and star links per vector, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattfold.llm import meetings as M, texts as T
from wattfold.llm.components import components

THRESHOLD = 0.9
#: Vectors of the sample; vectors of a list on average; lists at most; least number of subspaces and codes in each.
SAMPLE, LIST, LISTS, SUBSPACES, CODES = 8192, 500, 1024, 8, 64
#: Dimensions of a subspace at most. With more, codes leave out so much of a vector that estimates rule out little.
DIMENSIONS = 4
#: How far an estimate may be off by single precision, many times over; a candidate more costs a rerank, never a result.
ROUNDING = 1e-5
#: Standard deviations of a random direction's share of the reach that lists must be near; up to SPREAD ** 2 dimensions nothing is left out.
SPREAD = 2.5
#: Members of a chunk, vectors that look into it in one task, and how many are compared at a time.
CHUNK, LOOKING, BLOCK = 1000, 16_000, 512
_OUT = "vec_id long, twin long, n long, other_id long, other_twin long"


def _kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = (x @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=k)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


class Index:
    """Centroids and codebooks of unit vectors of one length; without a sample, one list with nothing coded."""

    def __init__(self, size: int, sample: np.ndarray, lists: int):
        self.size, self.first = size, 0
        self.cuts, self.books, self.centroids = [], [], np.zeros((1, size))
        if not len(sample):
            return
        self.centroids = _kmeans(sample, min(lists, len(sample)), 8, 1)
        self.centroids /= np.maximum(np.linalg.norm(self.centroids, axis=1), 1e-12)[:, None]
        rest = sample - self.centroids[(sample @ self.centroids.T).argmax(1)]
        self.cuts = np.array_split(np.arange(size), min(max(SUBSPACES, -(-size // DIMENSIONS)), size))
        self.books = [_kmeans(rest[:, c], min(CODES, len(sample)), 6, 2 + i) for i, c in enumerate(self.cuts)]
        gram = self.centroids @ self.centroids.T
        self.apart = np.sqrt(np.maximum(2 - 2 * gram, 0))

    def probed(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """The list of each unit vector, and which lists it looks into: a row a vector, a column a list."""
        if len(self.centroids) == 1:
            return np.zeros(len(x), np.int64), np.ones((len(x), 1), bool)
        likeness = x @ self.centroids.T
        own = likeness.argmax(1)
        return own, likeness[np.arange(len(x)), own][:, None] - likeness <= reach * self.apart[own] + 1e-9

    def coded(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the length of what they leave out."""
        rest = x - self.centroids[lists]
        codes = np.empty((len(x), len(self.cuts)), np.uint8)
        for j, (c, book) in enumerate(zip(self.cuts, self.books)):
            codes[:, j] = (rest[:, c] @ book.T - 0.5 * (book**2).sum(1)).argmax(1)
            rest[:, c] -= book[codes[:, j]]
        return codes, np.linalg.norm(rest, axis=1)

    def estimates(self, looking: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Estimated cosines of the coded vectors of one list (a row each) with unit vectors, by table lookup, in single precision.

        Tables have a row for each code, so that a lookup copies a row for all that look and not a number at a time.
        """
        out = np.repeat((looking @ self.centroids[at]).astype(np.float32)[None], len(codes), 0)
        own = np.empty_like(out)
        for j, (c, book) in enumerate(zip(self.cuts, self.books)):
            np.take((book @ looking[:, c].T).astype(np.float32), codes[:, j], axis=0, out=own, mode="clip")
            out += own
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        x = x / np.abs(x).max(1)[:, None]
        return x / np.linalg.norm(x, axis=1)[:, None]


class Indexes:
    """An index for each length of vectors in the sample; vectors of any other length are one list a length, compared with all of it."""

    def __init__(self, samples: dict[int, np.ndarray], total: int, sampled: int, margin: float | None, threshold: float):
        self.own, self.first, self.margin, self.reach = {}, 0, margin, float(np.sqrt(2 - 2 * threshold))
        for size, sample in sorted(samples.items()):
            wanted = total * len(sample) / max(1, sampled) / LIST
            index = self.own[size] = Index(size, sample, int(np.clip(wanted, 1, min(LISTS, max(1, len(sample) // 8)))))
            index.first = self.first
            self.first += len(index.centroids)

    def of(self, size: int) -> Index:
        if size not in self.own:
            self.own[size] = Index(size, np.zeros((0, size)), 1)
            self.own[size].first = -size
        return self.own[size]

    def probed(self, unit: np.ndarray) -> tuple[Index, np.ndarray, np.ndarray]:
        size = unit.shape[1]
        margin = min(1.0, SPREAD / size**0.5) if self.margin is None else self.margin
        index = self.of(size)
        return index, *index.probed(unit, margin * self.reach)


def _star(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each reaches along links a - b (positions in nodes)."""
    label = nodes.copy()
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        if (new == label).all():
            return label
        label = new


def _compared(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes: Indexes = shared.value
        key, made = None, None

        for now, members, looking in M.meetings(batches, 4, BLOCK):
            size, at = now[0], now[1]
            index = indexes.of(size)
            if now != key:
                table = members.combine_chunks()
                ids, twin = (table.column(n).to_numpy() for n in ("vec_id", "twin"))
                rows = M.distinct_rows(ids, twin)
                unit = _unit(M.matrix(table.column("vector").combine_chunks(), size)[rows])
                _, looks = index.probed(unit, (min(1.0, SPREAD / size**0.5) if indexes.margin is None else indexes.margin) * indexes.reach)
                key, made = now, (ids[rows], twin[rows], unit, looks, *index.coded(unit, np.full(len(unit), at - index.first)))
            ids, twin, unit, looks, codes, left_out = made
            table = looking.combine_chunks()
            mine, my_twin, my_list = (table.column(n).to_numpy() for n in ("vec_id", "twin", "own"))
            rows = M.distinct_rows(mine, my_twin)
            mine, my_twin, my_list = mine[rows], my_twin[rows], my_list[rows]
            z = _unit(M.matrix(table.column("vector").combine_chunks(), size)[rows])
            least = (threshold - ROUNDING - left_out).astype(np.float32)
            m, p = np.nonzero(index.estimates(z, at - index.first, codes) >= least[:, None])
            if not len(p):
                continue
            keep = np.concatenate([np.einsum("ij,ij->i", z[p[k : k + 100_000]], unit[m[k : k + 100_000]]) >= threshold for k in range(0, len(p), 100_000)])
            # One place for each pair.
            both = looks[m, my_list[p] - index.first]
            before = (mine[p] < ids[m]) | ((mine[p] == ids[m]) & (my_twin[p] < twin[m]))
            keep &= np.where(my_list[p] == at, before, ~both | (at < my_list[p]))
            p, m = p[keep], m[keep]
            if not len(p):
                continue
            nodes, others = np.concatenate([mine, ids]), np.concatenate([my_twin, twin])
            n = np.bincount(p, minlength=len(nodes)) + np.bincount(m + len(mine), minlength=len(nodes))
            label = _star(np.arange(len(nodes)), p, m + len(mine))
            some = n > 0
            columns = (nodes[some], others[some], n[some].astype(np.int64), nodes[label[some]], others[label[some]])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[x.split()[0] for x in _OUT.split(", ")])

    return run


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, margin: float | None = None) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id and kept (vec_id = component_id) of every row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different lengths
    never link. A vector is an id and its components: a repeated row is the same vector and gets the same result, different
    vectors that share an id, null above all, are vectors of their own and may link. A null id comes before all others and
    is given back as null; an empty table gives an empty one; other columns are left behind. ``margin``: see above, None for
    SPREAD standard deviations.
    """
    spark = df.sparkSession
    usable = M.usable(df).where(F.exists("embedding", lambda x: x != 0))
    total = usable.count()
    share = min(2**30, 2**30 * SAMPLE // max(1, total) + 1)
    # Rows are drawn by id and content; whatever is drawn, every usable row is indexed.
    sample = usable.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(2**30)) < share).limit(2 * SAMPLE).orderBy("vec_id", "embedding").collect()
    samples: dict[int, list] = {}
    for r in sample:
        samples.setdefault(len(r["embedding"]), []).append(r["embedding"])
    shared = spark.sparkContext.broadcast(Indexes({n: _unit(np.array(x)) for n, x in samples.items()}, total, len(sample), margin, threshold))

    def twinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            twin, good = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, bool)
            known = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(known)
            for own, x in M.by_length(pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(at))], names=["embedding"])):
                twin[at[own]] = M.twins(x)
            good[at] = True
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(twin), pa.array(good)], names=["vec_id", "twin", "good"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in M.by_length(batch):
                index, own, looks = shared.value.probed(_unit(x))
                n = np.arange(len(index.centroids))
                columns = (np.full(len(n), x.shape[1]), n + index.first, np.bincount(own, minlength=len(n)), looks.sum(0))
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["size", "list", "members", "looking"])

    sums = usable.mapInArrow(counted, "size long, list long, members long, looking long").groupBy("size", "list").agg(F.sum("members").alias("m"), F.sum("looking").alias("l"))
    places = {r["list"]: (max(1, -(-r["m"] // CHUNK)), max(1, -(-r["l"] // LOOKING))) for r in sums.collect()}  # a row a list

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, x in M.by_length(batch):
                twin = M.twins(x)
                index, own, looks = shared.value.probed(_unit(x))
                # Vectors that share an id are spread as well.
                key = T.mixed(ids[at].view(np.uint64) ^ twin.view(np.uint64)).tolist()
                out: list[tuple] = []
                for i, (k, home) in enumerate(zip(key, (own + index.first).tolist())):
                    chunks, salts = places[home]
                    out += [(home, k % chunks, s, 0, i, home) for s in range(salts)]
                    for to in (np.flatnonzero(looks[i]) + index.first).tolist():
                        chunks, salts = places[to]
                        out += [(to, c, (k >> 32) % salts, 1, i, home) for c in range(chunks)]
                    if len(out) > 8192 or i == len(key) - 1:
                        yield _placed_batch(out, ids[at], twin, x)
                        out = []

    keys = ("size", "list", "chunk", "salt")
    sent = usable.mapInArrow(placed, "size int, list int, chunk int, salt int, looks int, vec_id long, twin long, vector binary, own int")
    sent = sent.repartition(T.partitions(spark), *keys).sortWithinPartitions(*keys, "looks")
    found = T.checkpointed(sent.mapInArrow(_compared(shared, threshold), _OUT))
    counts = found.groupBy("vec_id", "twin").agg(F.sum("n").alias("n_links"))
    # Linked vectors are numbered, since an id may stand for several.
    nodes = T.checkpointed(T.checkpointed(counts).withColumn("node", F.monotonically_increasing_id()))
    of = lambda i, t, name: nodes.select(F.col("vec_id").alias(i), F.col("twin").alias(t), F.col("node").alias(name))
    links = found.join(of("vec_id", "twin", "a"), ["vec_id", "twin"]).join(of("other_id", "other_twin", "b"), ["other_id", "other_twin"]).select("a", "b")
    parts = components(links).join(nodes, "node")
    least = parts.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    parts = T.checkpointed(parts.join(least, "component").select("vec_id", "twin", "n_links", "component_id"))
    vector = F.when(F.size("embedding") > 0, F.col("embedding")).cast("array<double>")
    rows = df.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(T.NO_ID)).alias("vec_id"), F.when(F.forall(vector, lambda x: x.isNotNull()), vector).alias("embedding"))
    result = rows.mapInArrow(twinned, "vec_id long, twin long, good boolean").join(parts.withColumn("good", F.lit(True)), ["vec_id", "twin", "good"], "left")
    whole = F.coalesce("component_id", "vec_id")
    return result.select(T.public_id("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.nullif(whole, F.lit(T.NO_ID)).alias("component_id"), (F.col("vec_id") == whole).alias("kept"))


def _placed_batch(out: list[tuple], ids: np.ndarray, twin: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    to, chunk, salt, looks, i, own = (np.array(c, np.int64) for c in zip(*out))
    width = 8 * x.shape[1]
    raw = pa.Array.from_buffers(pa.binary(), len(i), [None, pa.py_buffer(np.arange(0, (len(i) + 1) * width, width, dtype=np.int32)), pa.py_buffer(x[i].tobytes())])
    numbers = [pa.array(c.astype(np.int32)) for c in (np.full(len(i), x.shape[1]), to, chunk, salt, looks)]
    return pa.RecordBatch.from_arrays([*numbers, pa.array(ids[i]), pa.array(twin[i]), raw, pa.array(own.astype(np.int32))], names=["size", "list", "chunk", "salt", "looks", "vec_id", "twin", "vector", "own"])
