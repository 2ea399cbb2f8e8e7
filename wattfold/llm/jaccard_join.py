"""N-gram Jaccard join with prefix trees.

Sets of word shingles are joined where ``100 * common >= 90 * union`` (a percentage parameter). The way:

1. Each text becomes the ascending 64-bit hashes of its distinct shingles and a 128-bit digest of the set of 128-bit shingle
   hashes. Equal digests form a class, represented by its smallest document, so copies never meet pairwise. A document is an
   id and a text (see spans), so texts that share an id, null above all, are documents of their own.
2. Two linked sets differ in at most D elements, D known from their sizes. If the range of hashes is divided into D + 1 parts,
   linked sets agree in one part entirely. Sets are dealt into size levels, each with its own number of parts; a set states its
   parts for its own level and the next, so every linked pair has a part in common. There are more parts than D + 1, and a set
   states its D + 1 rarest, as counted over all documents: shared passages and formulas seldom make candidates. Sets with a
   common part are candidates, chained to the smallest one; components of these chains are the blocks within which all links lie.
3. A block that fills no more than a chunk is one; a larger one is dealt into size levels and these into chunks. The sets of
   a chunk travel once, to the task that packs them; compressed together, near copies take little more room than one set.
   The packed chunk then meets itself and every chunk of its level and of the neighbouring levels, between which all links
   lie. Two chunks are joined with a prefix tree: the sets of one are stored in a trie in one global order, frequent elements
   first, and the tree is walked once for all sets of the other chunk, one vector of partial overlaps per node, shared by all
   sets below it. A path is left as soon as no set can reach the bound with the elements that remain on it.
4. The links that connect new parts are kept, and components over the representatives give the classes of documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from wattfold.llm import spans as S, texts as T
from wattfold.llm.components import components

SHINGLE, PERCENT = 3, 90
#: Sets in a chunk of a block, and their elements; a chunk holds about as many at most, or one set.
CHUNK, ELEMENTS = 1024, 1_000_000
#: Cells of a membership table, and the most right sets that a tree is walked for at once.
CELLS, WIDTH = 32_000_000, 256
#: A chunk's number is its shelf times this, and its number on the shelf. Shelf 0 is a whole small block, others are a level each.
_LEVEL = 2**20
#: Counters of the frequency sketch as a power of two (16 MB at any input size), and the pieces in which they are summed.
COUNTER_BITS, SEGMENTS = 22, 64
_KEY = b"jaccard"


def shingle_sets(texts: T.Utf8, size: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each text the ascending hashes of its distinct shingles, and as many bits again of each; fewer words than a shingle are one."""
    doc, value, more = T.shingles(texts, size, _KEY)
    # By hash, then stably by text, which numpy does much faster than lexsort.
    order = np.argsort(value)
    order = order[np.argsort(doc[order].astype(np.uint16 if len(texts) <= 2**16 else np.int64), kind="stable")]
    same = (value[order[1:]] == value[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    if (same & (more[order[1:]] != more[order[:-1]])).any():  # hashes that differ in the second half only
        order = np.lexsort((more, value, doc))
    value, more, doc = value[order], more[order], doc[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1]) | (more[1:] != more[:-1])
    value, more, doc = value[new], more[new], doc[new]
    cuts = np.searchsorted(doc, np.arange(1, len(texts)))
    return (np.split(value, cuts), np.split(more, cuts)) if len(texts) else ([], [])


def most_apart(n: int, percent: int) -> int:
    """The most elements in which two linked sets may differ when neither has more than n."""
    best = 0
    for other in range(n, 0, -1):
        if 100 * other < percent * n:
            break
        common = -(-percent * (n + other) // (100 + percent))
        best = max(best, n + other - 2 * common)
    return best


class Levels:
    """Size levels: level k holds the sizes from start[k] to start[k + 1] - 1, whose partners lie in levels k - 1 to k + 1.

    Linked sets of a level differ in at most D parts. With ``spare`` parts more than D + 1, they agree in at least spare + 1.
    Each set leaves out its ``spare`` most frequent parts, in an order that both see alike for an agreeing part: of the parts
    that agree, the rarest has at least ``spare`` more frequent ones in either set, so both state it.
    """

    def __init__(self, percent: int):
        self.percent, self.start, self.parts, self.spare = percent, [1], [], []

    def upto(self, n: int) -> None:
        while self.start[-1] <= n:
            a = self.start[-1]
            self.start.append(max(a + 1, a * 100 // self.percent + 1))
            top = self.start[-1] - 1
            apart = max(most_apart(m, self.percent) for m in range(a, top + 1)) if top - a < 50 else 2 * top * (100 - self.percent) // (100 + self.percent)
            spare = apart and max(1, apart // 2)
            self.parts.append(apart + 1 + spare)
            self.spare.append(spare)

    def of(self, n: int) -> int:
        self.upto(n + 1)
        return int(np.searchsorted(self.start, n, side="right")) - 1

    def schemes(self, n: int) -> list[tuple[int, int]]:
        """(level, number of parts) for which a set of n elements states its parts: its own, and the next as the smaller partner."""
        k = self.of(n)
        self.upto(self.start[k + 1])
        return [(j, self.parts[j]) for j in (k, k + 1)]


def part_digests(values: np.ndarray, counts: np.ndarray, level: int, parts: int, spare: int) -> np.ndarray:
    """A digest of the elements in each part of the range of hashes, without the ``spare`` most frequent parts.

    A part is as frequent as its rarest element by ``counts``; an empty part is the most frequent, ties go by digest.
    """
    part = T.mixed(values ^ np.uint64(level * 7919 + 1)) >> np.uint64(11)
    part = (part.astype(np.float64) * (parts / 2.0**53)).astype(np.int64)
    np.minimum(part, parts - 1, out=part)
    total = np.zeros(parts, np.uint64)
    np.add.at(total, part, T.mixed(values + np.uint64(977)))
    digests = T.mixed(total ^ T.mixed(np.arange(parts, dtype=np.uint64) + np.uint64(level * 1_000_003 + parts)))
    rarest = np.full(parts, 2**32, np.int64)
    np.minimum.at(rarest, part, counts)
    return digests[np.lexsort((digests, rarest))[: parts - spare]]


def _sets(batch: pa.RecordBatch, size: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    own = T.Utf8(batch.column(batch.schema.get_field_index("text")))
    return shingle_sets(T.Utf8(pa.array([own.text(i).lower() for i in range(len(own))], pa.large_binary())), size)


def _digest(values: np.ndarray, more: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes() + more.tobytes(), digest_size=16).digest() if len(values) else None


def _key(digest: bytes) -> int:
    """A set's key in the search for candidates. Sets that share one are candidates of each other, which costs work, never a result."""
    return int.from_bytes(digest[:8], "little", signed=True)


def set_rows(docs: DataFrame, size: int, *more: str) -> DataFrame:
    """digest (null: no elements), the columns ``more``, and the set (8 bytes an element)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            sets, others = _sets(batch, size)
            digests = pa.array([_digest(x, y) for x, y in zip(sets, others)], pa.binary())
            yield pa.RecordBatch.from_arrays([digests, *(batch.column(1 + k) for k in range(len(more))), pa.array([x.tobytes() for x in sets], pa.binary())], names=["digest", *more, "set"])

    schema = "digest binary" + "".join(f", {m} {docs.schema[m].dataType.simpleString()}" for m in more) + ", set binary"
    return docs.select("text", *more).mapInArrow(T.leaving_nothing(run), schema)


def noted(docs: DataFrame, size: int) -> DataFrame:
    """In one pass over the texts: doc_id, twin, n_shingles, digest and key (null: no elements) of each, and each task's counters.

    Rows with a ``segment`` hold ``counts``, how many documents of a task hold a shingle, packed: 2**COUNTER_BITS counters,
    addressed by the hash's top bits, in SEGMENTS pieces.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2**COUNTER_BITS, np.uint32)
        for batch in T.chunks(batches):
            sets, others = _sets(batch, size)
            np.add.at(total, _counter(np.concatenate(sets)), np.uint32(1))
            digests = [_digest(x, y) for x, y in zip(sets, others)]
            columns = [batch.column(1), batch.column(2), pa.array([len(x) for x in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array([x and _key(x) for x in digests], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(sets), pa.int64()), pa.nulls(len(sets), pa.binary())], names=names)
        for k, own in enumerate(total.reshape(SEGMENTS, -1)):
            if own.any():
                empty = [pa.nulls(1, kind) for kind in (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())]
                yield pa.RecordBatch.from_arrays([*empty, pa.array([k], pa.int64()), pa.array([zstandard.compress(own.tobytes(), 1)], pa.binary())], names=names)

    schema = "doc_id long, twin long, n_shingles long, digest binary, key long, segment long, counts binary"
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select("text", "doc_id", "twin").mapInArrow(T.leaving_nothing(run), schema)


def shingle_counts(found: DataFrame) -> np.ndarray:
    """About how many documents hold a shingle, over all documents: the sums of the counters that ``noted`` gives by segment.

    Counters only steer the search for candidates: whatever they hold, no linked pair is missed. Their number does not depend
    on the input, so that they fit the driver and a broadcast at any size; shingles that share a counter look more frequent.
    """
    each = 2**COUNTER_BITS // SEGMENTS

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = totals.setdefault(k, np.zeros(each, np.uint64))
                own += np.frombuffer(zstandard.decompress(packed.as_py()), np.uint32)
        for k, own in totals.items():
            least = np.minimum(own, np.uint64(2**32 - 1)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([zstandard.compress(least.tobytes(), 1)])], names=["segment", "counts"])

    own = found.where("segment is not null").select("segment", "counts")
    counts = np.zeros((SEGMENTS, each), np.uint32)
    for row in own.repartition(SEGMENTS, "segment").mapInArrow(summed, "segment long, counts binary").collect():  # SEGMENTS rows
        counts[row["segment"]] = np.frombuffer(zstandard.decompress(bytes(row["counts"])), np.uint32)
    return counts.ravel()


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _candidate_chains(docs: DataFrame, size: int, percent: int, counters: np.ndarray) -> DataFrame:
    """Candidate links (a, b) of set keys: each set with the smallest one that has a part in common. ``counters``: see shingle_counts."""
    buckets = T.partitions(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(counters)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, counts = Levels(percent), shared.value
        for batch in T.chunks(batches, limit=3 * T.CHUNK_BYTES):
            digests, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for part in T.chunks(iter([batch])):
                for values, more in zip(*_sets(part, size)):
                    if not len(values):
                        continue
                    i, held = _key(_digest(values, more)), counts[_counter(values)].astype(np.int64)
                    for level, n in levels.schemes(len(values)):
                        if n == 1:
                            continue  # only equal sets can link
                        stated = part_digests(values, held, level, n, levels.spare[level])
                        digests.append(stated)
                        owners.append(np.full(len(stated), i, np.int64))
            yield from _stated(np.concatenate(digests), np.concatenate(owners), buckets)

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, owners, pairs = [], [], []
        for batch in batches:
            passed = batch.filter(batch.column(4).is_null())
            pairs.append(np.stack([passed.column(k).to_numpy(zero_copy_only=False) for k in (1, 2)]))
            for block in batch.column(4).drop_null():
                own, high, low, _, _ = S.unpacked(block.as_py())
                digests.append((low.astype(np.uint64) << np.uint64(32)) | high.astype(np.uint64))
                owners.append(own)
        if digests:
            pairs.append(np.stack(_pairs(np.concatenate(digests), np.concatenate(owners))))
        if pairs:
            a, b = np.unique(np.concatenate(pairs, axis=1), axis=1)
            bucket = (T.mixed(a.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            a, b, bucket = a[order], b[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            blocks = [zstandard.compress(np.stack([a[x:y], b[x:y]]).tobytes(), 3) for x, y in zip(cuts, np.append(cuts[1:], len(bucket)))]
            yield S.block_rows(bucket[cuts].tolist(), blocks)

    def each_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = [np.frombuffer(zstandard.decompress(x.as_py()), np.int64).reshape(2, -1) for batch in batches for x in batch.column(4)]
        if pairs:
            a, b = np.unique(np.concatenate(pairs, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    stated = docs.mapInArrow(T.leaving_nothing(parts), S.ROW).repartitionById(buckets, "bucket")
    return stated.mapInArrow(T.leaving_nothing(chains), S.ROW).repartitionById(buckets, "bucket").mapInArrow(T.leaving_nothing(each_once), "a long, b long")


def _pairs(digests: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, smallest owner) of each digest that several owners have, each pair once."""
    order = np.lexsort((owners, digests))
    digests, owners = digests[order], owners[order]
    lead = np.searchsorted(digests, digests)
    a, b = owners, owners[lead]
    found = np.unique(np.stack([a[a != b], b[a != b]]), axis=1)
    return found[0], found[1]


def _stated(digests: np.ndarray, owners: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """What a task states: each digest (48 bits) with its smallest owner here, packed by bucket, and the other owners chained to that one."""
    if not len(digests):
        return
    a, b = _pairs(digests, owners)
    if len(a):
        yield S.span_rows(a, b, b, buckets)
    order = np.lexsort((owners, digests))
    digests, owners = digests[order], owners[order]
    first = np.ones(len(digests), dtype=bool)
    first[1:] = digests[1:] != digests[:-1]
    digest, owner = digests[first], owners[first]
    bucket = (digest % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((owner, bucket))
    digest, owner, bucket = digest[order] >> np.uint64(16), owner[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    high, low = (digest & np.uint64(0xFFFFFFFF)).astype(np.int64), (digest >> np.uint64(32)).astype(np.int64)
    blocks = [S.packed(owner[x:y], high[x:y], low[x:y], [b""] * (y - x)) for x, y in zip(cuts, np.append(cuts[1:], len(bucket)))]
    yield S.block_rows(bucket[cuts].tolist(), blocks)


def tree_join(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs (i, j) of left[i] and right[j] with 100 * common >= percent * union.

    The left sets, in one order of elements, are the paths of a trie that is walked depth first. ``overlap`` at a node counts
    for every right set the elements that it shares with the path so far; a child adds one row of the right sets' membership
    table. With r elements left on the longest path below, no right set can gain more than r.
    """
    if not left or not right:
        return []
    values, counts = np.unique(np.concatenate(left), return_counts=True)
    order = np.empty(len(values), np.int64)
    order[np.lexsort((values, -counts))] = np.arange(len(values))
    paths = sorted((np.sort(order[np.searchsorted(values, x)]).tolist(), i) for i, x in enumerate(left))
    width = int(np.clip(CELLS // len(values), 1, WIDTH))
    return [(i, first + j) for first in range(0, len(right), width) for i, j in _walked(paths, values, order, right[first : first + width], percent)]


def _walked(paths: list[tuple[list[int], int]], values: np.ndarray, order: np.ndarray, right: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """The links of the sets on ``paths`` with the right sets; ``order`` is the rank of each of ``values`` in the global order."""
    # Membership of the left sets' elements in the right sets, a row an element.
    member = np.zeros((len(values), len(right)), np.uint8)
    for j, x in enumerate(right):
        at = np.searchsorted(values, x)
        at[at == len(values)] = 0
        member[order[at[values[at] == x]], j] = 1
    sizes = np.array([len(x) for x in right], np.int64)
    found = []

    def bound(n: int) -> np.ndarray:
        """The least overlap that links a set of n elements with each right set."""
        return -(-percent * (n + sizes) // (100 + percent))

    # Neighbouring paths share their first elements: depth[k] of path k is how many it has in common with the one before.
    stack: list[np.ndarray] = [np.zeros(len(right), np.int32)]
    before: list[int] = []
    for path, i in paths:
        n = len(path)
        same = 0
        for x, y in zip(before, path):
            if x != y:
                break
            same += 1
        del stack[same + 1 :]
        need = bound(n)
        for depth in range(len(stack) - 1, n + 1):
            # Both what is left on the path and what is left of each right set limit the gain.
            if depth % 16 == 0 and not (stack[depth] + (n - depth) >= need).any():
                break
            if depth < n:
                stack.append(stack[depth] + member[path[depth]])
        else:
            found.extend((i, int(j)) for j in np.flatnonzero(stack[n] >= need))
        before = path[: len(stack) - 1]
    return found


def _packed_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's sets in one block, once for each pair of chunks that it is in."""
    key, rows = None, {}

    def placed() -> Iterator[pa.RecordBatch]:
        block, shelf, chunk, *partners = key
        own = shelf * _LEVEL + chunk
        ids, sets = zip(*rows)
        packed = S.packed(list(ids), [0] * len(ids), [0] * len(ids), list(sets))
        for step, n in zip((0, 1, -1), partners):
            for other in range((shelf + step) * _LEVEL, (shelf + step) * _LEVEL + n):
                places = (block, min(own, other), max(own, other), own)
                yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in places), pa.array([packed], pa.binary())], names=["block", "one", "two", "chunk", "sets"])

    for batch in batches:
        for *place, i, raw in zip(*(batch.column(k).to_pylist() for k in range(8))):
            if place != key:
                if rows:
                    yield from placed()
                key, rows = place, {}
            rows[i, raw] = None  # a repeated row is the same set
    if rows:
        yield from placed()


def _joined_chunks(percent: int):
    """Spanning links inside each pair of chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chunks = None, {}

        def members(chunk: int) -> list[tuple[int, np.ndarray]]:
            if chunk not in chunks:
                return []
            ids, _, _, lengths, raw = S.unpacked(chunks[chunk])
            return list(zip(ids.tolist(), np.split(np.frombuffer(raw, np.uint64), np.cumsum(lengths[:-1]) // 8)))

        def linked() -> Iterator[pa.RecordBatch]:
            one, two = key[1], key[2]
            left = members(one)
            right = members(two) if one != two else left
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while (up := parent.setdefault(x, x)) != x:
                    parent[x] = parent[up] if up in parent else up
                    x = up
                return x

            out = []
            for i, j in tree_join([s for _, s in left], [s for _, s in right], percent):
                a, b = left[i][0], right[j][0]
                if (x := root(a)) != (y := root(b)):
                    parent[max(x, y)] = min(x, y)
                    out.append((a, b))
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(k) for k in range(5)]
            for block, one, two, chunk, packed in zip(*columns):
                if (place := (block.as_py(), one.as_py(), two.as_py())) != key:
                    if chunks:
                        yield from linked()
                    key, chunks = place, {}
                chunks[chunk.as_py()] = packed.as_py()
        if chunks:
            yield from linked()

    return run


def _level(percent: int):
    """The size level of a set by which chunks are formed: linked sets are at most one level apart (the base is a little wider)."""
    return F.floor(F.log(F.greatest("n_shingles", F.lit(1)).cast("double")) / (1.0001 * np.log(100 / percent)).item()).alias("level")


def classes(df: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every text, see documents_of_classes."""
    return documents_of_classes(df, size, percent).select("doc_id", "n_shingles", "component_id")


def documents_of_classes(df: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, twin (see spans), n_shingles, component_id (smallest doc_id reachable by links, itself included) and leader of every text.

    A null or empty text, or one without words, has no shingles and links with nothing; equal sets are linked; repeated rows
    give repeated rows; null ids come before all others; an empty table gives an empty one; other columns are left behind.
    One document of each component is its leader: the smallest by doc_id, then twin. Ids come as they are inside, see
    texts.public_id.
    """
    docs = S.documents(df)
    found = T.checkpointed(noted(docs, size))
    slim = found.where("segment is null").drop("segment", "counts")
    firsts = T.checkpointed(
        slim.where("digest is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "twin")).alias("lead"), F.min("key").alias("key"), F.max("n_shingles").alias("n_shingles"))
    )
    chains = T.checkpointed(_candidate_chains(docs, size, percent, shingle_counts(found)))
    blocks = T.checkpointed(components(chains).select(F.col("node").alias("key"), F.col("component").alias("block")))
    # A node is a number of a distinct set, unique whatever its key; written, so that it stays.
    members = T.checkpointed(blocks.join(firsts, "key").select("digest", "lead", "block", F.col("n_shingles").alias("elements"), _level(percent), F.monotonically_increasing_id().alias("node")))
    chunks = F.ceil(F.greatest(F.count("*") / CHUNK, F.sum("elements") / ELEMENTS))
    small = members.groupBy("block").agg(chunks.alias("n")).select("block", (F.col("n") == 1).alias("small"))
    shelved = T.checkpointed(members.join(small, "block").withColumn("shelf", F.when(F.col("small"), F.lit(0)).otherwise(F.col("level") + 1)))
    sizes = T.checkpointed(shelved.groupBy("block", "shelf").agg(chunks.alias("n")))
    near = lambda step, name: sizes.select("block", (F.col("shelf") - step).alias("shelf"), F.col("n").alias(name))
    placed = shelved.join(near(0, "same"), ["block", "shelf"]).join(near(1, "above"), ["block", "shelf"], "left").join(near(-1, "below"), ["block", "shelf"], "left")
    placed = T.checkpointed(placed.select(
        F.col("lead.doc_id").alias("doc_id"), F.col("lead.twin").alias("twin"), F.col("digest").alias("own"), "node", "block", F.col("shelf").cast("long").alias("shelf"),
        F.pmod(F.xxhash64("node"), F.col("same")).alias("chunk"), "same", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("above", "below")),
    ))
    place = ("block", "shelf", "chunk", "same", "above", "below")
    sets = set_rows(docs.join(placed, ["doc_id", "twin"]), size, "own", "node", *place).where("digest = own")
    buckets = T.partitions(df.sparkSession)
    sets = sets.select(*place, "node", "set").repartition(buckets, "block", "shelf", "chunk").sortWithinPartitions(*place, "node")
    met = sets.mapInArrow(T.leaving_nothing(_packed_chunks), "block long, one long, two long, chunk long, sets binary")
    met = met.repartition(buckets, "block", "one", "two").sortWithinPartitions("block", "one", "two")
    links = T.checkpointed(met.mapInArrow(T.leaving_nothing(_joined_chunks(percent)), "a long, b long"))
    linked = T.checkpointed(components(links).join(members, "node").select("component", "digest", "lead"))
    best = linked.groupBy("component").agg(F.min("lead").alias("best"))
    named = T.checkpointed(firsts.join(linked.join(best, "component").select("digest", "best"), "digest", "left").select("digest", F.coalesce("best", "lead").alias("lead")))
    own = (F.col("lead.doc_id") == F.col("doc_id")) & (F.col("lead.twin") == F.col("twin"))
    return slim.join(named, "digest", "left").select("doc_id", "twin", "n_shingles", F.coalesce("lead.doc_id", "doc_id").alias("component_id"), F.coalesce(own, F.lit(True)).alias("leader"))
