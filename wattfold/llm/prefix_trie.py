"""Conversation prefix trie: how many conversations share each prefix, and what storing shared turns once would save.

Conversations are rebuilt first (see ``rebuilt``), then every distinct sequence of their first turns is a node of one trie:

1. Turns are put in order by ranges of (conversation, turn), so that a conversation with very many turns is many tasks; what a
   range needs to know of the ones before it are two numbers a range.
2. A conversation is cut into pieces of ``PIECE`` turns. A piece hangs under its anchor, a digest of all turns before it, so
   no row grows with a conversation. Pieces are sorted by anchor and path into shards.
3. A shard is a forest in balanced parentheses: pieces are walked in order, an opening parenthesis for each new node. Over
   the excess stands a tree of block minima (``Parentheses``): findclose gives the end of each subtree. Ranks of pairs ``()``
   count leaves; cumulative arrays over nodes and members give savings and members; range minima the smallest member.
4. Only nodes on the path of a shard's first or last piece can go on in another shard. These spines are merged: counts are
   summed by node, and what hangs on them is summed over the merged skeleton.
5. Where conversations with a common prefix go on below a piece's last turn, what their subtrees hold is carried up, piece
   level by piece level; a subtree with one member has one leaf and saves nothing, so nothing is carried for it.

Nodes and turns are told apart by 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattfold.llm import texts as T

#: Conversations borrow their first turns, fewer than HEADS, from the first conversation of their STRIDE.
STRIDE, HEADS = 100, 6
#: Turns of a piece; pieces of a shard.
PIECE, SHARD = 32, 20_000
#: Bits of a block of the parentheses' minima.
BLOCK = 128
_ROOT = bytes(16)
_NODE = (
    "kind int, key binary, parent_key binary, anchor binary, path binary, next binary, block long, level int, depth long, chars long, "
    "n_convs long, conv_id long, parent_conv_id long, n_children long, n_leaves long, saved_tokens long, ends string"
)
_FIELDS = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[t]) for n, t in (x.split() for x in _NODE.split(", "))])
CLOSED, SPINE, ENDS = 0, 1, 2


class Parentheses:
    """Balanced parentheses (1 opens, -1 closes) with the least excess of blocks, of pairs of blocks, and so on."""

    def __init__(self, bits: np.ndarray):
        self.excess = np.cumsum(bits)
        top = int(self.excess.max(initial=0)) + 1
        blocks = -(-len(bits) // BLOCK)
        padded = np.full(blocks * BLOCK, top)
        padded[: len(bits)] = self.excess
        self.padded = padded
        self.least = [padded.reshape(blocks, BLOCK).min(1)]
        while len(self.least[-1]) > 1:
            below = self.least[-1]
            self.least.append(np.append(below, np.full(len(below) % 2, top)).reshape(-1, 2).min(1))

    def _within(self, at: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first position from ``at`` to the end of its block whose excess is at most the target, or -1."""
        found = np.full(len(at), -1)
        left = np.arange(len(at))
        while len(left):
            here = at[left]
            hit = self.padded[here] <= target[left]
            found[left[hit]] = here[hit]
            left = left[~hit & ((here + 1) % BLOCK != 0)]
            at[left] += 1
        return found

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one."""
        target = self.excess[opens] - 1
        close = self._within(opens.copy(), target)
        far = np.flatnonzero(close < 0)
        if not len(far):
            return close
        # The next block that reaches the target: up the tree of minima, then down again.
        index, goal = opens[far] // BLOCK + 1, target[far]
        level = np.full(len(far), -1)
        for k, least in enumerate(self.least):
            seek = (level < 0) & ((index % 2 == 1) | (len(least) == 1)) & (index < len(least))
            hit = seek.copy()
            hit[seek] = least[index[seek]] <= goal[seek]
            level[hit] = k
            up = level < 0
            index[up] = (index[up] + 1) // 2
        for k in range(len(self.least) - 1, 0, -1):
            down = level == k
            child = 2 * index[down]
            index[down] = child + (self.least[k - 1][child] > goal[down])
            level[down] = k - 1
        close[far] = self._within(index * BLOCK, goal)
        return close


def _range_minimum(values: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The least of values[first:stop] of each range, none of them empty."""
    tables, width = [values], 1
    while 2 * width <= len(values):
        tables.append(np.minimum(tables[-1][:-width], tables[-1][width:]))
        width *= 2
    out = np.empty(len(first), np.int64)
    size = np.floor(np.log2(stop - first)).astype(int)
    for k, table in enumerate(tables):
        own = size == k
        out[own] = np.minimum(table[first[own]], table[stop[own] - 2**k])
    return out


def _parents(level: np.ndarray) -> np.ndarray:
    """The node above each node of a preorder, -1 for roots: the last one before it that stands one level higher."""
    parent = np.full(len(level), -1)
    for k in range(1, int(level.max(initial=0)) + 1):
        own, above = np.flatnonzero(level == k), np.flatnonzero(level == k - 1)
        parent[own] = above[np.searchsorted(above, own) - 1]
    return parent


def shard_nodes(anchors: list[bytes], blocks: np.ndarray, paths: list[bytes], chars: list[np.ndarray], convs: np.ndarray, ends: np.ndarray, passed: list[bytes | None], size_of_piece: int = PIECE) -> pa.RecordBatch:
    """Nodes of a shard's pieces, which are sorted by anchor, path and conversation: see _NODE."""
    m = len(paths)
    length = np.array([len(x) // 16 for x in paths])
    width = max(1, int(length.max()))
    turns, sizes = np.zeros((m, width, 2), np.uint64), np.zeros((m, width), np.int64)
    for i, (path, own) in enumerate(zip(paths, chars)):
        turns[i, : length[i]] = np.frombuffer(path, np.uint64).reshape(-1, 2)
        sizes[i, : length[i]] = own
    same = (turns[1:] == turns[:-1]).all(2) & (np.arange(width) < np.minimum(length[1:], length[:-1])[:, None])
    common = np.zeros(m, np.int64)  # nodes in common with the piece before, the root included
    common[1:] = (1 + np.cumprod(same, axis=1).sum(1)) * np.array([a == b for a, b in zip(anchors[1:], anchors)], bool)
    opened = length + 1 - common
    counts = np.zeros(2 * m + 1, np.int64)
    counts[1::2] = opened
    counts[2:-1:2] = (length + 1)[:-1] - common[1:]
    counts[-1] = length[-1] + 1
    bits = np.repeat(np.where(np.arange(2 * m + 1) % 2, 1, -1), counts)
    after = np.cumsum(counts)[1::2]  # where the walk stands when a piece has been opened
    at = np.flatnonzero(bits == 1)
    piece = np.repeat(np.arange(m), opened)
    level = np.arange(len(piece)) - np.repeat(np.cumsum(opened) - opened, opened) + common[piece]
    close = Parentheses(bits).findclose(at)
    until = np.cumsum(bits == 1)[close]  # the node after the subtree, in preorder
    stop = np.searchsorted(after, close, side="right")  # the piece after the subtree
    members = stop - piece
    conv = _range_minimum(convs, piece, stop)
    pairs = np.concatenate([[0], np.cumsum((bits[:-1] == 1) & (bits[1:] == -1))])
    leaves = pairs[close] - pairs[at]
    size = np.where(level > 0, sizes[piece, np.maximum(level - 1, 0)], 0)
    saved = np.concatenate([[0], np.cumsum((members - 1) * size)])
    saved = saved[until] - saved[:-1]
    parent = _parents(level)
    children = np.bincount(parent[parent >= 0], minlength=len(piece))
    spine = (piece == 0) | (stop == m)
    # On a spine only what hangs on it, whole, is stated; the skeleton adds up the rest.
    hanging = np.flatnonzero(~spine & (parent >= 0) & spine[parent])
    for total, values in ((children, np.ones(len(piece), np.int64)), (leaves, leaves.copy()), (saved, saved.copy())):
        total[spine] = 0
        np.add.at(total, parent[hanging], values[hanging])
    keys = [hashlib.md5(anchors[i] + paths[i][: 16 * k]).digest() for i, k in zip(piece.tolist(), level.tolist())]
    last = np.cumsum(opened) - 1  # the node at which a piece ends
    done: dict[int, list[int]] = {}
    for node, c in zip(last[ends].tolist(), convs[ends].tolist()):
        done.setdefault(node, []).append(c)
    out: list[tuple] = []
    rows = zip(*(x.tolist() for x in (piece, level, parent, size, members, conv, children, leaves, saved, spine)))
    for k, (i, lev, up, n_chars, n, least, n_children, n_leaves, n_saved, on_spine) in enumerate(rows):
        depth, ended = int(blocks[i]) * size_of_piece + lev, done.get(k)
        known = up >= 0 and not spine[up]
        far = lev == size_of_piece
        out.append((
            SPINE if on_spine else CLOSED, keys[k], keys[up] if up >= 0 else None, anchors[i], paths[i][: 16 * lev] if on_spine or far else None, passed[i] if far else None,
            int(blocks[i]), lev, depth, n_chars, n, least, int(conv[up]) if known else None, n_children, n_leaves, n_saved,
            None if on_spine else hashlib.sha256(",".join(map(str, ended or ())).encode()).hexdigest(),
        ))
        if on_spine and ended:
            out.append((ENDS, keys[k], *[None] * 9, ended[0], *[None] * 4, ",".join(map(str, ended))))
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), _FIELDS)], schema=_FIELDS)


def _shards(piece: int, shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def made() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            held.clear()
            get = lambda name: table.column(name).to_pylist()
            paths, blocks = get("path"), np.array(get("block"))
            ends = blocks * piece + np.array([len(x) // 16 for x in paths]) == np.array(get("length"))
            return shard_nodes(get("anchor"), blocks, paths, [np.array(x, np.int64) for x in get("chars")], np.array(get("conv_id")), ends, get("next"), piece)

        for batch in batches:
            while batch.num_rows:
                room = shard - sum(x.num_rows for x in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(x.num_rows for x in held) == shard:
                    yield made()
        if held:
            yield made()

    return run


def numbered_turns(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 1, in the order of turn, role and a digest of the content), content (16 bytes) and chars of every turn.

    Null roles and texts are empty; rows with a null conv_id belong to no conversation and are left out.
    """
    spark = rows.sparkSession
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("content"), F.char_length(text).cast("long").alias("chars"),
    )
    order = ("conv_id", "turn", "role", "content")
    dealt = slim.repartitionByRange(T.partitions(spark), *order).sortWithinPartitions(*order)
    dealt = T.checkpointed(dealt.select("conv_id", "content", "chars", F.spark_partition_id().alias("part")))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = first = last = None
        n_first = n_last = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            if first is None:
                part, first = batch.column(3)[0].as_py(), int(ids[0])
            n_first += int((ids == first).sum())
            n_last = int((ids == ids[-1]).sum()) + (n_last if ids[-1] == last else 0)
            last = int(ids[-1])
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (part, first, n_first, last, n_last)], names=["part", "first", "n_first", "last", "n_last"])

    before, open_conv, held = {}, None, 0
    for r in sorted(dealt.mapInArrow(edges, "part long, first long, n_first long, last long, n_last long").collect()):  # a row a range
        before[r["part"]] = carried = held if open_conv == r["first"] else 0
        held = r["n_last"] + (carried if r["first"] == r["last"] else 0)
        open_conv = r["last"]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            if now is None:
                now, n = int(ids[0]), before[batch.column(3)[0].as_py()]
            new = np.ones(len(ids), bool)
            new[1:] = ids[1:] != ids[:-1]
            begin = np.flatnonzero(new)
            place = np.arange(len(ids)) - np.repeat(begin, np.diff(np.append(begin, len(ids)))) + 1
            if ids[0] == now:
                place[ids == now] += n
            now, n = int(ids[-1]), int(place[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(place, pa.int64()), batch.column(1), batch.column(2)], names=["conv_id", "place", "content", "chars"])

    return dealt.mapInArrow(placed, "conv_id long, place long, content binary, chars long")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, length, depth, content and chars of every rebuilt turn; a conversation rebuilt to nothing has one row of depth null.

    A conversation c takes the first h turns of conversation c - c % STRIDE (all if fewer, none if absent; % rounds to zero),
    h = crc32 of c's decimals modulo HEADS, then its own after the first h.
    """
    turns = T.checkpointed(turns)
    borrowed = F.crc32(F.col("conv_id").cast("string")) % HEADS
    known = T.checkpointed(turns.groupBy("conv_id").agg(F.max("place").alias("n")))
    first = (F.col("conv_id") - F.col("conv_id") % STRIDE).alias("first")
    sizes = known.select("conv_id", "n", borrowed.alias("h"), first).join(known.where(F.col("conv_id") % STRIDE == 0).select(F.col("conv_id").alias("first"), F.col("n").alias("n_first")), "first", "left")
    sizes = sizes.withColumn("k", F.least("h", F.coalesce("n_first", F.lit(0)))).withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    sizes = T.checkpointed(sizes.select("conv_id", "first", "h", "k", "length"))
    own = turns.join(sizes, "conv_id").where("place > h").select("conv_id", "length", (F.col("place") - F.col("h") + F.col("k")).alias("depth"), "content", "chars")
    heads = turns.where((F.col("conv_id") % STRIDE == 0) & (F.col("place") < HEADS)).select(F.col("conv_id").alias("first"), "place", "content", "chars")
    taken = sizes.join(heads, "first").where("place <= h").select("conv_id", "length", F.col("place").alias("depth"), "content", "chars")
    nothing = sizes.where("length = 0").select("conv_id", "length", F.lit(None).cast("long").alias("depth"), F.lit(None).cast("binary").alias("content"), F.lit(0).cast("long").alias("chars"))
    return own.union(taken).union(nothing)


def _pieces(size: int):
    """conv_id, block, length, path, chars, and what a full piece adds to its conversation's digest; rows come sorted by depth."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, path, chars, out = None, [], [], []

        def made() -> tuple:
            conv, block, length = key
            own = 0
            if len(path) == size:
                for k, content in enumerate(path, block * size + 1):
                    own ^= int.from_bytes(hashlib.blake2b(k.to_bytes(8, "little") + content, digest_size=16, key=b"prefix").digest(), "little")
            high, low = np.frombuffer(own.to_bytes(16, "little"), np.int64).tolist()
            return conv, block, length, b"".join(path), chars, high, low

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64())
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["conv_id", "block", "length", "path", "chars", "high", "low"])

        for batch in batches:
            for conv, block, length, content, n in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if (conv, block, length) != key:
                    if key is not None:
                        out.append(made())
                    key, path, chars = (conv, block, length), [], []
                if content is not None:
                    path.append(content)
                    chars.append(n)
            if len(out) > 10_000:
                yield flushed()
        if key is not None:
            out.append(made())
        if out:
            yield flushed()

    return run


def pieces(turns: DataFrame, size: int = PIECE) -> DataFrame:
    """conv_id, block, length, path, chars, anchor (of the turns before) and next (of the turns up to the end of a full piece)."""
    block = F.floor((F.coalesce("depth", F.lit(1)) - 1) / size).alias("block")
    dealt = turns.select("conv_id", block, "length", "content", "chars", "depth").repartition(T.partitions(turns.sparkSession), "conv_id", "block").sortWithinPartitions("conv_id", "block", "depth")
    made = T.checkpointed(dealt.mapInArrow(_pieces(size), "conv_id long, block long, length long, path binary, chars array<long>, high long, low long"))
    # A conversation's digest up to each of its pieces: a running exclusive or, over one row a piece of the longer ones.
    whole = made.where(F.col("length") <= size).select("*", F.col("high").alias("h"), F.col("low").alias("l"))
    longer = made.where(F.col("length") > size).selectExpr("*", *(f"bit_xor({x}) over (partition by conv_id order by block) as {y}" for x, y in (("high", "h"), ("low", "l"))))
    both = whole.union(longer)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low, h, l = (batch.column(batch.schema.get_field_index(x)).to_numpy(zero_copy_only=False) for x in ("high", "low", "h", "l"))
            after = [x.tobytes() for x in np.stack([h, l], 1)]
            before = [x.tobytes() for x in np.stack([h ^ high, l ^ low], 1)]
            block = batch.column(1).to_pylist()
            anchor = [x if b else _ROOT for x, b in zip(before, block)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(5)), pa.array(anchor, pa.binary()), pa.array(after, pa.binary())], names=["conv_id", "block", "length", "path", "chars", "anchor", "next"])

    return both.mapInArrow(digests, "conv_id long, block long, length long, path binary, chars array<long>, anchor binary, next binary")


def _hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key and digest of the ids that end there; blocks of ids come sorted, and only the digest's state is held."""
    key, state = None, None
    for batch in batches:
        found = []
        for own, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if own != key:
                if key is not None:
                    found.append((key, state.hexdigest()))
                key, state = own, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*found)], names=["key", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends"])


def _above(nodes: DataFrame, *sums: str) -> DataFrame:
    """key and sums over all nodes of the piece tree at and below it; nodes have anchor, level and path."""
    each = nodes.select(F.explode(F.sequence(F.lit(0), F.col("level"))).alias("a"), "anchor", "path", *sums)
    key = F.unhex(F.md5(F.concat("anchor", F.substring("path", F.lit(1), F.col("a") * 16))))
    return each.groupBy(key.alias("key")).agg(*(F.sum(s).alias(s) for s in sums))


def _skeleton(rows: DataFrame) -> DataFrame:
    """The merged spines: one row a node, with whole counts, and the columns of closed nodes."""
    same = ("key", "parent_key", "anchor", "path", "next", "block", "level", "depth", "chars")
    merged = rows.where(F.col("kind") == SPINE).groupBy(*same).agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")))
    merged = T.checkpointed(merged)
    below = merged.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    merged = merged.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    parts = merged.withColumn("n_leaves", F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars"))
    totals = _above(parts, "n_leaves", "saved_tokens")
    spark = rows.sparkSession
    ends = rows.where(F.col("kind") == ENDS).select("key", "conv_id", "ends").repartition(T.partitions(spark), "key").sortWithinPartitions("key", "conv_id").mapInArrow(_hashed_ends, "key binary, ends string")
    none = hashlib.sha256(b"").hexdigest()
    return merged.drop("n_leaves", "saved_tokens", "more").join(totals, "key").join(ends, "key", "left").withColumn("ends", F.coalesce("ends", F.lit(none)))


def _carried(nodes: DataFrame, size: int) -> DataFrame:
    """Nodes with what lies below the last turn of their pieces; a root of a lower piece is the last node of the piece above."""
    roots = T.checkpointed(nodes.where("level = 0 and block > 0").select("key", "anchor", "block", "n_convs", "n_children", "n_leaves", "saved_tokens"))
    last = nodes.where(F.col("level") == size)
    shared = T.checkpointed(last.where("n_convs > 1").select("anchor", "path", "level", "block", F.col("next").alias("own")))
    top = roots.where("n_convs > 1").agg(F.max("block")).first()[0] or 0
    deltas: list[DataFrame] = []
    for b in range(top, 0, -1):
        now = roots.where((F.col("block") == b) & (F.col("n_convs") > 1)).select("key", F.col("anchor").alias("own"), (F.col("n_leaves") - 1).alias("n_leaves"), "saved_tokens")
        if deltas:
            lower = deltas[-1].select("key", F.col("n_leaves").alias("dl"), F.col("saved_tokens").alias("ds"))
            now = now.join(lower, "key", "left").withColumn("n_leaves", F.col("n_leaves") + F.coalesce("dl", F.lit(0))).withColumn("saved_tokens", F.col("saved_tokens") + F.coalesce("ds", F.lit(0)))
        held = shared.where(F.col("block") == b - 1).join(now.select("own", "n_leaves", "saved_tokens"), "own")
        deltas.append(T.checkpointed(_above(held, "n_leaves", "saved_tokens")))
    if deltas:
        more = deltas[0]
        for d in deltas[1:]:
            more = more.union(d)
        more = more.select("key", F.col("n_leaves").alias("dl"), F.col("saved_tokens").alias("ds"))
        nodes = nodes.join(more, "key", "left").withColumn("n_leaves", F.col("n_leaves") + F.coalesce("dl", F.lit(0))).withColumn("saved_tokens", F.col("saved_tokens") + F.coalesce("ds", F.lit(0))).drop("dl", "ds")
    children = roots.select(F.col("anchor").alias("next"), F.col("n_children").alias("more"))
    above = last.select(F.col("next").alias("anchor"), F.col("conv_id").alias("up"), F.lit(1).alias("level"))
    nodes = nodes.where("level > 0 or block = 0").join(children, "next", "left").withColumn("n_children", F.coalesce("more", "n_children"))
    return nodes.join(above, ["anchor", "level"], "left").withColumn("parent_conv_id", F.coalesce("up", "parent_conv_id"))


def trie(rows: DataFrame, piece: int = PIECE, shard: int = SHARD) -> DataFrame:
    """Every node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows have conv_id, turn, role and text. Turns are ordered by turn (null first), then role, then a digest of the content;
    repeated rows are turns of their own; null roles and texts are empty; rows with a null conv_id are left out; other
    columns are left behind; without a conversation there is no node, not even a root. ``piece`` and ``shard`` are the turns of a
    piece and the pieces of a shard.
    """
    spark = rows.sparkSession
    made = pieces(rebuilt(numbered_turns(rows)), piece)
    order = ("anchor", "path", "conv_id")
    dealt = made.repartitionByRange(T.partitions(spark), *order).sortWithinPartitions(*order)
    found = T.checkpointed(dealt.mapInArrow(_shards(piece, shard), _NODE))
    skeleton = T.checkpointed(_skeleton(found))
    columns = ("key", "parent_key", "anchor", "path", "next", "block", "level", "depth", "n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens", "ends")
    nodes = found.where(F.col("kind") == CLOSED).select(*columns, "parent_conv_id").union(skeleton.select(*columns, F.lit(None).cast("long")))
    nodes = nodes.join(skeleton.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up")), "parent_key", "left")
    nodes = nodes.withColumn("parent_conv_id", F.coalesce("up", "parent_conv_id")).drop("up")
    if found.where("block > 0").take(1):
        nodes = _carried(T.checkpointed(nodes), piece)
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"))
