"""Suffix-array dedup: repeated byte strings from merged Burrows-Wheeler transforms.

Repeats of ``LENGTH`` bytes are found bucket by bucket. Each window of that many bytes has a minimiser, its smallest hash of
``SEED`` bytes; consecutive windows that share it travel as one fragment to the bucket of that hash, so equal windows always
meet. A fragment that equals another is settled at once, in the task that cuts it or in the bucket.

In a bucket, the distinct fragments whose minimiser occurs more than once, with like bytes around it, are dealt into shards.
Each shard gets its own suffix order and transform. The shards' transforms are then merged without sorting their suffixes
again: the merged order is kept only as the sequence of shard numbers, and one refinement step reads every shard's transform in
that sequence and deals the shard numbers out stably by the symbol read. After k steps the order is right for the first k
symbols, and positions that are still undivided share a prefix of k symbols: these intervals are the repeats. The transform's
symbols are 8 bytes wide, one chain of suffixes for each of the 8 phases, so 12 steps reach 96 bytes and a last half step the
hundred.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wattfold.llm import spans as S, texts as T

LENGTH, SEED, SYMBOL = 100, 20, 8
#: Bytes of text cut at a time, bytes that a task gathers before it sends blocks, bytes of a shard, and bytes merged at a time
#: (more only where one minimiser has more).
CUT_BYTES, SEND_BYTES, SHARD_BYTES, MERGE_BYTES = 1_000_000, 8_000_000, 60_000, 400_000
#: Windows whose distance to their minimiser differs by at most this are told apart by what they have in common.
REACH = 20
#: How hard blocks are compressed: disk is nearer to its limit than time.
LEVEL = 7
_BYTES = T.Roller(31)


def fragments(texts: T.Utf8) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first byte, last byte (in the text) and mark of each run of windows that share a minimiser.

    The mark is the minimiser's hash in 44 bits, and above it a bit for runs in which the minimiser may stand more than once,
    whose windows may therefore repeat inside the run itself.
    """
    n = np.diff(texts.bounds)
    first, doc = T.windows_within(n, LENGTH)
    if not len(first):
        return doc, first, first, np.zeros(0, np.uint64)
    width, low = LENGTH - SEED + 1, np.uint64(2**20 - 1)
    seeds = _BYTES.windows(_BYTES.sums(_BYTES.letters[texts.data]), SEED) & ~low
    place = np.arange(len(seeds), dtype=np.uint64) & low
    left = T.sliding_minimum(seeds | place, width)[first]
    right = T.sliding_minimum(seeds | (low - place), width)[first]
    twice = (left & low) != low - (right & low)
    least = left >> np.uint64(20)
    new = np.ones(len(first), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (least[1:] != least[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(first)) - 1
    several = np.logical_or.reduceat(twice, begin) | (end - begin >= width)
    start = texts.bounds[doc[begin]]
    return doc[begin], first[begin] - start, first[end] + LENGTH - start, least[begin] | (several.astype(np.uint64) << np.uint64(44))


class _Distinct:
    """Fragments told apart by their bytes: the first place of each distinct one, and the places of its later copies."""

    def __init__(self):
        self.number: dict[bytes, int] = {}  # of the first fragment with these bytes
        self.equal, self.places, self.n = [], [], 0

    def add(self, parts: list[bytes], ids: np.ndarray, twins: np.ndarray, first: np.ndarray, marks: np.ndarray) -> None:
        after = self.n + len(parts)
        self.equal.append(np.fromiter(map(self.number.setdefault, parts, range(self.n, after)), np.int64, len(parts)))
        self.places.append((ids, twins, first, marks))
        self.n = after

    def settled(self) -> tuple[list[bytes], list[np.ndarray], list[np.ndarray]]:
        """The distinct fragments, their ids, twins, places and marks, and the ids, twins and spans of later copies."""
        if not self.n:
            return [], [np.zeros(0, np.int64)] * 4, [np.zeros(0, np.int64)] * 4
        equal = np.concatenate(self.equal)
        ids, twins, first, marks = map(np.concatenate, zip(*self.places))
        parts, lead = list(self.number), np.fromiter(self.number.values(), np.int64, len(self.number))
        some = np.flatnonzero(np.bincount(equal)[equal] > 1)
        some = some[np.lexsort((first[some], twins[some], ids[some], equal[some]))]
        new = np.ones(len(some), bool)
        new[1:] = equal[some[1:]] != equal[some[:-1]]
        before = some[new][np.cumsum(new) - 1]
        group = np.searchsorted(lead, equal[some])
        lead[group[new]] = some[new]
        later = (ids[some] != ids[before]) | (twins[some] != twins[before]) | (first[some] != first[before])
        copy, size = some[later], np.fromiter(map(len, map(parts.__getitem__, group[later].tolist())), np.int64)
        return parts, [x[lead] for x in (ids, twins, first, marks)], [ids[copy], twins[copy], first[copy], first[copy] + size]


class _Sent:
    """What a task has gathered and not yet sent."""

    def __init__(self, buckets: int):
        self.buckets, self.held, self.size = buckets, _Distinct(), 0

    def add(self, ids: np.ndarray, twins: np.ndarray, texts: T.Utf8) -> None:
        doc, first, last, least = fragments(texts)
        raw, at = texts.raw, texts.bounds[doc]
        parts = [raw[a:b] for a, b in zip((at + first).tolist(), (at + last).tolist())]
        self.held.add(parts, ids[doc], twins[doc], first, least)
        self.size += len(raw)

    def rows(self) -> Iterator[pa.RecordBatch]:
        parts, (ids, twins, first, least), copies = self.held.settled()
        self.held, self.size = _Distinct(), 0
        if len(copies[0]):
            yield S.document_rows(*copies, self.buckets)
        if not parts:
            return
        bucket = (least & np.uint64((1 << 44) - 1)) % np.uint64(self.buckets)
        marks = least & np.uint64(0x7FFFFFFF) | least >> np.uint64(44) << np.uint64(31)
        order = np.argsort(bucket, kind="stable")
        parts = list(map(parts.__getitem__, order.tolist()))
        own, begin = np.unique(bucket[order], return_index=True)
        cuts = zip(begin.tolist(), [*begin[1:].tolist(), len(parts)])
        columns = [x[order] for x in (ids, first, marks, twins)]
        blocks = [S.packed(*(x[a:b] for x in columns[:3]), parts[a:b], columns[3][a:b], LEVEL) for a, b in cuts]
        yield S.block_rows(own.tolist(), blocks)


def _first_step(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = _Sent(buckets)
        for batch in T.chunks(batches, limit=CUT_BYTES):
            sent.add(batch.column(0).to_numpy(), batch.column(2).to_numpy(), T.Utf8(batch.column(1)))
            if sent.size > SEND_BYTES:
                yield from sent.rows()
        yield from sent.rows()

    return run


def _surroundings(parts: list[bytes], marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each fragment: whether its minimiser is found at exactly one place, and for each distance of a window's begin to it,
    in steps of REACH, whether such windows fit in, and the hash of what all those windows have in common."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    shifts = range(0, LENGTH - SEED, REACH)
    once, fits, keys = np.zeros(len(parts), bool), np.zeros((len(shifts), len(parts)), bool), np.zeros((len(shifts), len(parts)), np.uint64)
    piece = np.cumsum(lengths) // CUT_BYTES
    for x, y in zip(*(np.searchsorted(piece, np.unique(piece), side=side).tolist() for side in ("left", "right"))):
        bounds = np.concatenate([[0], np.cumsum(lengths[x:y])])
        sums = _BYTES.sums(_BYTES.letters[np.frombuffer(b"".join(parts[x:y]), np.uint8)])
        seeds = (_BYTES.windows(sums, SEED) >> np.uint64(20) & np.uint64(0x7FFFFFFF)).astype(np.int64)
        hit = np.flatnonzero(seeds == np.repeat(marks[x:y], lengths[x:y])[: len(seeds)])
        own = np.searchsorted(bounds, hit, side="right") - 1
        inside = hit + SEED <= bounds[own + 1]
        hit, own = hit[inside], own[inside]
        once[x:y] = np.bincount(own, minlength=y - x) == 1
        place = np.zeros(y - x, np.int64)
        place[own] = hit
        for k, shift in enumerate(shifts):
            a, b = place - shift, place + LENGTH - shift - REACH
            fits[k, x:y] = (a >= bounds[:-1]) & (b <= bounds[1:])
            some = np.flatnonzero(fits[k, x:y])
            keys[k, x + some] = _BYTES.stretch(sums, a[some], b[some])
    return once, fits, keys


def may_repeat(parts: list[bytes], marks: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Which of these distinct fragments may hold a window of another one, or one window twice.

    Equal windows have their minimiser at the same place, so fragments that share one also share the bytes around the
    minimiser that all windows of about that place have in common. Equal hashes of these bytes only choose what goes on to
    the transforms. Where a minimiser may stand more than once in a fragment, everything of that mark goes on.
    """
    once, fits, keys = _surroundings(parts, marks)
    out = np.isin(marks, marks[~(once & alone)])
    for k in range(len(keys)):
        some = np.flatnonzero(fits[k])
        _, at, n = np.unique(keys[k, some], return_inverse=True, return_counts=True)
        out[some[n[at.ravel()] > 1]] = True
    return out


def _shard_order(symbols: np.ndarray, following: np.ndarray, ends: int) -> np.ndarray:
    """The suffix order of one shard, by doubling. Suffixes n and above are the chains' ends, in their own order, before all.

    A suffix's rank is the place of the first one equal so far; each round sorts only what shares its rank.
    """
    n = len(symbols)
    size = n + ends
    bits = np.uint64(size.bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    jump = np.concatenate([following, np.arange(n, size)])
    order = np.concatenate([np.arange(n, size), np.argsort(symbols)])
    own = symbols[order[ends:]]
    new = np.ones(size, bool)
    new[ends + 1 :] = own[1:] != own[:-1]
    rank, tied = np.empty(size, np.int64), np.arange(size)
    while True:
        rank[order[tied]] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        tied = tied[~(new & np.append(new[1:], True))]
        if not len(tied):
            return order
        x = order[tied]
        if 3 * int(bits) <= 64:
            key = (rank[x].astype(np.uint64) << bits | rank[jump[x]].astype(np.uint64)) << bits | x.astype(np.uint64)
            key.sort()
            order[tied] = key & low
            key >>= bits
        else:
            key = rank[x] * size + rank[jump[x]]
            by = np.argsort(key)
            order[tied], key = x[by], key[by]
        new = np.ones(len(tied), bool)
        new[1:] = key[1:] != key[:-1]
        jump = jump[jump]


class Shard:
    """The transform of some fragments: in suffix order, each suffix's place (-1: an end) and the symbol before it."""

    def __init__(self, raw: bytes, lengths: np.ndarray):
        data = np.frombuffer(raw + bytes(SYMBOL), np.uint8)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        wide = np.zeros(len(raw), np.uint64)
        for i in range(SYMBOL):
            wide = (wide << np.uint64(8)) | data[i : len(raw) + i]
        own = np.repeat(np.arange(len(lengths)), lengths)
        at = np.arange(len(raw))
        real = at + SYMBOL <= bounds[own + 1]
        index = np.cumsum(real) - 1
        n = int(real.sum())
        self.chains = SYMBOL * len(lengths)
        place = at[real]
        fragment, phase = own[real], (place - bounds[own[real]]) % SYMBOL
        inside = place + 2 * SYMBOL <= bounds[fragment + 1]
        following = n + fragment * SYMBOL + phase
        following[inside] = index[place[inside] + SYMBOL]
        symbols = wide[real]
        order = _shard_order(symbols, following, self.chains)
        before = np.full(n + self.chains, -1, np.int64)
        before[following] = np.arange(n)
        self.place = np.where(order < n, place[np.minimum(order, n - 1)], -1)
        previous = before[order]
        self.started = previous < 0
        self.symbol = symbols[np.maximum(previous, 0)]


def merge(shards: list[Shard], steps: int) -> tuple[np.ndarray, np.ndarray]:
    """The merged order of all shards' suffixes, right to ``steps`` symbols: for each position its suffix (numbered through the
    shards' own orders in a row) and its group of suffixes with those symbols in common."""
    narrow = np.min_scalar_type(len(shards))
    number = np.repeat(np.arange(len(shards), dtype=narrow), [len(x.place) for x in shards])
    started = np.concatenate([x.started for x in shards])
    _, symbol = np.unique(np.concatenate([x.symbol for x in shards]), return_inverse=True)
    symbol = symbol.ravel().astype(np.uint64) << np.uint64(32)
    symbol[started] = np.uint64(0xFFFFFFFF << 32)  # nothing before it: dealt out last, and left out
    ends = np.repeat(np.arange(len(shards), dtype=narrow), [x.chains for x in shards])
    position, rest = np.arange(len(number), dtype=np.uint64), len(number) - len(ends)
    sequence, group = number, np.zeros(len(number), np.int64)
    for _ in range(steps):
        read = np.argsort(sequence, kind="stable")  # positions of each shard's suffixes, shard by shard
        dealt = np.empty(len(number), np.uint64)
        dealt[read] = symbol
        dealt |= position
        dealt.sort()
        dealt = dealt[:rest]
        source = (dealt & np.uint64(0xFFFFFFFF)).astype(np.int64)
        dealt >>= np.uint64(32)
        before = group[source]
        new = np.ones(rest, bool)
        new[1:] = (dealt[1:] != dealt[:-1]) | (before[1:] != before[:-1])
        # The chains' ends stand first, each in a group of its own.
        sequence = np.concatenate([ends, sequence[source]])
        group = np.concatenate([np.arange(len(ends)), len(ends) - 1 + np.cumsum(new)])
    order = np.empty(len(number), np.int64)
    order[np.argsort(sequence, kind="stable")] = np.arange(len(number))
    return order, group


def repeats(parts: list[bytes], ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the fragments covered by LENGTH-byte strings that also start at a smaller (id, place) among the fragments."""
    # In the order of their places, so that the first window of several is the one that comes first here.
    by = np.lexsort((starts, ids))
    parts, ids, starts = [parts[k] for k in by.tolist()], ids[by], starts[by]
    lengths = np.array([len(x) for x in parts])
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    raw = b"".join(parts)
    each = max(SHARD_BYTES, len(raw) // 50_000)
    cuts = np.unique(np.searchsorted(bounds, np.arange(0, len(raw), each), side="left"))
    cuts = cuts[cuts < len(parts)]  # a multiple inside the last part begins no shard
    shards = [Shard(raw[bounds[a] : bounds[b]], lengths[a:b]) for a, b in zip(cuts, np.append(cuts[1:], len(parts)))]
    steps = LENGTH // SYMBOL
    order, group = merge(shards, steps)
    place = np.concatenate([np.where(x.place >= 0, x.place + bounds[a], -1) for x, a in zip(shards, cuts)])[order]
    shared = np.full(len(raw) + SYMBOL, -1, np.int64)
    shared[place[place >= 0]] = group[place >= 0]
    # The rest of the length, as one narrower symbol before the suffix.
    rest = LENGTH - steps * SYMBOL
    data = np.frombuffer(raw, np.uint8)
    own = np.repeat(np.arange(len(parts)), lengths)
    window = np.flatnonzero(np.arange(len(raw)) + LENGTH <= bounds[own + 1])
    shared = shared[window + rest]
    some = np.flatnonzero(np.bincount(shared)[shared] > 1)
    window, key = window[some], shared[some].astype(np.uint64)
    for i in range(rest):
        key = (key << np.uint64(8)) | data[window + i]
    order = np.argsort(key)
    window, key = window[order], key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
    lead = np.repeat(np.minimum.reduceat(window, new), np.diff(new, append=len(key))) if len(key) else window
    fragment, first = own[window], own[lead]
    where = starts[fragment] + window - bounds[fragment]
    copy = (ids[fragment] != ids[first]) | (where != starts[first] + lead - bounds[first])
    return S.runs(ids[fragment][copy], where[copy], LENGTH)


def _second_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks, marks = [], []
    for batch in batches:
        passed = batch.filter(batch.column(4).is_null())
        if passed.num_rows:
            yield passed
        for block in batch.column(4).drop_null():
            blocks.append(block.as_py())
            marks.append(S.unpacked(blocks[-1])[2])
    if not blocks:
        return
    # A minimiser that occurs once in all belongs to no repeat.
    found, n = np.unique(np.concatenate(marks) & np.uint32(0x7FFFFFFF), return_counts=True)
    often = found[n > 1]
    held = _Distinct()
    for block in blocks:
        ids, starts, own, lengths, raw = S.unpacked(block)
        some = np.flatnonzero(np.isin(own & np.uint32(0x7FFFFFFF), often) | (own >> 31 == 1))
        end = np.cumsum(lengths)[some]
        parts = [raw[a:b] for a, b in zip((end - lengths[some]).tolist(), end.tolist())]
        held.add(parts, ids[some], S.twins(lengths, raw)[some], starts[some], own[some])
    del blocks
    parts, (ids, twins, starts, own), copies = held.settled()
    del held
    if len(copies[0]):
        yield S.document_rows(*copies, 1)
    if not parts:
        return
    marks, alone = (own & np.uint32(0x7FFFFFFF)).astype(np.int64), own >> 31 == 0
    _, at, n = np.unique(marks, return_inverse=True, return_counts=True)
    chosen = np.flatnonzero((n[at.ravel()] > 1) | ~alone)
    chosen = chosen[may_repeat([parts[k] for k in chosen.tolist()], marks[chosen], alone[chosen])]
    chosen = chosen[np.argsort(marks[chosen], kind="stable")]
    # Fragments of one minimiser stay together.
    group, size, start = [], 0, 0
    for x, k in enumerate(chosen.tolist()):
        if x > start and size > MERGE_BYTES and marks[k] != marks[chosen[x - 1]]:
            group.append((start, x))
            start, size = x, 0
        size += len(parts[k])
    for x, y in [*group, (start, len(chosen))]:
        some = chosen[x:y]
        if len(some):
            number, own_ids, own_twins = S.numbered(ids[some], twins[some])
            doc, first, last = repeats([parts[k] for k in some.tolist()], number, starts[some])
            if len(doc):
                yield S.document_rows(own_ids[doc], own_twins[doc], first, last, 1)


def repeated_spans(df: DataFrame) -> DataFrame:
    """doc_id, twin, span: UTF-8 bytes covered by LENGTH-byte strings that start earlier elsewhere or in the document.

    Spans of a document may overlap. Rows of one doc_id and text are read as the same document; null ids come before all
    others, texts of one id in the order of their digests.
    """
    buckets = T.partitions(df.sparkSession)
    sent = S.documents(df).mapInArrow(_first_step(buckets), S.ROW)
    return S.document_spans(sent.repartitionById(buckets, "bucket").mapInArrow(_second_step, S.ROW))


def remove_repeats(df: DataFrame) -> DataFrame:
    """doc_id, kept (binary: the remaining bytes), n_bytes, n_removed and n_spans of every document.

    A null or empty text has no bytes; repeated rows give repeated rows; an empty table gives an empty one; other columns are
    left behind. Ids come as they are inside, see texts.public_id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            texts, out = T.Utf8(batch.column(1)), []
            for i, spans in enumerate(S.span_lists(batch.column(2))):
                text, at, kept = texts.text(i), 0, []
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                out.append((b"".join(kept), len(text), sum(b - a for a, b in spans), len(spans)))
            kept, n, m, k = map(list, zip(*out))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (n, m, k))], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    joined = S.with_spans(S.documents(df), repeated_spans(df))
    return joined.mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
