"""Substring dedup by super-k-mers of words.

A window is ``WINDOW`` consecutive words. Each window has a minimiser, the smallest hash of its ``SEED_WORDS``-word stretches;
consecutive windows that share it travel as one packed string to the bucket of that minimiser, so equal windows always meet.
There windows are sorted by two hashes, which bring equal ones together; neighbours are then compared in full, and every window
but the first of its group, by (document, start), is a copy. Each shuffle partition holds many buckets, sorted by Spark and
settled one after the other, so that a task holds the windows of one bucket at a time.

Before anything travels, each task settles the windows that repeat within what it holds: a window with an earlier copy in
the task is a copy whatever else exists, so only the first of each goes to its bucket. A passage that very many documents
share so reaches its bucket once per task and not once per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattfold.llm import spans as S, texts as T

WINDOW, SEED_WORDS = 20, 4
#: Bytes of text that a task settles at a time.
BLOCK_BYTES = 2_500_000
#: Buckets of each shuffle partition.
BUCKETS = 4
_WORD, _WINDOW, _OTHER, _SEED = (T.Roller(i) for i in (21, 22, 23, 24))


def _leaving_nothing(run):
    """See texts.leaving_nothing; the powers of the hashes go as well, 50 MB at full size."""
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for roller in (_WORD, _WINDOW, _OTHER, _SEED):
                roller.forget()

    return T.leaving_nothing(clean)


def _first_step(buckets: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches, limit=BLOCK_BYTES):
            batch = batch.take(pa.array(np.argsort(batch.column(0).to_numpy(zero_copy_only=False), kind="stable")))
            own = T.Utf8(batch.column(1))
            texts = T.Utf8(pa.array([b" ".join(own.text(i).split()) for i in range(len(own))], pa.large_binary()))
            words = T.Words(texts)
            first, doc = T.windows_within(words.counts, size)
            if not len(first):
                continue
            number, ids, twins = S.numbered(*(batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2)))
            number = number[doc]
            starts = first - words.bounds[doc]
            hashes = words.hashes(texts, _WORD)
            keys = [r.windows(r.sums(hashes), size)[first] for r in (_WINDOW, _OTHER)]
            copy = S.later_copies(keys, number, starts, texts.raw, words.start[first], words.end[first + size - 1])
            own, *spans = S.runs(number[copy], starts[copy], size)
            if len(own):
                yield S.document_rows(ids[own], twins[own], *spans, buckets)
            seeds = _SEED.windows(_SEED.sums(hashes), SEED_WORDS)
            least = T.sliding_minimum(seeds, size - SEED_WORDS + 1)[first]
            left = np.flatnonzero(~copy)
            if not len(left):
                continue
            new = np.ones(len(left), dtype=bool)
            new[1:] = (first[left[1:]] != first[left[:-1]] + 1) | (doc[left[1:]] != doc[left[:-1]]) | (least[left[1:]] != least[left[:-1]])
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(left)) - 1
            a, b = left[begin], left[end]
            bucket = (least[a] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            a, b, bucket = a[order], b[order], bucket[order]
            begins, ends = words.start[first[a]].tolist(), words.end[first[b] + size - 1].tolist()
            parts = [texts.raw[x:y] for x, y in zip(begins, ends)]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            blocks = []
            for x, y in zip(cuts, np.append(cuts[1:], len(bucket))):
                blocks.append(S.packed(ids[number[a[x:y]]], starts[a[x:y]], np.zeros(y - x, np.uint32), [p + b" " for p in parts[x:y]], twins[number[a[x:y]]]))
            yield S.block_rows(bucket[cuts].tolist(), blocks)

    return run


def _copies(blocks: list[bytes], size: int) -> Iterator[pa.RecordBatch]:
    """Spans of the windows of one bucket that have an earlier copy in it."""
    keys: list[list[np.ndarray]] = [[], []]
    ids, twins, held, starts, raws, begins, ends, parts, read = [], [], [], [], [], [], [], 0, 0
    for block in blocks:
        own, at, _, lengths, raw = S.unpacked(block)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        texts = T.Utf8(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(own), [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(raw)]))
        words = T.Words(texts)
        first, doc = T.windows_within(words.counts, size)
        hashes = words.hashes(texts, _WORD)
        for k, r in zip(keys, (_WINDOW, _OTHER)):
            k.append(r.windows(r.sums(hashes), size)[first])
        ids.append(own)
        twins.append(S.twins(lengths, raw))
        held.append(parts + doc)
        parts += len(own)
        starts.append(at[doc] + first - words.bounds[doc])
        begins.append(words.start[first] + read)
        ends.append(words.end[first + size - 1] + read)
        raws.append(texts.raw)
        read += len(texts.raw)
    number, whole, second = S.numbered(np.concatenate(ids), np.concatenate(twins))
    number, places = number[np.concatenate(held)], np.concatenate(starts)
    copy = S.later_copies([np.concatenate(k) for k in keys], number, places, b"".join(raws), np.concatenate(begins), np.concatenate(ends))
    found, *spans = S.runs(number[copy], places[copy], size)
    if len(found):
        yield S.document_rows(whole[found], second[found], *spans, 1)


def _second_step(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blocks = None, []
        for batch in batches:
            passed = batch.filter(batch.column(4).is_null())
            if passed.num_rows:
                yield passed
            sent = batch.filter(batch.column(4).is_valid())
            for own, block in zip(sent.column(0).to_pylist(), sent.column(4)):
                if own != bucket:
                    if blocks:
                        yield from _copies(blocks, size)
                    bucket, blocks = own, []
                blocks.append(block.as_py())
        if blocks:
            yield from _copies(blocks, size)

    return run


def repeated_spans(df: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, twin, span: words covered by windows that start earlier elsewhere or before in the same document.

    Spans of a document may overlap. Rows of one doc_id and text are read as the same document, so a repeated row repeats
    nothing; null ids come before all others, texts of one id in the order of their digests.
    """
    parts = T.partitions(df.sparkSession)
    sent = S.documents(df).mapInArrow(_leaving_nothing(_first_step(parts * BUCKETS, size)), S.ROW)
    dealt = sent.repartitionById(parts, F.pmod("bucket", F.lit(parts))).sortWithinPartitions("bucket")
    return S.document_spans(dealt.mapInArrow(_leaving_nothing(_second_step(size)), S.ROW))


def remove_repeats(df: DataFrame, size: int = WINDOW, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, kept_text (kept words joined by one space), n_words and n_removed of every document, and the columns ``keep``.

    A null or empty text has no words; a text shorter than a window loses none; repeated rows give repeated rows; an empty
    table gives an empty one; columns not asked for are left behind. Ids come as they are inside, see texts.public_id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            texts, out = T.Utf8(batch.column(1)), []
            for i, spans in enumerate(S.span_lists(batch.column(batch.num_columns - 1))):
                words = texts.text(i).split()
                at, kept = 0, []
                for a, b in spans:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                out.append((b" ".join(kept).decode(), len(words), len(words) - len(kept)))
            text, n, m = map(list, zip(*out))
            more = [batch.column(2 + k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string()), pa.array(n, pa.int64()), pa.array(m, pa.int64()), *more], names=names)

    names = ["doc_id", "kept_text", "n_words", "n_removed", *keep]
    schema = "doc_id long, kept_text string, n_words long, n_removed long" + "".join(f", `{k}` {df.schema[k].dataType.simpleString()}" for k in keep)
    return S.with_spans(S.documents(df, *keep), repeated_spans(df, size), *keep).mapInArrow(T.leaving_nothing(run), schema)
