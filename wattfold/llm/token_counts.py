"""Token counts: Arrow batches encoded by the library of a .json vocabulary, of which only lengths come back.

Texts are cut where white space follows something else, a place that no token of a byte-level vocabulary spans: the pattern
lets white space only begin a token, and added strings hold none. The library then encodes each distinct piece of a batch
once, in batches of bounded bytes; the lengths of frequent pieces stay in a bounded table of the worker.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattfold.llm import texts as T

#: Pieces whose lengths a worker remembers, and the longest such piece in characters. Bounds memory, never the result.
REMEMBERED, LONGEST = 1_200_000, 64
#: Bytes that the library encodes in one call.
CALL_BYTES = 500_000

_ODD_BLANK = re.compile(r"\s |\A ")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


def pieces(text: str) -> list[str]:
    """The text in pieces whose tokens, one after the other, are the tokens of the text."""
    if _ODD_BLANK.search(text):
        return _CUT.split(text)
    own = text.replace(" ", "\0 ").split("\0") if "\0" not in text else _CUT.split(text)
    return own


class Counter:
    """Counts tokens of texts with one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.safe = _cuts_are_safe(self.library)
        self.known: dict[str, int] = {"": 0}

    def lengths(self, texts: list[str]) -> Iterator[int]:
        """Lengths of whole texts, in calls of bounded bytes."""
        for part in _calls(texts):
            yield from map(len, self.library.encode_batch_fast(part, add_special_tokens=False))

    def lengths_of_pieces(self, new: list[str]) -> list[int]:
        """Lengths of pieces that each begin with a blank: many are encoded as one text and told apart by their offsets."""
        out: list[int] = []
        for part in _calls(new):
            found = self.library.encode("".join(part), add_special_tokens=False)
            ends = np.cumsum([len(x) for x in part])
            begun = np.searchsorted(ends, [x[0] for x in found.offsets], side="right")
            out.extend(np.bincount(begun, minlength=len(part)).tolist())
        return out

    def learn(self, pieces: list[str]) -> dict[str, int]:
        """Lengths of pieces that are not known: those that only add marks to a word are cut once more, the rest is encoded."""
        cut = {x: _finer(x) for x in pieces}
        known = self.known
        new = list({y for own in cut.values() for y in own if y not in known})
        blank = [y for y in new if y[0] == " "]
        other = [y for y in new if y[0] != " "]
        fresh = dict(zip(blank, self.lengths_of_pieces(blank), strict=True)) | dict(zip(other, self.lengths(other), strict=True))
        found = {x: sum([known[y] if y in known else fresh[y] for y in own]) for x, own in cut.items()}
        known.update((y, n) for y, n in fresh.items() if len(y) <= LONGEST)
        return found

    def counts(self, texts: list[str]) -> list[int]:
        if not self.safe:
            return list(self.lengths(texts))
        known, cut, missing = self.known, [], set()
        for text in texts:
            own = pieces(text)
            got = [*map(known.get, own)]
            if None in got:
                missing.update(x for x, n in zip(own, got) if n is None)
                cut.append((own, got))
            else:
                cut.append((None, got))
        extra = self.learn(list(missing))
        found = [sum(got) if own is None else sum([extra[x] if n is None else n for x, n in zip(own, got)]) for own, got in cut]
        known.update((x, n) for x, n in extra.items() if len(x) <= LONGEST)
        if len(known) > REMEMBERED:
            self.known = {"": 0}
        return found


def _calls(texts: list[str]) -> Iterator[list[str]]:
    """Lists of at most CALL_BYTES characters in all, or of one text."""
    start = held = 0
    for i, x in enumerate(texts):
        if held and held + len(x) > CALL_BYTES:
            yield texts[start:i]
            start, held = i, 0
        held += len(x)
    if texts[start:]:
        yield texts[start:]


def _finer(piece: str) -> list[str]:
    """A piece cut before line breaks, and before one mark that ends a word."""
    out = []
    for x in _CUT.split(piece) if "\n" in piece else [piece]:
        if len(x) > 2 and x[-1] in ",.;:!?" and x[-2] < "\u0250" and x[-2].isalpha():
            out += [x[:-1], x[-1]]
        elif x:
            out.append(x)
    return out


def _cuts_are_safe(library) -> bool:
    """Cuts before white space hold for plain byte-level vocabularies without a normaliser whose added strings hold no white space."""
    import json

    said = json.loads(library.to_str())
    before = said.get("pre_tokenizer") or {}
    return (
        not said.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        and not any(re.search(r"\s", x["content"]) or x["lstrip"] or x["rstrip"] or x["single_word"] for x in said.get("added_tokens") or [])
    )


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter for each vocabulary and worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every whole text, a null text counting as empty.

    Rows stay where they are: there is no shuffle. Equal rows give equal rows; an empty table gives an empty one; other
    columns are left behind, whatever their names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in T.chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(own.counts(batch.column(1).to_pylist()), type=pa.int64())], names=["doc_id", "n_bytes", "n_tokens"],
            )

    sized = T.documents(df).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    return sized.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").select(T.public_id(), "n_bytes", "n_tokens")
