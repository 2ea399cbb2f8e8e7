"""SentencePiece encoding and decoding by a prefix table.

In a merge vocabulary every prefix of a text has exactly one last token in its encoding. The table is filled from left to
right: an automaton finds the vocabulary pieces that end at a character, and the one that is *compatible* with the last
token before it is stored. Two tokens are compatible when merging their joined characters gives back those two tokens. The
ids are then read backwards through the table.

The library's merges take any two neighbours whose joined text is a piece, best score first, leftmost on ties. Merges on the
two sides of a border that nothing crosses do not influence each other, so an encoding is right exactly when each of its
neighbouring pairs is compatible: the first merge to cross a border would have to occur in that pair alone as well.

Texts are first normalised by the library and cut where two neighbouring characters stand together in no piece, such as
before a blank mark; no token spans such a cut (this is read from the vocabulary). A bounded table keeps frequent stretches.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from wattfold.llm import texts as T

BLANK = "▁"
#: Stretches and token pairs that a worker remembers, and the longest such stretch. Bounds memory, never the result.
REMEMBERED, LONGEST = 1_000_000, 48


class Codec:
    """Encodes and decodes with one .model file of merge type."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.library = library = SentencePieceProcessor(model_file=path)
        every = range(library.get_piece_size())
        self.text_of = [library.id_to_piece(i) for i in every]
        self.byte_ids = {int(self.text_of[i][1:-1], 16): i for i in every if library.is_byte(i)}
        self.unknown = library.unk_id()
        plain = [i for i in every if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))]
        self.id_of = {self.text_of[i]: i for i in plain}
        self.score_of = {self.text_of[i]: library.get_score(i) for i in plain}
        if len(self.byte_ids) != 256 or any(library.is_unused(i) for i in every):
            raise ValueError("the prefix table needs a merge vocabulary with byte fallback and without unused pieces")
        longer = [p for p in self.id_of if len(p) > 1]
        if any(BLANK in p.lstrip(BLANK) for p in longer):
            raise ValueError("a piece holds the blank mark after other characters")
        self.cut = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self.automaton = ahocorasick.Automaton()
        #: Of each token: the scores of its merges in the order they happen, and what then stands at its right and left edge.
        self.steps: dict[str, tuple[list[float], list[str], list[str]]] = {}
        for p in longer:
            # A piece is a token only if merging its own characters yields it.
            tokens, steps = self.merged(p)
            if tokens == [p]:
                self.steps[p] = steps
                self.automaton.add_word(p, p)
        self.inner = {x for p in longer for x in zip(p, p[1:])}
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.high = {i for i, b in self.byte_of.items() if b >= 128}
        control = {i for i in every if library.is_control(i)}
        self.shown = ["" if i in control else p.replace(BLANK, " ") for i, p in enumerate(self.text_of)]
        for b in range(128):
            self.shown[self.byte_ids[b]] = chr(b)
        self.shown[self.unknown] = library.decode([self.unknown]).strip(" ") and " ⁇ "

    def merged(self, text: str) -> tuple[list[str], tuple[list[float], list[str], list[str]]]:
        """What best-first merging leaves of a text, which defines the encoding, and the steps that led there."""
        parts, after = list(text), list(range(1, len(text) + 1))
        before, score = list(range(-1, len(text) - 1)), self.score_of
        queue: list = []
        scores, rights, lefts = [], [text[-1:]], [text[:1]]

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < len(parts) and (joined := parts[left] + parts[right]) in score:
                heapq.heappush(queue, (-score[joined], left, right, joined))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while queue:
            worst, left, right, joined = heapq.heappop(queue)
            if not parts[left] or not parts[right] or after[left] != right or parts[left] + parts[right] != joined:
                continue
            parts[left], parts[right] = joined, ""
            after[left] = after[right]
            if after[right] < len(parts):
                before[after[right]] = left
            scores.append(-worst)
            rights.append(joined if after[left] == len(parts) else rights[-1])
            lefts.append(joined if left == 0 else lefts[-1])
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p], (scores, rights, lefts)

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging left + right never crosses the border.

        Both sides go through their own steps, the better score first and the left side on ties; a piece that joins the two
        edges of the moment crosses when it beats the next step of the left side and is no worse than that of the right.
        """
        score = self.score_of
        own, rights, _ = self.steps.get(left) or ([], [left], [left])
        other, _, lefts = self.steps.get(right) or ([], [right], [right])
        i = j = 0
        while True:
            a = own[i] if i < len(own) else None
            b = other[j] if j < len(other) else None
            crossing = score.get(rights[i] + lefts[j])
            if crossing is not None and (a is None or crossing > a) and (b is None or crossing >= b):
                return False
            if a is not None and (b is None or a >= b):
                i += 1
            elif b is not None:
                j += 1
            else:
                return True

    def tokens(self, text: str) -> list[str]:
        """The tokens of a stretch: the table of last tokens forwards, then the way back."""
        last, done, pairs = list(text), -1, self.pairs
        for end, piece in self.automaton.iter(text):  # for each end, the longest piece comes first
            if end == done:
                continue
            start = end - len(piece)
            if start >= 0:
                fits = pairs.get(pair := (last[start], piece))
                if fits is None:
                    fits = pairs[pair] = self.compatible(*pair)
                if not fits:
                    continue
            last[end], done = piece, end
        found, i = [], len(text) - 1
        while i >= 0:
            found.append(last[i])
            i -= len(last[i])
        return found[::-1]

    def stretches(self, text: str) -> list[str]:
        """The text cut wherever two neighbouring characters stand together in no piece."""
        if text[text[:1] == BLANK :].isalpha():
            return [text]
        inner, cuts = self.inner, [0]
        cuts += [i for i, pair in enumerate(zip(text, text[1:]), 1) if pair not in inner]
        return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]

    def ids_of_stretch(self, text: str) -> tuple[int, ...]:
        found: list[int] = []
        for p in self.tokens(text):
            if (i := self.id_of.get(p)) is not None:
                found.append(i)
            else:
                found.extend(self.byte_ids[b] for b in p.encode())
        return tuple(found)

    def ids_of_word(self, x: str) -> tuple[int, ...]:
        ids: tuple[int, ...] = ()
        for y in self.stretches(x):
            more = self.known.get(y)
            if more is None:
                more = self.ids_of_stretch(y)
                if len(y) <= LONGEST:
                    self.known[y] = more
            ids += more
        if len(x) <= LONGEST:
            self.known[x] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """All ids of a whole text, without begin or end ids."""
        words = self.words(self.library.normalize(text))
        got = [*map(self.known.get, words)]
        if None in got:
            got = [self.ids_of_word(x) if ids is None else ids for x, ids in zip(words, got)]
            if len(self.known) > self.remembered:
                self.known.clear()
            if len(self.pairs) > self.remembered:
                self.pairs.clear()
        return [*chain.from_iterable(got)]

    def forget(self) -> None:
        """Lets go of what was remembered of earlier texts."""
        self.known.clear()
        self.pairs.clear()

    def words(self, text: str) -> list[str]:
        """A normalised text cut before its runs of blank marks."""
        if f"{BLANK}{BLANK}" in text or "\0" in text:
            return self.cut.findall(text)
        return [x for x in text.replace(BLANK, f"\0{BLANK}").split("\0") if x]

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: pieces in a row, byte runs as UTF-8 with bad bytes replaced, the first blank dropped."""
        if not ids:
            return ""
        shown = self.shown
        parts = [*map(shown.__getitem__, ids)]
        if not self.high.isdisjoint(ids):
            # Bytes of 128 and more are read in runs; a smaller byte is a character wherever it stands.
            where = [k for k, i in enumerate(ids) if i in self.byte_of]
            k = 0
            while k < len(where):
                stop = k + 1
                while stop < len(where) and where[stop] == where[stop - 1] + 1:
                    stop += 1
                parts[where[k] : where[stop - 1] + 1] = [_utf8(bytes(self.byte_of[i] for i in ids[where[k] : where[stop - 1] + 1])), *[""] * (stop - k - 1)]
                k = stop
        if parts[0].startswith(" ") and ids[0] not in self.byte_of and ids[0] != self.unknown:
            parts[0] = parts[0][1:]
        return "".join(parts)


def _utf8(raw: bytes) -> str:
    """UTF-8 where it is well formed; each byte that is not becomes one replacement character, as in the library."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[i : i + n].decode())
                    break
                except UnicodeDecodeError:
                    pass
            else:
                n = 1
                out.append("�")
            i += n
        return "".join(out)


_CODECS: dict[tuple[str, int], Codec] = {}


def codec(path: str, remembered: int = REMEMBERED) -> Codec:
    """One codec for each vocabulary, bound of its memory (about 230 bytes an entry) and worker."""
    if (path, remembered) not in _CODECS:
        _CODECS[path, remembered] = Codec(path, remembered)
    return _CODECS[path, remembered]


def encode(df: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text; null is read as empty and has no ids.

    No shuffle; repeated rows give repeated rows; an empty table gives an empty one; other columns are left behind.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in T.chunks(batches):
            ids = pa.array([own.encode(x) for x in batch.column(1).to_pylist()], type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    return T.documents(df).mapInArrow(run, "doc_id long, ids array<int>").select(T.public_id(), "ids")


def decode(df: DataFrame, path: str) -> DataFrame:
    """doc_id and text of the column ids; null ids or null entries are read as none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            made = [own.decode([i for i in x or () if i is not None]) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, type=pa.string())], names=["doc_id", "text"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
