"""Byte-level BPE by prefix dynamic programming.

The BPE encoding of any byte prefix is unique, and so is its last token. The table
``last[i]`` holds it for every prefix of length ``i``: a vocabulary entry that ends
at ``i`` is that token exactly if the pair (last token of the rest, entry) is one
that BPE itself would leave side by side. Reading the table backwards gives the
encoding. Appending bytes only extends the table, cutting bytes off only shortens
it, so text can grow or be edited without encoding the rest again.

Two tokens may stand side by side when undoing their merges, latest first, never
uncovers a merge across the border that BPE would have made before.

A text is first cut into pieces by the vocabulary's public splitting pattern; no
token crosses a piece. Equal pieces are encoded once per Python worker.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.session import spread

#: The splitting pattern published with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces remembered by a worker, and the longest of them; beyond, pieces are encoded anew.
REMEMBERED, LONGEST_REMEMBERED = 300_000, 64


class Vocabulary:
    """Entries with their ranks, which are also their ids, and how each was merged."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        count = max(self.ids.values()) + 1
        self.parts: list[tuple[int, int] | None] = [None] * count
        self.merged: dict[tuple[int, int], int] = {}
        for entry, own in sorted(self.ids.items(), key=lambda x: x[1]):
            if len(entry) > 1:
                pair = self._last_merge(entry, own)
                if pair is not None:
                    self.parts[own] = pair
                    self.merged[pair] = own
        ends: dict[bytes, set[int]] = {}
        for entry in self.ids:
            ends.setdefault(entry[-2:], set()).add(len(entry))
        self.lengths = {tail: sorted(x, reverse=True) for tail, x in ends.items()}
        self._beside: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, list[int]] = {}

    def _last_merge(self, entry: bytes, own: int) -> tuple[int, int] | None:
        """The two parts the entry is merged from: BPE of it with the entries before it."""
        now = [self.ids[entry[i : i + 1]] for i in range(len(entry))]
        while len(now) > 2:
            best, at = own, -1
            for i in range(len(now) - 1):
                made = self.merged.get((now[i], now[i + 1]))
                if made is not None and made < best:
                    best, at = made, i
            if at < 0:
                return None  # no merge leads to this entry, so no encoding holds it
            now[at : at + 2] = [best]
        return (now[0], now[1])

    def beside(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens side by side."""
        known = self._beside.get((left, right))
        if known is None:
            if len(self._beside) > REMEMBERED:
                self._beside.clear()
            known = self._beside[left, right] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        # Merges up to, but not including, this rank are done before the border could change.
        before = len(self.parts)
        while True:
            made = self.merged.get((left, right))
            if made is not None and made < before:
                return False
            # Undo the later of the two last merges. On equal rank the left one was done first, so the right is undone first.
            cut_left, cut_right = self.parts[left], self.parts[right]
            if cut_left is None and cut_right is None:
                return True
            if cut_right is None or (cut_left is not None and left > right):
                before, left = left, cut_left[1]
            else:
                # A border merge of the same rank would come first, being further left.
                before, right = right + 1, cut_right[0]


class PrefixTable:
    """The last token of every prefix of some bytes."""

    __slots__ = ("data", "last", "vocabulary")

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        if data:
            self.append(data)

    def append(self, more: bytes) -> None:
        """Extend the table; nothing before the new bytes is looked at again but the entries that reach into them."""
        v, last, data = self.vocabulary, self.last, self.data + more
        ids, parts, lengths, beside = v.ids, v.parts, v.lengths, v.beside
        for end in range(len(self.data) + 1, len(data) + 1):
            tail = data[max(0, end - 2) : end]
            options = lengths.get(tail, ()) if end > 1 else ()
            found = ids[data[end - 1 : end]]
            for size in options:
                start = end - size
                if start < 0 or size == 1:
                    continue
                token = ids.get(data[start:end])
                if token is None or parts[token] is None:
                    continue
                if start == 0 or beside(last[start], token):
                    found = token
                    break
            last.append(found)
        self.data = data

    def cut(self, length: int) -> None:
        """Keep the first ``length`` bytes."""
        del self.last[length + 1 :]
        self.data = self.data[:length]

    def ids(self) -> list[int]:
        """The encoding, read backwards from the end."""
        out, at, size = [], len(self.data), self.vocabulary.size_of
        while at:
            out.append(self.last[at])
            at -= size(self.last[at])
        return out[::-1]


def _sizes(v: Vocabulary) -> list[int]:
    sizes = [0] * len(v.parts)
    for entry, own in v.ids.items():
        sizes[own] = len(entry)
    return sizes


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a ``.tiktoken`` file; read once per Python worker."""
    v = Vocabulary(path)
    v.size_of = _sizes(v).__getitem__
    return v


_SPLIT = regex.compile(PATTERN)


def encode_piece(v: Vocabulary, piece: str) -> list[int]:
    """Token ids of one piece."""
    known = v.pieces.get(piece)
    if known is None:
        known = PrefixTable(v, piece.encode()).ids()
        if len(piece) <= LONGEST_REMEMBERED:
            if len(v.pieces) >= REMEMBERED:
                v.pieces.clear()
            v.pieces[piece] = known
    return known


def encode(v: Vocabulary, text: str | None) -> list[int]:
    """Token ids of a text; the empty list for null and for the empty text."""
    out: list[int] = []
    if text:
        for piece in _SPLIT.findall(text):
            out += v.pieces.get(piece) or encode_piece(v, piece)
    return out


class EncodedText:
    """A text with its pieces, so that an edit encodes again only the pieces it touches."""

    def __init__(self, v: Vocabulary, text: str = "") -> None:
        self.vocabulary, self.text = v, text
        self.pieces = _SPLIT.findall(text)

    def ids(self) -> list[int]:
        return [i for piece in self.pieces for i in encode_piece(self.vocabulary, piece)]

    def append(self, more: str) -> None:
        self.edit(len(self.text), 0, more)

    def edit(self, at: int, removed: int, inserted: str) -> int:
        """Replace ``removed`` characters at ``at``; gives the number of pieces that were split anew.

        Where a piece ends is decided by at most two characters after it, so pieces that end two before the edit stay.
        Splitting never looks back, so once a new border falls on an old one the rest stays too.
        """
        old = self.pieces
        text = self.text[:at] + inserted + self.text[at + removed :]
        keep, start = 0, 0
        while keep < len(old) and start + len(old[keep]) + 1 < at:
            start += len(old[keep])
            keep += 1
        shift, borders, position = len(inserted) - removed, {}, start
        for i in range(keep, len(old)):
            if position >= at + removed:
                borders[position + shift] = i
            position += len(old[i])
        fresh, rest = [], len(old)
        for match in _SPLIT.finditer(text, start):
            if match.start() >= at + len(inserted) and match.start() in borders:
                rest = borders[match.start()]
                break
            fresh.append(match.group())
        self.text, self.pieces = text, old[:keep] + fresh + old[rest:]
        return len(fresh)


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            ids = pa.array([encode(v, t) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.record_batch([batch.column(0), ids], names=["doc_id", "ids"])

    return run


def encode_corpus(df: DataFrame, doc_id: str, text: str, path: str) -> DataFrame:
    """``doc_id, ids``: the token ids of every row's text by the vocabulary at ``path`` (a file every executor has).

    Text is taken as it is; what looks like a special token is ordinary text. Null and empty texts give the empty
    list, repeated rows are encoded each, a null id stays null, other columns are not read. No row of a large table is shuffled.
    """
    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return spread(rows).mapInArrow(_encoder(path), "doc_id bigint, ids array<int>")
