"""Evaluation passages inside a corpus: SimHash windows, multi-index Hamming blocks, exact weighted-shingle check.

Windows of four fifths of an item's length or a little less (``4 s`` words, where ``5 s - 1`` words fit into the item) get a 64-bit SimHash of
their words. An item has ``s`` of them, at its first ``s`` places, a document one at each multiple of ``s``: wherever
a document holds the whole item, one of its windows lies over one of the item's. Fingerprints are cut into ``radius + 1`` blocks; two
fingerprints within the radius agree in at least one block, so looking up each block finds every such pair.

A document that holds a part of an item has no window near one of its (figures in the README). For those the runs of five words are anchors: whatever passes
the check shares one. Pairs of either kind are then checked exactly on whole texts: twelve words in a row in common, or shared
distinct five-word runs of at least half the weight of the item's.

The items' index is arrays, made once and broadcast; every Python worker reads it once. Items beyond ``most_chars`` characters go into further indexes; all are looked
up in the same single pass over the documents, which are never shuffled.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.session import spread

#: Words of a run, of a passage that counts alone; share of an item's weight that counts.
RUN, PASSAGE, SHARE = 5, 12, 0.5
RADIUS = 3
#: Strides of windows, each about 1.4 times the one before; a window is four strides long.
STRIDES = [4, 6, 8, 11, 16, 22, 31, 44, 62, 88, 124, 175, 248, 350, 495, 700, 990, 1400]
#: Characters of items, about, in one index.
MOST_CHARS = 32_000_000
#: Words looked up at once, and pairs of runs held at once.
CHUNK, HELD = 150_000, 4_000_000
#: Both ways to candidates.
WAYS = ("windows", "anchors")

_WORD = regex.compile(r"[\p{L}\p{N}]+")
_PLAIN_WORD = re.compile(r"[a-z0-9]+")
_FORMAT = regex.compile(r"\p{Cf}+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Maximal runs of letters and digits of the lower-cased NFKC form, without format characters."""
    if not text:
        return []
    if text.isascii():
        return _PLAIN_WORD.findall(text.lower())
    return _WORD.findall(_FORMAT.sub("", unicodedata.normalize("NFKC", text)).lower())


class _Hashes(dict):
    """64 bits per word, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def runs_of(hashes: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """64 bits for each run of ``size`` words, or for those that begin ``at`` places."""
    count = max(0, len(hashes) - size + 1)
    out = np.zeros(count if at is None else len(at), dtype=np.uint64)
    for i in range(size if len(out) else 0):
        out *= _ODD
        out += hashes[i : i + count] if at is None else hashes[at + i]
        out ^= out >> np.uint64(29)
    return out


def fingerprints(hashes: np.ndarray, stride: int) -> np.ndarray:
    """SimHash of the windows of four strides at every multiple of ``stride``: a bit is set when more than half of the words have it."""
    blocks = len(hashes) // stride
    if blocks < 4:
        return np.empty(0, dtype=np.uint64)
    return _prints(_bits(hashes[: blocks * stride]), stride)


#: The eight bits of a byte as eight bytes.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def _bits(hashes: np.ndarray) -> np.ndarray:
    """One row of 64 bits, as bytes, per word."""
    return _SPREAD[np.ascontiguousarray(hashes).view(np.uint8)].view(np.uint8).reshape(-1, 64)


def _prints(bits: np.ndarray, stride: int) -> np.ndarray:
    blocks = len(bits) // stride
    if blocks < 4:
        return np.empty(0, dtype=np.uint64)
    sums = bits[: blocks * stride].reshape(blocks, stride, 64).sum(axis=1, dtype=np.uint16)
    votes = sums[:-3] + sums[1:-2] + sums[2:-1] + sums[3:]
    return np.packbits(votes > 2 * stride, axis=1).view(np.uint64).ravel()


def blocks_of(prints: np.ndarray, radius: int) -> list[np.ndarray]:
    """``radius + 1`` blocks of equal width (of 64 bits) as numbers."""
    count = radius + 1
    edges = [round(i * 64 / count) for i in range(count + 1)]
    return [(prints >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1) for a, b in zip(edges, edges[1:], strict=False)]


def _expanded(starts: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place its span in ``starts``: which place, and which entry."""
    size = starts[place + 1] - starts[place]
    which = np.repeat(np.arange(len(place)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts[place], size)


class Lookup:
    """Sorted distinct keys with the entries of each."""

    def __init__(self, keys: np.ndarray, entries: np.ndarray | None = None) -> None:
        order = np.argsort(keys, kind="stable")
        self.values, starts = np.unique(keys[order], return_index=True)
        self.starts = np.append(starts, len(keys)).astype(np.int64)
        self.entries = (order if entries is None else entries[order]).astype(np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``keys`` that are known, and in ``values`` where."""
        if not len(self.values) or not len(keys):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        place = np.searchsorted(self.values, keys)
        place[place == len(self.values)] = 0
        hit = np.flatnonzero(self.values[place] == keys)
        return hit, place[hit]


class WindowIndex:
    """Fingerprints of windows by block."""

    def __init__(self, prints: np.ndarray, owners: np.ndarray, radius: int = RADIUS) -> None:
        self.prints, self.owners, self.radius = prints, owners.astype(np.int32), radius
        self.tables = [Lookup(b) for b in blocks_of(prints, radius)]

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all fingerprints within the radius."""
        at, item = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int32)]
        for block, table in zip(blocks_of(prints, self.radius), self.tables, strict=True):
            hit, place = table.find(block)
            for some in range(0, len(hit), 20_000):
                which, entry = _expanded(table.starts, place[some : some + 20_000])
                window, other = hit[some : some + 20_000][which], table.entries[entry]
                near = np.bitwise_count(prints[window] ^ self.prints[other]) <= self.radius
                at.append(window[near])
                item.append(self.owners[other[near]])
        return np.concatenate(at), np.concatenate(item)


class ItemIndex:
    """Some items as arrays: windows by stride and block, runs and passages with their items."""

    def __init__(self, items: Iterable[tuple[int, str | None]], radius: int = RADIUS, rare: bool = False) -> None:
        hashes = _Hashes()
        self.ids: list[int] = []
        self.texts: list[str] = []
        runs, passages, owners, lasts = [], [], [], []
        windows: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        for item, text in items:
            words = words_of(text)
            if len(words) < RUN:
                continue
            at = len(self.ids)
            self.ids.append(item)
            self.texts.append(" ".join(words))
            own = np.array([hashes[w] for w in words], dtype=np.uint64)
            runs.append(np.unique(runs_of(own, RUN)))
            owners.append(np.full(len(runs[-1]), at))
            passages.append(np.unique(runs_of(own, PASSAGE)))
            lasts.append(np.full(len(passages[-1]), at))
            fitting = [s for s in STRIDES if 5 * s - 1 <= len(words)]
            if fitting:
                s = fitting[-1]
                found = np.unique(np.concatenate([fingerprints(own[i : i + 4 * s], s) for i in range(s)]))
                prints, whose = windows.setdefault(s, ([], []))
                prints.append(found)
                whose.append(np.full(len(found), at))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, dtype=kind)
        self.runs = Lookup(join(runs, np.uint64), join(owners, np.int64))
        self.passages = Lookup(join(passages, np.uint64), join(lasts, np.int64))
        held = np.diff(self.runs.starts)
        self.weights = np.log1p(len(self.ids) / held) if rare else np.ones(len(held))
        self.need = SHARE * np.bincount(self.runs.entries, weights=np.repeat(self.weights, held), minlength=len(self.ids))
        self.windows = {s: WindowIndex(join(p, np.uint64), join(w, np.int64), radius) for s, (p, w) in windows.items()}

    def pairs(self, hashes: np.ndarray, doc: np.ndarray, ways: tuple[str, ...] = WAYS) -> np.ndarray:
        """``document * items + item`` of those pairs found in the given ``ways`` that pass the check by hashes. ``doc`` numbers the document of each word, ascending."""
        count = len(self.ids)
        near = np.unique(self._near(hashes, doc)) if "windows" in ways else np.empty(0, dtype=np.int64)
        run = runs_of(hashes, RUN)
        at, place = self.runs.find(run)
        inside = doc[at] == doc[at + RUN - 1]
        at, place = at[inside], place[inside]
        owned = self.runs.starts[place + 1] - self.runs.starts[place]
        found = [np.empty(0, dtype=np.int64)]
        # Documents a few at a time, so that runs which many items share don't pile up; a document stays in one part.
        part = np.cumsum(owned) // HELD if len(owned) else owned
        cuts = [0, *(np.flatnonzero((np.diff(part) > 0) & (np.diff(doc[at]) > 0)) + 1 if len(at) else []), len(at)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            which, entry = _expanded(self.runs.starts, place[a:b])
            # A run counts once for a document, however often it occurs there.
            key, first = np.unique(doc[at[a:b]][which] * len(self.runs.entries) + entry, return_index=True)
            pair = key // len(self.runs.entries) * count + self.runs.entries[entry[first]]
            each, where = np.unique(pair, return_inverse=True)
            weight = np.bincount(where, weights=self.weights[place[a:b][which[first]]], minlength=len(each))
            found.append(each[weight >= self.need[each % count] * (1 - 1e-12)])
        long = at[at + PASSAGE <= len(hashes)]
        long = long[doc[long] == doc[long + PASSAGE - 1]]
        hit, place = self.passages.find(runs_of(hashes, PASSAGE, long))
        which, entry = _expanded(self.passages.starts, place)
        found.append(doc[long[hit[which]]] * count + self.passages.entries[entry])
        passing = np.unique(np.concatenate(found))
        return passing if "anchors" in ways else np.intersect1d(passing, near)

    def _near(self, hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Pairs with fingerprints within the radius."""
        found = [np.empty(0, dtype=np.int64)]
        longest = 4 * max(self.windows, default=0)
        for start in range(0, len(hashes), CHUNK):
            part, own = hashes[start : start + CHUNK + longest], doc[start : start + CHUNK + longest]
            bits = _bits(part)
            for s, index in self.windows.items():
                skip = -start % s  # multiples of the stride from the beginning of all words
                prints = _prints(bits[skip:], s)
                first = np.arange(len(prints)) * s + skip
                whole = own[first] == own[first + 4 * s - 1]
                at, item = index.candidates(prints[whole])
                found.append(own[first[whole][at]] * len(self.ids) + item)
        return np.concatenate(found)

    def carried(self, words: list[str], item: int, rare: bool = False) -> bool:
        """The check on the words themselves, of one document and one item."""
        theirs = self.texts[item].split(" ")
        mine = {tuple(words[i : i + RUN]) for i in range(len(words) - RUN + 1)}
        own = {tuple(theirs[i : i + RUN]) for i in range(len(theirs) - RUN + 1)}
        shared = mine & own
        if not rare and 2 * len(shared) >= len(own) or rare and shared:
            return True
        return bool({tuple(words[i : i + PASSAGE]) for i in range(len(words) - PASSAGE + 1)} & {tuple(theirs[i : i + PASSAGE]) for i in range(len(theirs) - PASSAGE + 1)})


def _probe(shared: list, ways: tuple[str, ...], rare: bool):
    """``shared``: broadcast indexes. With one, a worker keeps it; of several it has one in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()

        def indexes() -> Iterator[ItemIndex]:
            for b in shared:
                yield b.value if len(shared) == 1 else b.load_from_path(b._path)

        def chunk(docs: list[int], texts: list[list[str]], values: list[int]) -> Iterator[tuple[int, int]]:
            doc, words = np.repeat(np.arange(len(texts)), [len(t) for t in texts]), np.array(values, dtype=np.uint64)
            for index in indexes():
                for p in index.pairs(words, doc, ways).tolist() if index.ids else ():
                    d, item = divmod(p, len(index.ids))
                    if index.carried(texts[d], item, rare):
                        yield docs[d], index.ids[item]

        for batch in batches:
            out: list[tuple[int, int]] = []
            docs, texts, values = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                if len(words) >= RUN:
                    docs.append(doc_id)
                    texts.append(words)
                    values += map(hashes.__getitem__, words)
                    if len(values) > CHUNK:
                        out += chunk(docs, texts, values)
                        docs, texts, values = [], [], []
            if docs:
                out += chunk(docs, texts, values)
            yield pa.record_batch([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["doc_id", "item_id"])

    return run


def _indexes(items: DataFrame, radius: int, most_chars: int, rare: bool) -> Iterator[ItemIndex]:
    """Indexes of about ``most_chars`` characters each; the driver has one of them in memory at a time."""
    held, chars = [], 0
    for r in items.toLocalIterator():
        held.append((r.item_id, r.text))
        chars += len(r.text)
        if chars >= most_chars:
            yield ItemIndex(held, radius, rare)
            held, chars = [], 0
    yield ItemIndex(held, radius, rare)


def leaked_items(docs: DataFrame, items: DataFrame, radius: int = RADIUS, most_chars: int = MOST_CHARS, ways: tuple[str, ...] = WAYS, rare: bool = False) -> DataFrame:
    """``doc_id, item_id`` of documents that carry an item. ``docs``: doc_id, text; ``items``: item_id, text.

    Whole texts are read. A null or empty text carries nothing and is carried by nothing, as is an item of fewer than
    five words; rows with a null id are left out; repeated rows give one pair; an id given to several texts counts for each. Other columns are not read.
    Every run has the weight 1; with ``rare`` a run weighs more the fewer items of its index have it. ``ways`` can leave one way to candidates out, to measure the other.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).where("doc_id is not null and text is not null")
    items = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).where("item_id is not null and text is not null")
    context = docs.sparkSession.sparkContext
    shared = [context.broadcast(index) for index in _indexes(items, radius, most_chars, rare)]
    return spread(docs).mapInArrow(_probe(shared, ways, rare), "doc_id bigint, item_id bigint").distinct()
