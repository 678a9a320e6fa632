"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

A document is contaminated by a benchmark item when some window of as many
words as the item has (or the whole document, if that is shorter) is similar
to it: weighted Jaccard similarity of the five-word shingles, repeats counted,
of at least 0.8.

A similar window leaves out at most a fifth of the item's shingles, so it
shares one of any set of more than that: the item's rarest shingles, by the number of items
that have them, name the windows to look at, and a stem that many items share names
none. These windows get SimHash fingerprints from running bit sums, only around the shared
shingles and in slices of bounded size.
Each fingerprint is cut into radius + 1 blocks; within the radius at least one
block is equal (there are more blocks than differing bits), so windows that agree
with the item in a block hold every one within the radius, and the exact similarity decides.

The benchmark is the stated query set: it goes to the tasks in blocks of
bounded size, one pass over the documents per block. Documents are never
shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RADIUS = 24
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 22
_CACHE = 300_000
_SLICE = 1 << 16

# ASCII letters and digits stay, other ASCII characters part words.
_FOLD = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256))
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and digits."""
    if not text:
        return []
    if text.isascii():
        return text.lower().encode("ascii").translate(_FOLD).split()
    return " ".join(_WORD.findall(text.lower())).encode("utf-8").split()


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_hashes = _WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every run of k words."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out = out * _PRIME + h[i:n + i]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def window_prints(hashes: np.ndarray, size: int, starts: np.ndarray) -> np.ndarray:
    """SimHash of ``size`` consecutive shingles at each start (ascending starts)."""
    lo, hi = int(starts[0]), int(starts[-1]) + size
    sums = np.zeros((hi - lo + 1, 64), dtype=np.int32)
    np.cumsum(_bits(hashes[lo:hi]), axis=0, dtype=np.int32, out=sums[1:])
    votes = sums[starts - lo + size] - sums[starts - lo]
    return np.packbits(2 * votes > size, axis=1).view(">u8").ravel().astype(np.uint64)


def window_slices(at: np.ndarray, size: int, last: int) -> Iterator[np.ndarray]:
    """The starts (0 to ``last``) of the windows of ``size`` that hold one of the places ``at`` (ascending), in
    slices of neighbouring starts, at most _SLICE of them."""
    low, high = np.maximum(at - size + 1, 0), np.minimum(at, last)
    # Ranges that meet become one.
    fresh = np.concatenate([[True], low[1:] > np.maximum.accumulate(high)[:-1] + 1])
    first = low[fresh]
    final = np.maximum.reduceat(high, np.flatnonzero(fresh))
    for a, b in zip(first.tolist(), final.tolist()):
        for start in range(a, b + 1, _SLICE):
            yield np.arange(start, min(b + 1, start + _SLICE))


def rare_enough(shingles: int, threshold: float) -> int:
    """So many of an item's shingles (repeats counted) that a similar window must have one of them."""
    # |a and b| >= t |a or b| >= t |a|: at least t of the item's shingles are shared.
    return shingles - math.ceil(threshold * shingles - 1e-9) + 1


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: sum of the smaller counts over sum of the larger."""
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


def shingle_counts(words: list[bytes], k: int) -> Counter:
    return Counter(zip(*(words[i:] for i in range(k))))


@dataclass
class _Sized:
    """Items of one length: fingerprints and shingle counts."""

    length: int
    k: int
    items: list[int] = field(default_factory=list)
    prints: np.ndarray | None = None
    counts: list[Counter] = field(default_factory=list)

    def finish(self, words: list[list[bytes]]) -> None:
        at = np.zeros(1, dtype=np.int64)
        per_item = [shingle_hashes(word_hashes(w), self.k) for w in words]
        self.prints = np.array([window_prints(h, len(h), at)[0] for h in per_item], dtype=np.uint64)
        self.counts = [shingle_counts(w, self.k) for w in words]


class HammingBlocks:
    """radius + 1 blocks of a fingerprint; fingerprints within the radius agree in one of them."""

    def __init__(self, radius: int):
        edges = np.linspace(0, 64, min(radius + 1, 64) + 1).round().astype(int)
        self.radius = radius
        self.masks = [np.uint64(((1 << int(b - a)) - 1) << int(a)) for a, b in zip(edges[:-1], edges[1:])]

    def within(self, prints: np.ndarray, one: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """(places, distances) of the fingerprints within the radius of ``one``, by agreeing blocks first."""
        differs = prints ^ one
        agree = np.zeros(len(prints), dtype=bool)
        for mask in self.masks:
            agree |= (differs & mask) == 0
        at = np.flatnonzero(agree)
        far = np.bitwise_count(differs[at])
        near = far <= self.radius
        return at[near], far[near]


class BenchmarkIndex:
    """The items of one block of the benchmark, ready to be searched for in texts."""

    def __init__(self, items: list[tuple[int, str]], shingle_words: int, threshold: float, radius: int):
        self.threshold, self.blocks = threshold, HammingBlocks(radius)
        self.ids = [i for i, _ in items]
        self.groups: dict[int, _Sized] = {}
        self.item_place: dict[int, tuple[_Sized, int]] = {}
        members: dict[int, list[list[bytes]]] = defaultdict(list)
        self.postings: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for at, (_, text) in enumerate(items):
            words = words_of(text)
            if not words:
                continue  # an item without words is in no document
            k = min(shingle_words, len(words))
            group = self.groups.setdefault(len(words), _Sized(len(words), k))
            self.item_place[at] = (group, len(group.items))
            group.items.append(at)
            members[len(words)].append(words)
        for length, group in self.groups.items():
            group.finish(members[length])
        self._post(members)
        self.postings = {k: dict(v) for k, v in self.postings.items()}
        self.seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k, post in self.postings.items():
            table = np.zeros(1 << _TABLE_BITS, dtype=bool)
            keys = np.sort(np.fromiter(post, dtype=np.uint64, count=len(post)))
            table[(keys >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
            self.seen[k] = (table, keys)

    def _post(self, members: dict[int, list[list[bytes]]]) -> None:
        """Each item under its rarest shingles, as many as a similar window cannot all lack."""
        hashes = {}
        spread: dict[int, Counter] = defaultdict(Counter)
        for length, group in self.groups.items():
            for at, words in zip(group.items, members[length]):
                hashes[at] = Counter(shingle_hashes(word_hashes(words), group.k).tolist())
                spread[group.k].update(hashes[at].keys())
        for at, counts in hashes.items():
            k = self.item_place[at][0].k
            left = rare_enough(sum(counts.values()), self.threshold)
            for h in sorted(counts, key=lambda h: (spread[k][h], h)):
                if left <= 0:
                    break
                self.postings[k][h].append(at)
                left -= counts[h]

    def search(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(item id, similarity, first word, words) of each item found, at its most similar window."""
        words = words_of(text)
        if not words:
            return []
        hashes = word_hashes(words)
        found = []
        for k in self.postings:
            found += self._search(words, shingle_hashes(hashes, k), k)
        return found

    def _search(self, words: list[bytes], h: np.ndarray, k: int) -> list[tuple[int, float, int, int]]:
        if not len(h):
            return []
        table, keys = self.seen[k]
        maybe = np.flatnonzero(table[(h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        if not len(maybe):
            return []
        place = np.searchsorted(keys, h[maybe])
        hits = maybe[(place < len(keys)) & (keys[np.minimum(place, len(keys) - 1)] == h[maybe])]
        if not len(hits):
            return []
        at_of: dict[int, list[int]] = defaultdict(list)
        post = self.postings[k]
        for p in hits.tolist():
            for item in post[int(h[p])]:
                at_of[item].append(p)
        found = []
        for item in sorted(at_of):
            group, place_in = self.item_place[item]
            if group.k == k and (hit := self._best(words, h, group, place_in, np.array(at_of[item]))):
                found.append((self.ids[item], *hit))
        return found

    def _best(self, words, h, group: _Sized, i: int, at: np.ndarray) -> tuple[float, int, int] | None:
        """(similarity, first word, words) of the window most similar to one item, of those that hold a shingle at ``at``."""
        size = min(group.length - group.k + 1, len(h))   # shingles per window
        best, start_of_best = 0.0, 0
        for starts in window_slices(at, size, len(h) - size):
            places, far = self.blocks.within(window_prints(h, size, starts), group.prints[i])
            for w in places[np.argsort(far, kind="stable")].tolist():
                start = int(starts[w])
                s = similarity(shingle_counts(words[start:start + size + group.k - 1], group.k), group.counts[i])
                if s >= self.threshold and (s, -start) > (best, -start_of_best):
                    best, start_of_best = s, start
                if best == 1.0:     # the nearest windows come first, and of these the first
                    return best, start, size + group.k - 1
        return (best, start_of_best, size + group.k - 1) if best else None


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items with text, repeated rows once, in blocks of at most ``block_chars`` characters (or one item)."""
    rows = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        "id IS NOT NULL AND text IS NOT NULL").distinct()
    block, size = [], 0
    for row in rows.toLocalIterator():
        if block and size + len(row["text"]) > block_chars:
            yield block
            block, size = [], 0
        block.append((row["id"], row["text"]))
        size += len(row["text"])
    if block:
        yield block


def _indexes(benchmark, item_col, item_text_col, shingle_words, threshold, radius, block_chars):
    spark = benchmark.sparkSession
    for block in _blocks(benchmark, item_col, item_text_col, block_chars):
        yield spark.sparkContext.broadcast(BenchmarkIndex(sorted(block), shingle_words, threshold, radius))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", shingle_words: int = 5,
                 threshold: float = 0.8, radius: int = RADIUS, block_chars: int = 4_000_000) -> DataFrame:
    """(id_col, item_id, similarity, first_word, n_words): items found in documents.

    One row per document row and item, at the window most similar to the item
    (the first of equals). Words are runs of letters and digits without case.
    An item of fewer words than a shingle is one shingle of all its words.
    Null and wordless items and texts match nothing; items with a null id are
    ignored. Repeated document rows come back repeated; extra columns are
    ignored. A window at the similarity threshold lies beyond ``radius`` (24
    of 64 bits) with a probability of about one in a million.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = "id long, item_id long, similarity double, first_word long, n_words long"
    out = None
    for index in _indexes(benchmark, item_col, item_text_col, shingle_words, threshold, radius, block_chars):

        def run(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                found = [(i, *hit) for i, t in zip(pdf["id"].astype("Int64"), pdf["text"])
                         for hit in index.value.search(t)]
                yield pd.DataFrame(found, columns=["id", "item_id", "similarity", "first_word", "n_words"]).astype(
                    {"id": "Int64", "item_id": "Int64"})

        part = rows.mapInPandas(run, schema)
        out = part if out is None else out.union(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnRenamed("id", id_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", shingle_words: int = 5, threshold: float = 0.8,
                      radius: int = RADIUS, block_chars: int = 4_000_000) -> DataFrame:
    """``docs`` without the documents in which :func:`contaminated` finds an item; columns as they are."""
    out = docs
    for index in _indexes(benchmark, item_col, item_text_col, shingle_words, threshold, radius, block_chars):
        out = out.filter(_holds_none(index)(F.col(text_col)))
    return out


def _holds_none(index):
    """Column function: whether no item of an index is in a text."""

    @F.pandas_udf("boolean")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([not index.value.search(t) for t in texts], dtype=bool)

    return udf
