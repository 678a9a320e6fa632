"""Language-model scoring with Brown classes.

Exchange clustering puts words into classes so that the class bigrams of the
corpus are as likely as possible. A text's probability is the product, token by
token, of the smoothed transition from the class before and the smoothed
emission of the word by its class.

The clustered vocabulary and the number of classes follow the corpus. All words
begin in a class by their ending. The most frequent ones (a number that grows
with the root of the vocabulary) are exchanged in sweeps over their own
bigrams. Then every other word seen ``min_count`` times or more is exchanged: one
pass over the corpus gathers the classes of its neighbours, word by word in a
shuffle, and the word goes to the class that raises the likelihood most. Rarer
and unseen words take the class that most clustered tokens with their ending have.

Word counts and classes are a distributed table. The most frequent words (a
bounded part) go to every task; a text's other words are joined to
the table by a shuffle, and the transitions at their places are added after it.
What the words' sizes decide is only where they are looked up.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm.common import heaviest, materialise

END = b"\n"  # no word can hold white space
SMOOTH = 0.5
#: Texts are read in stretches of about so many bytes.
STRETCH = 2_000_000
SWEEP_TASKS = 32
_WORDS_AT_ONCE = 2_000
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
_ENDING = 3
#: A writer's options for rows of about 1 MB: a row group and a page hold a few, since a task reads and writes them whole.
_LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
               "parquet.block.size": str(4 << 20)}


@dataclass(frozen=True)
class Settings:
    """hot_words: words sent to every task; min_count: words seen as often are clustered;
    sweeps: exchange rounds among the top words; least_top, least_classes: numbers a small
    corpus has; endings: endings sent to every task."""

    hot_words: int = 200_000
    min_count: int = 5
    sweeps: int = 6
    least_top: int = 2_000
    least_classes: int = 48
    endings: int = 50_000

    def classes_of(self, clustered: int) -> int:
        """Classes for so many clustered words: they grow with the cube root."""
        return max(self.least_classes, math.ceil(1.2 * clustered ** (1 / 3)))

    def top_of(self, clustered: int) -> int:
        """Words exchanged in sweeps: they grow with the square root."""
        return min(self.hot_words, max(self.least_top, int(8 * clustered ** 0.5)))


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, then one end."""
    words = text.lower().split() if text else []
    words.append(END)
    return words


def first_class(word: bytes, classes: int) -> int:
    """The class a word begins in."""
    return crc32(word[-_ENDING:]) % classes


class _Local(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


@dataclass
class _Stream:
    """Tokens of some texts: ``ids`` (numbers into ``words``; the first is the token before them) and,
    for each token after that, the text it belongs to."""

    words: list[bytes]
    ids: np.ndarray
    text: np.ndarray


def streams(texts: Iterable[bytes | None]) -> Iterator[_Stream]:
    """The tokens of all texts in order, an end after each, in streams of bounded size."""
    local, last = _Local(), END
    ids, text_of, size, some = [np.array([local[last]])], [], 0, False

    def stream() -> _Stream:
        return _Stream(list(local), np.concatenate(ids), np.concatenate(text_of))

    for i, text in enumerate(texts):
        text = text or b""
        at = 0
        while True:
            stop = len(text)
            if stop - at > STRETCH and (cut := _SPACE.search(text, at + STRETCH)):
                stop = cut.start()
            tokens = text[at:stop].lower().split()
            done = stop == len(text)
            if done:
                tokens.append(END)
            ids.append(np.fromiter(map(local.__getitem__, tokens), dtype=np.int64, count=len(tokens)))
            text_of.append(np.full(len(tokens), i, dtype=np.int64))
            last = tokens[-1] if tokens else last
            size += stop - at
            some = some or bool(tokens)
            at = stop
            if size >= STRETCH and some:
                yield stream()
                local = _Local()
                ids, text_of, size, some = [np.array([local[last]])], [], 0, False
            if done:
                break
    if some:
        yield stream()


def _id_type(words: int) -> str:
    return "<u2" if words <= 1 << 16 else "<u4"


def stream_table(docs: DataFrame, text_col: str) -> DataFrame:
    """The streams of all texts as a written table: words (binary, a blank between two), ids (binary numbers of
    ``_id_type``; the first is the token before the stream).

    A stream is two flat values, so that only the one at hand is held word by word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A text is copied out of its batch only when it is read.
            for s in streams(t.as_py() for t in batch.column("t")):
                yield pa.RecordBatch.from_arrays([pa.array([b" ".join(s.words)], pa.binary()), pa.array(
                    [s.ids.astype(_id_type(len(s.words))).tobytes()], pa.binary())], names=["words", "ids"])

    rows = docs.select(F.col(text_col).cast("binary").alias("t"))
    return materialise(rows.mapInArrow(run, "words binary, ids binary"), "lm_streams", **_LARGE_ROWS)


def _stored(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    for pdf in batches:
        for joined, ids in zip(pdf["words"], pdf["ids"]):
            words = joined.split(b" ")
            yield words, np.frombuffer(ids, dtype=_id_type(len(words))).astype(np.int64)


def count_words(table: DataFrame) -> DataFrame:
    """(word binary, c): counts of all tokens of a stream table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for words, ids in _stored(batches):
            c = np.bincount(ids[1:], minlength=len(words))
            there = np.flatnonzero(c)
            yield pd.DataFrame({"word": [words[i] for i in there], "c": c[there]})

    return table.mapInPandas(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Lexicon:
    """Hot words, most frequent first, with counts and (once known) classes; the lookup is built once per worker."""

    def __init__(self, words: list[bytes], counts: np.ndarray, classes: np.ndarray | None = None):
        self.words, self.counts, self.classes = words, counts, classes
        self._rank: dict[bytes, int] | None = None

    def __getstate__(self):
        return self.__dict__ | {"_rank": None}

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each hot word, -1 of the others (and of the end)."""
        if self._rank is None:
            self._rank = {w: i for i, w in enumerate(self.words)}
        return np.fromiter((self._rank.get(w, -1) for w in words), dtype=np.int64, count=len(words))


def count_bigrams(table: DataFrame, lexicon, top: int, classes: int) -> DataFrame:
    """(a, b, c): counts of neighbouring symbols in a stream table; an end precedes every text.

    Symbols: the ranks of the top words, then the first classes of the others, then the end.
    """
    end = top + classes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for words, ids in _stored(batches):
            rank = lexicon.value.ranks(words)
            symbol = np.array([r if 0 <= r < top else end if w == END else top + first_class(w, classes)
                               for w, r in zip(words, rank.tolist())], dtype=np.int64)[ids]
            pair, c = np.unique(symbol[:-1] * (end + 1) + symbol[1:], return_counts=True)
            yield pd.DataFrame({"a": pair // (end + 1), "b": pair % (end + 1), "c": c})

    return table.mapInPandas(run, "a int, b int, c long").groupBy("a", "b").agg(F.sum("c").alias("c"))


def class_matrix(bigrams: DataFrame, class_of: np.ndarray, n: int) -> np.ndarray:
    """Class bigram counts; at most n * n sums reach the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = np.zeros(n * n, dtype=np.int64)
        for pdf in batches:
            np.add.at(m, class_of[pdf["a"].to_numpy()] * n + class_of[pdf["b"].to_numpy()], pdf["c"].to_numpy())
        at = np.flatnonzero(m)
        yield pd.DataFrame({"cell": at, "c": m[at]})

    return _summed(bigrams.mapInPandas(run, "cell int, c long"), n)


def _summed(cells: DataFrame, n: int) -> np.ndarray:
    out = np.zeros(n * n)
    for r in cells.groupBy("cell").agg(F.sum("c").alias("c")).collect():
        out[r["cell"]] = r["c"]
    return out.reshape(n, n)


def _phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(m: np.ndarray) -> float:
    """What the classes contribute to the log likelihood of the corpus."""
    return float(_phi(m).sum() - _phi(m.sum(axis=1)).sum() - _phi(m.sum(axis=0)).sum())


def exchange_gain(m: np.ndarray, own: int, right: np.ndarray, left: np.ndarray, loops: float, classes: int,
                  sums: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Change of the likelihood when a word moves from class ``own`` to each class.

    right, left: counts of the classes after and before the word, without its
    ``loops`` repetitions of itself. Only the classes that neighbour the word are
    looked at. ``sums``: those of the rows and columns of ``m``, if known.
    """
    rows, cols = sums if sums is not None else (m.sum(axis=1), m.sum(axis=0))
    after, before = np.flatnonzero(right), np.flatnonzero(left)
    # The matrix without the word, at the columns after it and the rows before it.
    a, b = m[:, after].copy(), m[before, :].copy()
    a[own] -= right[after]
    a[:, after == own] -= left[:, None]
    a[own, after == own] -= loops
    b[:, own] -= left[before]
    b[before == own, :] -= right
    b[before == own, own] -= loops
    k = np.arange(classes)
    diag = m[k, k].copy()
    diag[own] -= right[own] + left[own] + loops
    # Its neighbours keep their own counts wherever the word goes.
    rows, cols = rows[k].copy(), cols[k].copy()
    rows[own] -= right.sum() + loops
    cols[own] -= left.sum() + loops
    added = (_phi(a[:classes] + right[after]) - _phi(a[:classes])).sum(axis=1)
    added += (_phi(b[:, :classes] + left[before, None]) - _phi(b[:, :classes])).sum(axis=0)
    added -= _phi(diag + right[k]) + _phi(diag + left[k]) - 2 * _phi(diag)
    added += _phi(diag + right[k] + left[k] + loops) - _phi(diag)
    added -= _phi(rows + right.sum() + loops) - _phi(rows)
    added -= _phi(cols + left.sum() + loops) - _phi(cols)
    return added - added[own]


def exchange_gains(m: np.ndarray, own: np.ndarray, right: np.ndarray, left: np.ndarray, loops: np.ndarray,
                   classes: int) -> np.ndarray:
    """``exchange_gain`` of many words at once: a row per word, in a few steps over whole arrays."""
    rows, cols = m.sum(axis=1)[:classes], m.sum(axis=0)[:classes]
    w = np.arange(len(own))
    own_diag = m[own, own] - right[w, own] - left[w, own] - loops
    diag = np.broadcast_to(m[np.arange(classes), np.arange(classes)], (len(own), classes)).copy()
    diag[w, own] = own_diag
    r, el = right[:, :classes], left[:, :classes]
    added = _side(m, own, right, left, own_diag, classes) + _side(m.T, own, left, right, own_diag, classes)
    added -= _phi(diag + r) + _phi(diag + el) - 2 * _phi(diag)
    added += _phi(diag + r + el + loops[:, None]) - _phi(diag)
    for sums, counts in ((rows, right), (cols, left)):
        n = counts.sum(axis=1) + loops
        without = np.broadcast_to(sums, (len(own), classes)).copy()
        without[w, own] -= n
        added -= _phi(without + n[:, None]) - _phi(without)
    return added - added[w, own][:, None]


def _side(m: np.ndarray, own: np.ndarray, right: np.ndarray, left: np.ndarray, own_diag: np.ndarray,
          classes: int) -> np.ndarray:
    """[word, class k]: what the word's counts ``right`` add to row k of the matrix without the word."""
    w = np.arange(len(own))
    out = np.zeros((len(own), classes))
    word, col = np.nonzero(right)
    if len(word):
        # Rare words have few different counts, so the logarithms are taken once per column and count.
        n = right[word, col]
        key, which = np.unique(col * (n.max() + 1) + n, return_inverse=True)
        cols, counts = (key // (n.max() + 1)).astype(np.int64), key % (n.max() + 1)
        base = m[:classes, cols].T
        each = _phi(base + counts[:, None]) - _phi(base)
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[starts]] = np.add.reduceat(each[which], starts, axis=0)
    # The column of the word's own class lacks its counts on the other side,
    at = np.flatnonzero(right[w, own])
    n = right[at, own[at]][:, None]
    column = m[:classes, own[at]].T
    less = column - left[at, :classes]
    out[at] += _phi(less + n) - _phi(less) - _phi(column + n) + _phi(column)
    # and the row of its own class lacks them all.
    row = m[own]
    back = _phi(row) - _phi(row - right)
    back[w, own] = _phi(own_diag + right[w, own]) - _phi(own_diag)
    out[w, own] = back.sum(axis=1)
    return out


def exchange_top(bigrams: DataFrame, words: int, top: int, classes: int, sweeps: int) -> tuple[np.ndarray, np.ndarray]:
    """(class of every symbol, class bigram counts). The ``words`` top words start in rounds by rank; in each
    sweep half of them may move to their best class, and a sweep that lowers the likelihood is undone."""
    n = classes + 1
    class_of = np.concatenate([np.arange(top) % classes, np.arange(n)])
    m = class_matrix(bigrams, class_of, n)
    if not words:
        return class_of, m
    # Every bigram from the side of its first and of its second symbol.
    sides = bigrams.select(F.col("a").alias("word"), F.col("b").alias("other"), F.lit(1).alias("after"), "c").union(
        bigrams.select(F.col("b").alias("word"), F.col("a").alias("other"), F.lit(0).alias("after"), "c"))
    sides = materialise(sides.filter(F.col("word") < words).withColumn("deal", (F.col("word") / 32).cast("int")),
                        "bigram_sides")

    def best_moves(class_of: np.ndarray, m: np.ndarray):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            word, other, after, c = (pdf[x].to_numpy() for x in ("word", "other", "after", "c"))
            cls, is_after, is_own = class_of[other], after == 1, other == word
            words, place = np.unique(word, return_inverse=True)
            right, left, loops = np.zeros((len(words), n)), np.zeros((len(words), n)), np.zeros(len(words))
            np.add.at(right, (place[is_after & ~is_own], cls[is_after & ~is_own]), c[is_after & ~is_own])
            np.add.at(left, (place[~is_after & ~is_own], cls[~is_after & ~is_own]), c[~is_after & ~is_own])
            np.add.at(loops, place[is_after & is_own], c[is_after & is_own])
            gain = exchange_gains(m, class_of[words], right, left, loops, classes)
            best = gain.argmax(axis=1)
            found = [(int(words[i]), int(best[i]), float(gain[i, best[i]])) for i in np.flatnonzero(gain.max(axis=1) > 1e-6)]
            return pd.DataFrame(found, columns=["word", "to", "gain"])

        return run

    score = likelihood(m)
    for sweep in range(sweeps):
        # A set number of tasks: there is little data and much to compute.
        moves = sides.filter(F.col("word") % 2 == sweep % 2).repartition(SWEEP_TASKS, "deal").groupBy("deal").applyInPandas(
            best_moves(class_of, m), "word int, to int, gain double").collect()  # a row per top word at most
        moves.sort(key=lambda r: (-r["gain"], r["word"]))
        while moves:
            tried = class_of.copy()
            for r in moves:
                tried[r["word"]] = r["to"]
            tried_m = class_matrix(bigrams, tried, n)
            if likelihood(tried_m) > score:
                class_of, m, score = tried, tried_m, likelihood(tried_m)
                break
            moves = moves[:len(moves) // 4]  # moves made at once can undo each other: keep the strongest
    return class_of, m


def exchange_rest(table: DataFrame, lexicon, class_of_top: np.ndarray, m: np.ndarray, classes: int,
                  min_count: int) -> DataFrame:
    """(word, class) of every word outside the top that occurs ``min_count`` times: its best class, given those of all words now.

    The classes of a word's neighbours meet in a shuffle by word (four bytes an
    occurrence, packed per stream) and are read as a stream, so no word's
    occurrences are held at once.
    """
    top, n = len(class_of_top), classes + 1
    itself = 0xFFFF         # a word beside itself: the neighbour moves along

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for words, ids in _stored(batches):
            rank = lexicon.value.ranks(words)
            of = np.array([class_of_top[r] if 0 <= r < top else classes if w == END else first_class(w, classes)
                           for w, r in zip(words, rank.tolist())], dtype=np.int64)
            tail = np.array([not 0 <= r < top and w != END for w, r in zip(words, rank.tolist())])
            cls, same = of[ids], ids[:-1] == ids[1:]
            packed = []
            # The token before the stream has its neighbour on the right here, that on the left is in the stream before.
            for at, beside in ((ids[1:], np.where(same, itself, cls[:-1])), (ids[:-1], np.where(same, itself, cls[1:]))):
                chosen = tail[at]
                order = np.argsort(at[chosen], kind="stable")
                packed.append((beside[chosen][order].astype("<u2").tobytes(),
                               np.concatenate([[0], np.cumsum(np.bincount(at[chosen], minlength=len(words)))]) * 2))
            (before, i), (after, j) = packed
            there = np.flatnonzero(tail)
            yield pd.DataFrame({"word": [words[w] for w in there.tolist()],
                                "before": [before[i[w]:i[w + 1]] for w in there.tolist()],
                                "after": [after[j[w]:j[w + 1]] for w in there.tolist()]})

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The counts of the last word of a batch wait for the next: it may go on there.
        waiting: tuple[bytes, np.ndarray] | None = None

        def moves(words: list[bytes], counts: np.ndarray) -> Iterator[pd.DataFrame]:
            """``counts``: [word, side, class]; the last class is the word itself."""
            often = np.flatnonzero(counts[:, 0].sum(axis=1) >= min_count)
            for at in range(0, len(often), _WORDS_AT_ONCE):
                some = often[at:at + _WORDS_AT_ONCE]
                names = [words[i] for i in some.tolist()]
                own = np.array([first_class(w, classes) for w in names], dtype=np.int64)
                left, right = counts[some, 0], counts[some, 1]
                gain = exchange_gains(m, own, right[:, :n], left[:, :n], right[:, n], classes)
                yield pd.DataFrame({"word": names, "class": gain.argmax(axis=1)})

        for pdf in batches:
            if not len(pdf):
                continue
            rows = pdf["word"].tolist()
            first = np.fromiter((i == 0 or rows[i] != rows[i - 1] for i in range(len(rows))), dtype=bool, count=len(rows))
            words, place = [rows[i] for i in np.flatnonzero(first).tolist()], np.cumsum(first) - 1
            counts = np.zeros((len(words), 2, n + 1))
            for side, name in enumerate(("before", "after")):
                beside = pdf[name].tolist()
                raw = np.frombuffer(b"".join(beside), dtype="<u2").astype(np.int64)
                of = np.repeat(place, np.fromiter(map(len, beside), dtype=np.int64, count=len(beside)) // 2)
                counts[:, side] = np.bincount(of * (n + 1) + np.minimum(raw, n), minlength=len(words) * (n + 1)).reshape(-1, n + 1)
            if waiting is not None:
                if waiting[0] == words[0]:
                    counts[0] += waiting[1]
                else:
                    yield from moves([waiting[0]], waiting[1][None])
            waiting = words[-1], counts[-1].copy()
            yield from moves(words[:-1], counts[:-1])
        if waiting is not None:
            yield from moves([waiting[0]], waiting[1][None])

    return table.mapInPandas(gather, "word binary, before binary, after binary").repartition(
        F.col("word")).sortWithinPartitions("word").mapInPandas(best, "word binary, class int")


class _Guess(dict):
    """Ending -> class of words without one of their own."""

    def __init__(self, of: dict[bytes, int], other: int):
        super().__init__(of)
        self.other = other

    def __missing__(self, ending: bytes) -> int:
        return self.other


_COLD = "words array<binary>, guess array<int>, pairs binary"


def _classes_in(words: list[bytes], ids: np.ndarray, lexicon: Lexicon, end: int, guess: _Guess):
    """(rank of every word, class of every token or -1 - index of a cold word, the cold words, their guesses)."""
    rank = lexicon.ranks(words)
    of = np.full(len(words), -1, dtype=np.int64)
    of[rank >= 0] = lexicon.classes[rank[rank >= 0]]
    of[[i for i, w in enumerate(words) if w == END]] = end
    code = of[ids]
    which, place = np.unique(ids[code < 0], return_inverse=True)
    code[code < 0] = -1 - place
    cold = [words[i] for i in which.tolist()]
    return rank, code, cold, [guess[w[-_ENDING:]] for w in cold]


def _with_cold(parts: DataFrame, table: DataFrame) -> DataFrame:
    """Written parts with ``class`` and ``c``, class and count of their cold words in order: the words are joined to the whole table."""
    # The number is fixed by being written.
    parts = materialise(parts.withColumn("part", F.monotonically_increasing_id()), "lm_parts", **_LARGE_ROWS)
    cold = parts.select("part", F.posexplode(F.arrays_zip("words", "guess")).alias("at", "w")).select(
        "part", "at", F.col("w.words").alias("word"), F.col("w.guess").alias("guess"))
    cold = cold.join(table, "word", "left").groupBy("part").agg(F.array_sort(F.collect_list(F.struct(
        "at", F.coalesce("class", "guess").alias("class"), F.coalesce("c", F.lit(0)).alias("c")))).alias("cold"))
    return parts.drop("words", "guess").join(
        cold.select("part", F.col("cold.class").alias("class"), F.col("cold.c").alias("c")), "part", "left").drop("part")


def _pairs_of(pairs: bytes, cold) -> np.ndarray:
    """Pairs of classes, those of the cold words put in."""
    pair = np.frombuffer(pairs, dtype="<i4").reshape(-1, 2).astype(np.int64)
    return np.where(pair < 0, np.asarray(cold, dtype=np.int64)[-1 - np.minimum(pair, -1)], pair) if len(pair) else pair


def _transition_counts(streams_of: DataFrame, lexicon, guess, table: DataFrame, classes: int) -> np.ndarray:
    """Class bigram counts of a stream table; at most (classes + 1)^2 sums reach the driver."""
    n = classes + 1

    def known(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for words, ids in _stored(batches):
            _, code, cold, guesses = _classes_in(words, ids, lexicon.value, classes, guess.value)
            x, y = code[:-1], code[1:]
            some = (x < 0) | (y < 0)
            cell, c = np.unique(x[~some] * n + y[~some], return_counts=True)
            yield pd.DataFrame({"words": [cold], "guess": [guesses], "pairs": [np.stack([x[some], y[some]], axis=1).astype("<i4").tobytes()],
                                "cells": [np.stack([cell, c]).astype("<i8").tobytes()]})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = np.zeros(n * n, dtype=np.int64)
        for pdf in batches:
            for cells, pairs, cold in zip(pdf["cells"], pdf["pairs"], pdf["class"]):
                cell, c = np.frombuffer(cells, dtype="<i8").reshape(2, -1)
                m[cell] += c
                pair = _pairs_of(pairs, cold)
                m += np.bincount(pair[:, 0] * n + pair[:, 1], minlength=n * n)
        at = np.flatnonzero(m)
        yield pd.DataFrame({"cell": at, "c": m[at]})

    parts = _with_cold(streams_of.mapInPandas(known, _COLD + ", cells binary"), table)
    return _summed(parts.mapInPandas(count, "cell int, c long"), n)


class BrownModel:
    """``table``: every word of the training texts with count and class; log probabilities by class."""

    def __init__(self, settings: Settings, table: DataFrame, train_tokens: int, vocabulary: int, ends: int, lexicon,
                 guess, classes: int, counts: np.ndarray, emission_base: np.ndarray):
        self.settings, self.table, self.train_tokens = settings, table, train_tokens
        self.vocabulary, self.ends, self.lexicon, self.guess = vocabulary, ends, lexicon, guess
        self.classes, self.counts, self.emission_base = classes, counts, emission_base
        self.transitions = np.log10((counts + SMOOTH) / (counts.sum(axis=1, keepdims=True) + SMOOTH * (classes + 1)))


def _table_of(spark: SparkSession, schema: str, keys: list[bytes], numbers) -> DataFrame:
    names = [f.split(" ")[0] for f in schema.split(", ")]
    return spark.createDataFrame(pa.table([pa.array(keys, pa.binary()), pa.array(numbers, pa.int32())], names=names), schema)


def _ending() -> Column:
    return F.expr(f"substring(word, -{_ENDING}, {_ENDING})")


def train(docs: DataFrame, text_col: str = "text", settings: Settings = Settings()) -> BrownModel:
    """Learn from all of ``docs`` (null texts are empty; repeated rows count as often as given; extra columns are ignored)."""
    s, spark = settings, docs.sparkSession
    sc = spark.sparkContext
    tokens = stream_table(docs, text_col)
    counts = materialise(count_words(tokens), "word_counts")
    is_end = F.col("word") == F.lit(END)
    whole = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(is_end, F.col("c"))).alias("ends"),
                       F.count_if(~is_end & (F.col("c") >= s.min_count)).alias("clustered")).first()
    total, vocabulary, ends = whole["n"] or 0, whole["v"], whole["ends"] or 0
    classes, top = s.classes_of(whole["clustered"]), s.top_of(whole["clustered"])

    # The top words in sweeps.
    words_only = counts.filter(~is_end)
    hot = sorted(((bytes(r["word"]), r["c"]) for r in heaviest(words_only, "c", s.hot_words, "word").collect()),
                 key=lambda x: (-x[1], x[0]))
    words = [w for w, _ in hot]
    hot_counts = np.array([c for _, c in hot], dtype=np.int64)
    ranked = sc.broadcast(Lexicon(words, hot_counts))
    often = int((hot_counts >= s.min_count).sum())
    top = min(top, often)
    bigrams = materialise(count_bigrams(tokens, ranked, top, classes), "class_bigrams")
    class_of, m = exchange_top(bigrams, top, top, classes, s.sweeps)
    class_of_top = class_of[:top]

    # All other words.
    moved = exchange_rest(tokens, ranked, class_of_top, m, classes, s.min_count)
    # Small tables are made of Arrow columns: from Python rows they would take a second set of Python workers.
    tops = _table_of(spark, "word binary, class int", words[:top], class_of_top)
    clustered = materialise(words_only.join(moved.union(tops), "word", "left"), "word_classes")
    votes = clustered.filter(F.col("class").isNotNull()).groupBy(_ending().alias("ending"), "class").agg(
        F.sum("c").alias("c")).groupBy("ending").agg(F.max(F.struct("c", (-F.col("class")).alias("k"))).alias("b")).select(
        "ending", F.col("b.c").alias("c"), (-F.col("b.k")).alias("class"))
    endings = heaviest(votes, "c", s.endings, "ending").select("ending", "class").collect()
    spread = clustered.filter(F.col("class").isNotNull()).groupBy("class").agg(F.count(F.lit(1)).alias("k")).collect()
    other = min(((-r["k"], r["class"]) for r in spread), default=(0, 0))[1]     # the class of most words
    guess = sc.broadcast(_Guess({bytes(r["ending"]): r["class"] for r in endings}, other))
    by_ending = _table_of(spark, "ending binary, guess int", [bytes(r["ending"]) for r in endings], [r["class"] for r in endings])
    table = clustered.withColumn("ending", _ending()).join(F.broadcast(by_ending), "ending", "left").select(
        "word", "c", F.coalesce("class", "guess", F.lit(other)).alias("class"))

    size, kinds = np.zeros(classes + 1), np.zeros(classes + 1)
    for r in table.groupBy("class").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("k")).collect():
        size[r["class"]], kinds[r["class"]] = r["c"], r["k"]
    # log10 of what an emission is divided by; the end is the only token of its class.
    emission_base = np.log10(size + SMOOTH * (kinds + 1))
    emission_base[classes] = 0.0
    wanted = F.broadcast(_table_of(spark, "word binary, rank int", words, range(len(words))))
    hot_classes = np.zeros(len(words), dtype=np.int64)
    for r in table.join(wanted, "word").select("rank", "class").collect():      # a row per hot word
        hot_classes[r["rank"]] = r["class"]
    lexicon = sc.broadcast(Lexicon(words, hot_counts, hot_classes))
    transitions = _transition_counts(tokens, lexicon, guess, table, classes)
    return BrownModel(s, table, total, vocabulary, ends, lexicon, guess, classes, transitions, emission_base)


def score(model: BrownModel, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_tokens, n_known, train_tokens, base_score, score.

    base_score is the unigram log10 probability, score that of the class
    model; both include the end. Null and empty texts have the end only.
    Repeated rows and null ids come back as they are; extra columns are
    ignored; very long texts are read in stretches.
    """
    classes, lexicon, guess = model.classes, model.lexicon, model.guess
    shared = docs.sparkSession.sparkContext.broadcast((model.transitions, model.emission_base))
    figures = "row long, id string, n_tokens long, n_known long, seen double, score double"
    packed = np.dtype([("row", "<i8"), ("n_tokens", "<i8"), ("n_known", "<i8"), ("seen", "<f8"), ("score", "<f8")])

    def hot(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row per stream: what hot words give to each of its texts, and where the cold ones are."""
        between, base = shared.value
        log_counts = np.log10(np.append(lexicon.value.counts, 0) + SMOOTH)
        for pdf in batches:
            row_of, id_of = pdf["row"].to_numpy(), pdf["id"].tolist()
            for s in streams(pdf["t"].tolist()):
                rank, code, cold, guesses = _classes_in(s.words, s.ids, lexicon.value, classes, guess.value)
                x, y = code[:-1], code[1:]
                some = (x < 0) | (y < 0)
                first, n = int(s.text[0]), int(s.text[-1] - s.text[0]) + 1
                text = s.text - first
                gain = np.zeros(len(y))
                gain[~some] = between[x[~some], y[~some]]
                gain[y >= 0] -= base[y[y >= 0]]
                known = rank[s.ids[1:]]
                out = np.zeros(n, dtype=packed)
                out["row"] = row_of[first:first + n]
                out["n_tokens"] = np.bincount(text, minlength=n)
                out["n_known"] = np.bincount(text, known >= 0, n)
                out["seen"] = np.bincount(text, np.where(known >= 0, log_counts[known], 0.0), n)
                out["score"] = np.bincount(text, gain, n)
                yield pd.DataFrame({
                    "words": [cold], "guess": [guesses], "pairs": [np.stack([x[some], y[some]], axis=1).astype("<i4").tobytes()],
                    "at": [text[some].astype("<i4").tobytes()],
                    "tokens": [np.stack([-1 - y[y < 0], text[y < 0]]).astype("<i4").tobytes()],
                    "texts": [out.tobytes()], "ids": [id_of[first:first + n]]})

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        between, base = shared.value
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                out = np.frombuffer(r.texts, dtype=packed).copy()
                if len(r.pairs):
                    of, c = np.asarray(r.cold, dtype=np.int64), np.asarray(r.c, dtype=np.float64)
                    pair, n = _pairs_of(r.pairs, of), len(out)
                    word, text = np.frombuffer(r.tokens, dtype="<i4").reshape(2, -1)
                    out["score"] += np.bincount(np.frombuffer(r.at, dtype="<i4"), between[pair[:, 0], pair[:, 1]], n)
                    out["score"] -= np.bincount(text, base[of[word]], n)
                    out["seen"] += np.bincount(text, np.log10(c[word] + SMOOTH), n)
                    out["n_known"] += np.bincount(text, c[word] > 0, n).astype(np.int64)
                yield pd.DataFrame({name: out[name] for name in packed.names}).assign(id=list(r.ids))[
                    [f.split(" ")[0] for f in figures.split(", ")]]

    rows = docs.select(F.col(text_col).cast("binary").alias("t"), F.col(id_col).cast("string").alias("id"),
                       F.monotonically_increasing_id().alias("row"))
    parts = _with_cold(rows.mapInPandas(hot, _COLD + ", at binary, tokens binary, texts binary, ids array<string>"), model.table)
    figures_of = parts.withColumnRenamed("class", "cold").mapInPandas(whole, figures).groupBy("row").agg(
        F.max("id").alias("id"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "seen", "score")))
    total, ends = model.train_tokens, model.ends
    base = float(np.log10(total + SMOOTH * (model.vocabulary + 1)))
    return figures_of.select(
        F.col("id").cast("long").alias(id_col), "n_tokens", (F.col("n_known") + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("seen") + F.lit(float(np.log10(ends + SMOOTH))) - F.lit(base) * F.col("n_tokens")).alias("base_score"),
        (F.col("score") + F.col("seen")).alias("score"))
