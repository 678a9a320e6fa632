"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Best-fit decreasing looks at nothing but lengths, and documents of one length
are alike to it. So the whole corpus is packed from its histogram of lengths
(at most ``capacity`` counts, whatever the corpus holds): per length, longest
first, a segment tree over the remaining capacities finds the tightest
sequences that still fit in logarithmic time, and as many documents as go
there are placed at once. The sequences are those the method gives when it
takes the documents one by one; nothing is packed per task or left over
between tasks.

The outcome is a short list of runs: documents number ``a`` to ``b`` of a
length go to sequences ``s``, ``s + 1``, ... A document's number among those of
its length is its number within the task that tokenised it plus the counts of
the tasks before; no rows are sorted or gathered for it.
"""

from __future__ import annotations

import functools
import os
import re
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.common import materialise

CAPACITY = 4096
END_ID = 1
#: Texts are tokenised in stretches of about so many characters, cut at spaces.
STRETCH = 4_000_000
_CACHED_WORDS = 500_000
#: Latin letters and all of ASCII (but for the two that special tokens begin with, and the dotted I):
#: lower case is letter by letter, and nothing is to be composed.
_SIMPLE = re.compile("[^\u0130\u0250-\U0010ffff<|]*").fullmatch
#: Marks that end a word; see WordIds.
_MARKS = ".,;:!?"
_OUT_BYTES = 8_000_000

_PIECES = "doc_id {id_type}, piece int, start long, length int, ids binary, task int, number long"


class _Known(dict):
    """A dict of bounded size: when it is full its entries become the old ones, and
    those asked for again come back."""

    old: dict = {}

    def lacking(self, keys: set[str], bound: int) -> set[str]:
        """Make room, and give the keys that are not known; the others are there now."""
        new = [k for k in keys if k not in self]    # a set minus a dict's keys would walk all of the dict
        if len(self) + len(new) > bound:
            self.old, new = dict(self), list(keys)
            self.clear()
        if not self.old:
            return set(new)
        back = {k: self.old[k] for k in new if k in self.old}
        self.update(back)
        return {k for k in new if k not in back}


class WordIds:
    """Token ids (little-endian uint32) of texts, word by word.

    The vocabulary's pre-tokeniser never joins characters across white space and
    drops that, so a text's ids are those of the stretches between
    spaces in order. Nor does it join a letter or digit and the marks ``.,;:!?``
    after it, and it lowers case first; so a word not met before
    is the ids of its lower-cased stem and those of its marks. Known words, a bounded
    number, stay with the worker.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks already use all cores
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self._encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        vocabulary = tokenizer.get_vocab()
        ends = [i for token, i in vocabulary.items() if token.endswith("</w>")]
        self._ends = None       # which ids end a word, if the vocabulary marks that
        if ends:
            self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self._ends[ends] = True
        self._words, self._stems = _Known(), _Known()

    def _learn(self, words: set[str]) -> None:
        """Enter words: stem and marks of each, encoding the stems not known."""
        words, lower, marked = list(words), [], []
        for i, word in enumerate(words):
            stem = word.rstrip(_MARKS)
            if len(stem) < len(word):
                if stem[-1:].isalnum():
                    marked.append((i, word[len(stem):]))
                else:
                    stem = word
            lower.append(stem.lower() if stem.isascii() and stem.isalpha() or _SIMPLE(stem) else stem)
        stems = self._stems
        fresh = stems.lacking({*lower, *(marks for _, marks in marked)}, _CACHED_WORDS)
        plain = [stem for stem in fresh if stem.isalpha() and (stem.isascii() or _SIMPLE(stem))] if self._ends is not None else []
        if plain and (ids := self._encode_together(plain)):
            stems.update(zip(plain, ids))
            fresh.difference_update(plain)
        fresh = list(fresh)
        for stem, encoded in zip(fresh, self._encode(fresh, add_special_tokens=False)):
            stems[stem] = array("I", encoded.ids).tobytes()
        known = self._words
        known.update(zip(words, map(stems.__getitem__, lower)))
        for i, marks in marked:
            known[words[i]] += stems[marks]

    def _encode_together(self, words: list[str]) -> list[bytes] | None:
        """Ids of words of letters only, encoded as one text: each ends with the next token that
        ends a word. None if there are not as many ends as words."""
        ids = np.array(self._encode([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = (np.flatnonzero(self._ends[ids]) + 1) * 4
        if len(ends) != len(words) or len(ids) * 4 != ends[-1]:
            return None
        raw, ends = ids.tobytes(), ends.tolist()
        return [raw[start:end] for start, end in zip([0, *ends], ends)]

    def of(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each whole text, in order."""
        group: list[tuple[list[str], bool]] = []     # (words of a stretch, whether it ends its text)
        chars = 0
        held: list[bytes] = []

        def ids() -> Iterator[bytes]:
            new = self._words.lacking(set().union(*(words for words, _ in group)), _CACHED_WORDS)
            if new:
                self._learn(new)
            for words, last in group:
                held.append(b"".join(map(self._words.__getitem__, words)))
                if last:
                    yield b"".join(held)
                    held.clear()

        for text in texts:
            text = (text or "").replace("\n", " ")
            at, n = 0, len(text)
            while True:
                stop = n if n - at <= STRETCH else text.find(" ", at + STRETCH)
                stop = n if stop < 0 else stop
                group.append((text[at:stop].split(" "), stop == n))
                chars += stop - at
                at = stop + 1
                if chars >= STRETCH:
                    yield from ids()
                    group, chars = [], 0
                if stop == n:
                    break
        yield from ids()


@functools.cache
def word_ids(path: str) -> WordIds:
    """One per worker process."""
    return WordIds(path)


def tokenise(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
             end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of a document: its ids, cut after every ``capacity``.

    ``tokenizer``: path of a vocabulary file that every worker can read; its
    pre-tokeniser must part words at spaces and drop them. Columns: doc_id,
    piece (from 0), start (the document's ids before it), length, ids (binary,
    little-endian uint32), and task, number: the piece is the number-th of its
    length in that task. A null text counts as empty; an empty text is the end
    id alone. Rows stay rows, whatever repeats or is null in ``id_col``; other
    columns are ignored. The result is a written table.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, task = word_ids(tokenizer), TaskContext.get().partitionId()
        end, step = int(end_id).to_bytes(4, "little"), 4 * capacity
        seen = np.zeros(capacity + 1, dtype=np.int64)
        rows, held = [], 0

        def flush():
            return pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids", "task", "number"]).astype(
                {"doc_id": object})

        for batch in batches:
            texts = batch["t"].tolist()
            of = dict(zip(dict.fromkeys(texts), words.of(list(dict.fromkeys(texts)))))     # copies are tokenised once
            for doc_id, text in zip(batch["i"].tolist(), texts):
                ids = of[text] + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    length = len(part) // 4
                    rows.append((doc_id, piece, at // 4, length, part, task, int(seen[length])))
                    seen[length] += 1
                    held += len(part) + 64
                    if held > _OUT_BYTES:
                        yield flush()
                        rows, held = [], 0
        if rows:
            yield flush()

    # The id goes through Python as text, so that a null among numbers does not turn them into floats.
    given = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    pieces = given.mapInPandas(run, _PIECES.format(id_type="string"))
    id_type = docs.select(id_col).schema[0].dataType
    return materialise(pieces.withColumn("doc_id", F.col("doc_id").cast(id_type)), "pieces")


class _Tightest:
    """Segment tree over remaining capacities: which of them some open sequence has."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.size)

    def set(self, capacity: int, there: bool) -> None:
        at = self.size + capacity
        self.any[at] = there
        while at > 1:
            at >>= 1
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def at_least(self, length: int) -> int | None:
        """The smallest capacity not below ``length`` that is there."""
        at = self.size + length
        if self.any[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


@dataclass
class Runs:
    """Documents ``first`` and on of ``length``: ``per_sequence`` of them into each
    sequence from ``sequence`` on, the first in each at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    per_sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the number-th document of each length."""
        # Runs are in order of (length descending, first): one search over both.
        wide = np.int64(1) << 48
        at = np.searchsorted(self.first - self.length * wide, number - length * wide, side="right") - 1
        i = number - self.first[at]
        per = self.per_sequence[at]
        return self.sequence[at] + i // per, self.offset[at] + i % per * length


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Runs:
    """Pack ``counts[length]`` documents of every length, as best-fit decreasing does.

    Of equally tight sequences the one that reached that capacity first is
    taken. A sequence taken for a length stays the tightest for it until
    no further document of that length fits, so it gets all of them at once.
    """
    open_at: dict[int, deque] = {}  # remaining capacity -> intervals (first sequence, how many)
    tree = _Tightest(capacity)
    runs, sequences = [], 0

    def leave(remaining: int, sequence: int, n: int) -> None:
        if n and remaining:
            waiting = open_at.setdefault(remaining, deque())
            waiting.append((sequence, n))
            if len(waiting) == 1:
                tree.set(remaining, True)

    for length in sorted(counts, reverse=True):
        left, first = counts[length], 0
        while left:
            room = tree.at_least(length)
            if room is None:
                room, sequence = capacity, sequences
                n = -(-left // (room // length))
                sequences += n
            else:
                sequence, n = open_at[room].popleft()
                if not open_at[room]:
                    tree.set(room, False)
            per = room // length
            placed = min(left, n * per)
            runs.append((length, first, sequence, per, capacity - room))
            full, rest = divmod(placed, per)
            leave(room - per * length, sequence, full)
            if rest:
                leave(room - rest * length, sequence + full, 1)
            if (unused := n - full - (rest > 0)) and room < capacity:
                open_at[room].appendleft((sequence + n - unused, unused))
                tree.set(room, True)
            left -= placed
            first += placed
    columns = np.array(runs, dtype=np.int64).reshape(-1, 5).T
    return Runs(*columns, sequences=sequences)


def _numbered(pieces: DataFrame) -> DataFrame:
    """Per task and length: how many pieces of that length the tasks before hold.

    A window over one length sees one row per task."""
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("task", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def place(pieces: DataFrame, capacity: int = CAPACITY, columns: tuple[str | Column, ...] = ()) -> DataFrame:
    """Where each piece of ``tokenise`` goes: doc_id, piece, start, length, task, number,
    sequence_id, offset, and ``columns`` of the pieces.

    Sequence numbers are dense from 0; within a sequence the pieces lie
    gapless from offset 0. No piece gives no row. What reaches the driver is
    one count per length; what goes to the tasks is the list of runs, whose
    number is bounded by the capacity and not by the corpus (some tens of
    thousands for 4,096).
    """
    spark = pieces.sparkSession
    tasks = materialise(_numbered(pieces), "piece_counts")
    counts = {r["length"]: r["n"] for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(best_fit_decreasing(counts, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = runs.value.find(length.to_numpy(np.int64), number.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    # A task and a length together hold at most what one task read, so no key of this join is hot.
    rows = pieces.select("doc_id", "piece", "start", "length", "task", "number", *columns).join(
        tasks.drop("n"), ["task", "length"])
    found = rows.withColumn("_at", find(F.col("length").cast("long"), F.col("before") + F.col("number")))
    return found.select(*(c for c in rows.columns if c != "before"), "_at.sequence_id", "_at.offset")


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (binary, at most ``capacity`` ids),
    doc_ids and offsets of the pieces in order.

    A sequence's group holds at most ``capacity`` pieces.
    """
    whole = placed.select("task", "length", "number", "sequence_id", "offset", "doc_id").join(
        pieces.select("task", "length", "number", "ids"), ["task", "length", "number"])
    parts = whole.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))
    return parts.select("sequence_id",
                        F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"),
                        F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"))
