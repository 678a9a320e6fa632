"""Language identification, word first with character n-gram backoff.

A word the model knows is scored by its log frequency in each language. An
unseen word is covered by the longest character n-grams the model knows,
falling back from ``max_n`` letters to one. The model is the whole table of
words and n-grams counted over all training documents. A bounded part of it
(those most typical of some language) goes to every task; a text's other words
are joined to the whole table.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import heaviest, materialise

UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")
_CACHE = 200_000  # unseen words whose score a task remembers


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    return _WORD.findall(text.lower()) if text else []


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked (a one-letter gram has no mark)."""
    if n == 1:
        return list(word)
    padded = f"^{word}$"
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


class _Rows(dict):
    """Row of each word's scores; an unseen word gets the next row on its first use."""

    def __init__(self, model: LanguageModel):
        super().__init__(model.words)
        self.model, self.known = model, len(model.words)
        self.scores = np.empty((self.known + _CACHE, len(model.languages)))
        self.scores[:self.known] = model.word_scores
        self.next = self.known

    def reserve(self, n: int) -> None:
        """Room for n unseen words; the remembered ones go when there is none."""
        if self.next + n > len(self.scores):
            self.clear()
            self.update(self.model.words)
            self.next = self.known
            if self.known + n > len(self.scores):
                self.scores = np.resize(self.scores, (self.known + n, self.scores.shape[1]))

    def __missing__(self, word: str) -> int:
        row = self[word] = self.next
        self.scores[row] = self.model.backoff(word)
        self.next += 1
        return row


@dataclass
class LanguageModel:
    """Log frequencies per language of known words and character n-grams."""

    languages: list[str]
    words: dict[str, int]             # row in word_scores
    word_scores: np.ndarray
    grams: dict[str, int]             # row in gram_scores
    gram_scores: np.ndarray
    max_n: int
    whole: bool = True                # whether the entries above are all there are
    table: DataFrame | None = None    # (n, gram, scores) of all entries; n is 0 for words

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("rows", "table")}

    @cached_property
    def rows(self) -> _Rows:
        return _Rows(self)

    def backoff(self, word: str) -> np.ndarray:
        """Mean over the places of a word of the longest known n-gram that starts there."""
        padded, known, found = f"^{word}$", self.grams.get, []
        for i in range(len(padded) - 1):
            for n in range(self.max_n, 0, -1):
                row = known(padded[i:i + n])
                if row is not None:
                    found.append(row)
                    break
            else:
                found.append(-1)  # the last row: a letter no language has
        return np.add.reduce(self.gram_scores[found], axis=0) / len(found)

    def missing(self, word: str) -> list[str]:
        """The n-grams of a word that are not here and longer than the one backoff finds at their place."""
        padded, out = f"^{word}$", set()
        for i in range(len(padded) - 1):
            for n in range(self.max_n, 0, -1):
                gram = padded[i:i + n]
                if gram in self.grams:
                    break
                out.add(gram)
        return list(out)

    def backoff_with(self, word: str, more: dict[str, np.ndarray]) -> np.ndarray:
        """:meth:`backoff` when the n-grams ``more`` are known too."""
        if not more:
            return self.backoff(word)
        padded, total = f"^{word}$", np.zeros(len(self.languages))
        for i in range(len(padded) - 1):
            scores = self.gram_scores[-1]
            for n in range(self.max_n, 0, -1):
                gram = padded[i:i + n]
                if gram in self.grams:
                    scores = self.gram_scores[self.grams[gram]]
                    break
                if gram in more:
                    scores = more[gram]
                    break
            total = total + scores
        return total / (len(padded) - 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its posterior; UNDETERMINED and 0 without a letter or a model."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        words = words_of(text)
        rows = self.rows
        rows.reserve(len(words))
        at = np.fromiter(map(rows.__getitem__, words), dtype=np.int64, count=len(words))
        total = rows.scores[at].sum(axis=0)
        p = np.exp(total - total.max())
        best = int(np.argmax(p))
        return self.languages[best], float(p[best] / p.sum())


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for lang, part in pdf.groupby("lang"):
            words: Counter = Counter()
            for text in part["text"]:
                words.update(words_of(text))
            if words:
                yield pd.DataFrame({"lang": lang, "gram": list(words), "c": list(words.values())})


def _count_grams(max_n: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                for size in range(1, max_n + 1):
                    grams: dict[str, int] = defaultdict(int)
                    for word, c in zip(part["gram"], part["c"]):
                        for g in grams_of(word, size):
                            grams[g] += c
                    if grams:
                        yield pd.DataFrame({"n": size, "lang": lang, "gram": list(grams), "c": list(grams.values())})

    return run


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = 100_000,
          max_grams: int = 50_000, max_n: int = 4) -> LanguageModel:
    """Count all of ``docs`` (null languages and texts aside).

    ``max_words`` and ``max_grams`` bound what goes to every task: the entries
    with the highest frequency in any one language. The others stay in the
    distributed ``table``.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter(
        "lang IS NOT NULL AND text IS NOT NULL")
    words = materialise(rows.mapInPandas(_count_words, "lang string, gram string, c long")
                        .groupBy("lang", "gram").agg(F.sum("c").alias("c")), "language_words")
    # N-grams of a word count as often as the word; each word is cut up once.
    grams = (words.mapInPandas(_count_grams(max_n), "n int, lang string, gram string, c long")
             .groupBy("n", "lang", "gram").agg(F.sum("c").alias("c")))
    counts = materialise(words.select(F.lit(0).alias("n"), "lang", "gram", "c").unionByName(grams), "language_counts")
    totals = {(r["n"], r["lang"]): (r["c"], r["v"]) for r in
              counts.groupBy("n", "lang").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()}
    languages = sorted({lang for _, lang in totals})
    if not languages:
        return LanguageModel([], {}, np.empty((0, 0)), {}, np.empty((0, 0)), max_n)
    sizes = counts.sparkSession.createDataFrame(
        [(n, lang, float(c)) for (n, lang), (c, _) in totals.items()], "n int, lang string, total double")
    per_entry = (counts.join(F.broadcast(sizes), ["n", "lang"])
                 .groupBy("n", "gram").agg(F.max(F.col("c") / F.col("total")).alias("top"),
                                           F.map_from_entries(F.collect_list(F.struct("lang", "c"))).alias("by_lang")))

    per_entry = materialise(per_entry, "language_entries")

    names = f"array({', '.join(_lit(lang) for lang in languages)})"
    size = np.array([[totals.get((n, lang), (0, 0))[0] for lang in languages] for n in range(max_n + 1)], dtype=float)
    kinds = np.array([max([v for (m, _), (_, v) in totals.items() if m == n], default=0) for n in range(max_n + 1)])

    def best(where: str, limit: int) -> tuple[dict[str, int], np.ndarray]:
        # The entries come as Arrow columns: rows of Python and of the JVM would fill the driver.
        found = heaviest(per_entry.filter(where), "top", limit).select("n", "gram", F.expr(
            f"transform(map_keys(by_lang), l -> CAST(array_position({names}, l) - 1 AS int))").alias("lang"),
            F.map_values("by_lang").alias("c")).toArrow().combine_chunks()
        order, lang, c = (found.column(x).to_numpy() if x == "n" else found.column(x) for x in ("n", "lang", "c"))
        row = np.repeat(np.arange(len(order)), pc.list_value_length(lang).to_numpy())
        scores = np.full((len(order), len(languages)), 0.5)
        scores[row, pc.list_flatten(lang).to_numpy()] += pc.list_flatten(c).to_numpy()
        scores /= (size + 0.5 * kinds[:, None])[order]
        return {gram: i for i, gram in enumerate(found.column("gram").to_pylist())}, np.log(scores, out=scores)

    words, word_scores = best("n = 0", max_words)
    grams, gram_scores = best("n > 0", max_grams)
    floor = math.log(0.5 / max(c for c, _ in totals.values()))
    gram_scores = np.vstack([gram_scores, np.full((1, len(languages)), floor)])
    entries = sum(v for _, v in per_entry.groupBy("n").count().collect())
    of_n = [f"array({', '.join(f'{float(x + 0.5 * kinds[n])!r}D' for x in size[n].tolist())})" for n in range(max_n + 1)]
    table = per_entry.select("n", "gram", F.expr(
        f"zip_with({names}, array({', '.join(of_n)})[n], (l, d) -> ln((coalesce(by_lang[l], 0) + 0.5D) / d))").alias("scores"))
    return LanguageModel(languages, words, word_scores, grams, gram_scores, max_n,
                         len(words) + len(grams) == entries, table)


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _backed_off(model: LanguageModel, shared, unseen: DataFrame) -> DataFrame:
    """(word, scores) of words the model has not seen, by all of its n-grams."""

    @F.pandas_udf("array<string>")
    def missing(words: pd.Series) -> pd.Series:
        return words.map(shared.value.missing)

    @F.pandas_udf("array<double>")
    def backoff(words: pd.Series, grams: pd.Series, scores: pd.Series) -> pd.Series:
        return pd.Series([shared.value.backoff_with(w, {} if g is None else dict(zip(g, x)))
                          for w, g, x in zip(words, grams, scores)], dtype=object)

    grams = model.table.filter("n > 0").select("gram", "scores")
    found = unseen.select("word", F.explode(missing("word")).alias("gram")).join(grams, "gram")
    found = found.groupBy("word").agg(F.collect_list(F.struct("gram", "scores")).alias("found"))
    return unseen.join(found, "word", "left").select(
        "word", backoff("word", F.col("found.gram"), F.col("found.scores")).alias("scores"))


def identify(model: LanguageModel, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, th, lang_pred, score), a row per document row, by the whole model; th is a hash of the text."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    key = [F.col("id").alias(id_col), F.xxhash64("text").alias("th")]
    if model.whole:
        return rows.select(*key, predict(model, rows).alias("p")).select(id_col, "th", "p.*")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("sums array<double>, words array<string>, times array<long>")
    def hot_part(texts: pd.Series) -> pd.DataFrame:
        m, out = shared.value, []
        for text in texts:
            if not text or not any(map(str.isalpha, text)):
                out.append((None, [], []))
                continue
            words = words_of(text)
            at = np.fromiter((m.words.get(w, -1) for w in words), dtype=np.int64, count=len(words))
            cold = Counter([words[i] for i in np.flatnonzero(at < 0).tolist()])
            out.append((m.word_scores[at[at >= 0]].sum(axis=0), list(cold), list(cold.values())))
        return pd.DataFrame(out, columns=["sums", "words", "times"])

    # The row number is fixed by being written.
    parts = materialise(rows.select(*key, hot_part(F.col("text")).alias("p")).select(
        F.col(id_col).alias("id"), "th", "p.*", F.monotonically_increasing_id().alias("row")), "language_parts")
    cold = parts.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    known = model.table.filter("n = 0").select(F.col("gram").alias("word"), "scores")
    words = materialise(cold.select("word").distinct().join(known, "word", "left"), "language_cold_words")
    unseen = words.filter("scores IS NULL").select("word")
    scored = words.filter("scores IS NOT NULL").unionByName(_backed_off(model, shared, unseen))
    n = len(model.languages)
    sums = cold.join(scored, "word").groupBy("row").agg(F.array(*(
        F.sum(F.col("times") * F.col("scores")[i]) for i in range(n))).alias("more"))
    names = f"array({', '.join(_lit(lang) for lang in model.languages)})"
    return (parts.select("row", "id", "th", "sums").join(sums, "row", "left")
            .select("id", "th", F.expr("zip_with(sums, coalesce(more, transform(sums, x -> 0D)), (a, b) -> a + b)").alias("total"))
            .select("id", "th", "total", F.expr("array_max(total)").alias("top"))
            .select(F.col("id").alias(id_col), "th",
                    F.expr(f"CASE WHEN total IS NULL THEN '{UNDETERMINED}' "
                           f"ELSE element_at({names}, CAST(array_position(total, top) AS int)) END").alias("lang_pred"),
                    F.expr("coalesce(1 / aggregate(total, 0D, (a, x) -> a + exp(x - top)), 0D)").alias("score")))


def predict(model: LanguageModel, docs: DataFrame, text_col: str = "text") -> Column:
    """Struct column (lang_pred, score) of a text column, by a model that is whole in every task (else see identify)."""
    if not model.whole:
        raise ValueError("the model has more entries than go to every task: use identify")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def udf(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.predict(t) for t in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    return udf(F.col(text_col))
