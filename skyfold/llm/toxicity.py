"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

A lexicon of words typical of toxic texts is learnt from labelled rows. Each
text becomes a dozen densities and rates (lexicon, second person near lexicon
words, capitals, punctuation, obfuscated words); boosted trees score them and
an isotonic fit on rows the trees have not seen turns scores into
probabilities.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import bounded_sample, materialise

# Second-person pronouns of the languages handled.
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine "
                          "euch euer ihr sie ti tus usted ustedes vosotros".split())
# Signs commonly written for letters.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i",
                            "|": "l", "+": "t"})
FEATURES = ("lexicon_density", "lexicon_hits", "lexicon_strongest", "near_second_person", "nearest_second_person",
            "second_person_density", "capitals", "shouted_words", "exclamation", "punctuation", "obfuscated",
            "hidden_hits", "length")
_TOKEN = re.compile(r"\S+")
_EDGE = "\"'`.,;:!?()[]{}<>*#%&$|-_=+~^/\\"
NEAR = 5


def _plain(token: str) -> str:
    return token.strip(_EDGE).lower()


def dense_features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """The values of FEATURES for one text (all zero for a null, empty or blank one)."""
    tokens = _TOKEN.findall(text) if text else []
    n = len(tokens)
    if not n:
        return [0.0] * len(FEATURES)
    hits, pronouns, strongest, hidden, obfuscated, shouted = [], [], 0.0, 0, 0, 0
    for i, token in enumerate(tokens):
        word = _plain(token)
        weight = lexicon.get(word)
        if weight is not None:
            hits.append(i)
            strongest = max(strongest, weight)
        elif word and not word.isalpha():
            folded = "".join(c for c in word.translate(LOOKALIKES) if c.isalpha())
            if any(c.isalpha() for c in word) and folded != word:
                obfuscated += 1
            if folded != word and folded in lexicon:
                hidden += 1
                hits.append(i)
        if word in SECOND_PERSON:
            pronouns.append(i)
        if len(word) > 1 and token.isupper():
            shouted += 1
    near, nearest = 0, 0.0
    if hits and pronouns:
        at = np.asarray(pronouns)
        right = np.searchsorted(at, hits)
        gap = np.minimum(np.abs(at[np.minimum(right, len(at) - 1)] - hits), np.abs(at[np.maximum(right - 1, 0)] - hits))
        near, nearest = int((gap <= NEAR).sum()), 1 / (1 + float(gap.min()))
    chars = len(text)
    letters = sum(map(str.isalpha, text)) or 1
    marks = sum(text.count(c) for c in "!?*#$%&")
    capitals = sum(map(str.isupper, text))
    return [len(hits) / n, math.log1p(len(hits)), strongest, near / n, nearest, len(pronouns) / n, capitals / letters,
            shouted / n, text.count("!") / n, marks / chars, obfuscated / n, hidden / n, math.log1p(n)]


def learn_lexicon(rows: DataFrame, max_words: int = 500, min_docs: int = 5, min_ratio: float = 8.0) -> dict[str, float]:
    """Words at least ``min_ratio`` times as frequent (by documents) in label-1 rows: word to log ratio.

    ``rows`` has text and label. At most ``max_words`` words, those most
    frequent among label-1 documents first.
    """
    words = rows.select("label", F.explode(F.array_distinct(F.transform(
        F.split("text", r"\s+"), lambda t: F.lower(F.btrim(t, F.lit(_EDGE)))))).alias("word")).filter("word != ''")
    size = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = size.get(1, 0) + 1.0, size.get(0, 0) + 1.0
    counted = words.groupBy("word").agg(F.count_if(F.col("label") == 1).alias("t"), F.count_if(F.col("label") == 0).alias("c"))
    ratio = (F.col("t") / toxic) / ((F.col("c") + 0.5) / clean)
    top = counted.filter(F.col("t") >= min_docs).withColumn("ratio", ratio).filter(F.col("ratio") >= min_ratio)
    return {r["word"]: math.log(r["ratio"]) for r in top.orderBy(F.desc("t"), "word").limit(max_words).collect()}


def with_features(docs: DataFrame, text_col: str, lexicon: dict[str, float], name: str = "features") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("array<double>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([dense_features(t, shared.value) for t in texts])

    return docs.withColumn(name, array_to_vector(udf(F.col(text_col))))


class ToxicityModel:
    """Lexicon, trees and calibration; ``score`` adds the probability of label 1."""

    def __init__(self, lexicon, trees, calibration, base_rate: float):
        self.lexicon, self.trees, self.calibration, self.base_rate = lexicon, trees, calibration, base_rate

    def raw(self, featured: DataFrame) -> DataFrame:
        scored = self.trees.transform(featured)
        return scored.withColumn("raw", vector_to_array("probability")[1])

    def score(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(id_col, score); one row per row of ``docs``."""
        rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
        if self.trees is None:
            return rows.select(id_col, F.lit(self.base_rate).alias("score"))
        featured = with_features(rows, "_text", self.lexicon).select(id_col, "features")
        found = self.calibration.transform(self.raw(featured).select(id_col, "raw"))
        return found.select(id_col, F.greatest(F.lit(0.0), F.least(F.lit(1.0), "calibrated")).alias("score"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_rows: int = 20_000, trees: int = 20, depth: int = 3) -> ToxicityModel:
    """Fit on documents labelled 0 or 1 (at most about ``max_rows``, a documented bound).

    Three quarters of the rows grow the lexicon and the trees, one quarter
    fits the calibration. Without rows of both labels every text gets the share
    of label 1 (0.5 without any row). Null ids and other labels do not train.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        "id IS NOT NULL AND label IN (0, 1)").distinct()
    marked = bounded_sample(marked, "id", max_rows)
    rows = materialise(docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
                       .join(marked, "id")
                       .withColumn("fit", F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(4)) != 0), "toxicity_rows")
    sizes = {(r["fit"], r["label"]): r["n"] for r in
             rows.groupBy("fit", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(sizes.values())
    base_rate = sum(v for (_, y), v in sizes.items() if y == 1) / n if n else 0.5
    if len(sizes) < 4:
        return ToxicityModel({}, None, None, base_rate)
    lexicon = learn_lexicon(rows.filter("fit").select("text", "label"))
    featured = materialise(with_features(rows, "text", lexicon)
                           .select("id", "label", "fit", vector_to_array("features").alias("f")), "toxicity_features")
    featured = featured.withColumn("features", array_to_vector("f")).withColumn("label", F.col("label").cast("double"))
    # The feature table is bounded by max_rows; one sorted partition makes the
    # fit the same on every cluster.
    fit = featured.filter("fit").coalesce(1).sortWithinPartitions("id")
    grown = GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2,
                          seed=11, maxBins=64).fit(fit)
    model = ToxicityModel(lexicon, grown, None, base_rate)
    # Rows of one raw score count as one with their mean and number: few trees give few scores, and one may be hot.
    held = model.raw(featured.filter("NOT fit")).groupBy("raw").agg(
        F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    model.calibration = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight",
                                           predictionCol="calibrated").fit(held)
    return model
