"""Quality classifier: hashed word n-gram logistic regression, trained by
follow-the-regularised-leader, scored as sparse dot products.

Training: the labelled rows (a bounded sample, see ``max_rows``) are dealt into
shards by a hash of the id; each shard runs FTRL-Proximal over its rows and the
shards' weights are averaged. Scoring: one pass, one dot product per text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import bounded_sample

BITS = 18
SHARD_ROWS = 2_500
_TOKEN = re.compile(r"\w+|[^\w\s]")
_MASK = (1 << BITS) - 1
_AGAIN = np.uint64(crc32(b"<again>"))


class _Hashes(dict):
    """Token hashes, remembered for a bounded number of tokens."""

    def __missing__(self, token: str) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[token] = h = crc32(token.encode("utf-8", "surrogatepass"))
        return h


_hashes = _Hashes()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, punctuation marks, their bigrams and repeats: (slots, values), values of length one."""
    tokens = _TOKEN.findall(text) if text else []
    if not tokens:
        return np.empty(0, dtype=np.int64), np.empty(0)
    h = np.fromiter(map(_hashes.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    # A word twice running counts as its own bigram and as "some word again".
    again = np.full(int((h[:-1] == h[1:]).sum()), _AGAIN, dtype=np.uint64)
    slots = np.concatenate([h, pairs >> np.uint64(20), again]) & np.uint64(_MASK)
    slots, counts = np.unique(slots.astype(np.int64), return_counts=True)
    return slots, counts / np.sqrt((counts.astype(float) ** 2).sum())


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


@dataclass
class FtrlModel:
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        slots, x = features(text)
        return _sigmoid(self.bias + float(self.weights[slots] @ x))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 2, alpha: float = 0.5, beta: float = 0.1,
         l1: float = 0.02, l2: float = 0.02) -> tuple[np.ndarray, float]:
    """FTRL-Proximal over the rows in order; returns (weights, bias). The bias is not regularised."""
    size = _MASK + 2
    z, n = np.zeros(size), np.zeros(size)

    def weights(at: np.ndarray, l1: float, l2: float) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(0, np.abs(z[at]) - l1)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    last = np.array([size - 1])
    for _ in range(epochs):
        for slots, x, label in rows:
            w, b = weights(slots, l1, l2), weights(last, 0, 0)
            error = _sigmoid(float(b[0]) + float(w @ x)) - label
            for at, w_at, g in ((slots, w, error * x), (last, b, np.array([error]))):
                grown = n[at] + g * g
                z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w_at
                n[at] = grown
    return weights(np.arange(size - 1), l1, l2), float(weights(last, 0, 0)[0])


def _train_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["mix", "id", "label"], kind="stable")
    rows = [(*features(t), int(y)) for t, y in zip(pdf["text"], pdf["label"])]
    w, bias = ftrl(rows)
    on = np.flatnonzero(w)
    return pd.DataFrame({"slot": np.append(on, _MASK + 1), "w": np.append(w[on], bias)})


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = 20_000) -> FtrlModel:
    """Fit on the documents that have a label of 0 or 1 (at most about ``max_rows`` of them).

    Rows without a label, with a null id, or with another label do not train.
    A repeated document trains as often as it is there. Without any row the
    model scores every text 0.5.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        "id IS NOT NULL AND label IN (0, 1)").distinct()
    marked = bounded_sample(marked, "id", max_rows)
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(marked, "id").withColumn("mix", F.xxhash64(F.lit(5), "id")))
    shards = max(1, round(marked.count() / SHARD_ROWS))
    learnt = (rows.withColumn("shard", F.pmod("mix", F.lit(shards)))
              .groupBy("shard").applyInPandas(_train_shard, "slot int, w double")
              .groupBy("slot").agg((F.sum("w")).alias("w")))
    out = np.zeros(_MASK + 2)  # the model has 2 ** BITS slots and a bias, however many rows
    for r in learnt.collect():
        out[r["slot"]] = r["w"] / shards
    return FtrlModel(out[:-1], float(out[-1]))


def score(model: FtrlModel, docs: DataFrame, text_col: str = "text") -> Column:
    """Probability column of label 1 (null and empty texts get that of the bias)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype="float64")

    return udf(F.col(text_col))
