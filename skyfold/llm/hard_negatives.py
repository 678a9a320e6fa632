"""Hard negatives by a multiway hyperplane tree with distance ranges.

For an anchor and each of its positives (the best-scoring rows of its label)
the hard negatives are the best rows of other labels whose score lies in a
window below the positive's. Vectors are whole numbers (floor(scale * x)) and a
score is their exact inner product.

The index is a tree in the manner of GNAT. A node holds some split points, a
row belongs to the subtree of the nearest one (so generalised hyperplanes part
the rows), and the node stores for every pair (split point, subtree) the least
and greatest distance between them, over all rows. With the coordinate
sqrt(M^2 - |x|^2) added to a row and 0 to an anchor, where M is the largest
norm, a score s is the distance sqrt(|q|^2 + M^2 - 2 s), so a window of
scores is an annulus about the anchor. A subtree whose range to some split
point does not meet the annulus' range to it holds no row of the window and is
eliminated; leaves that remain are searched exactly.

Split points come from a bounded sample; every row is indexed and enters the
ranges. The sample's own rows also give each anchor a first bound: k rows found
there close the window below the k-th. Anchors are spread over the
leaves left to them, leaves too large are dealt in blocks, and the best rows
are chosen per block before they meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.common import materialise

_NO_ID = (1 << 63) - 1
#: Squared norms from here on take no part: a score could leave the longs.
_LARGEST_SQUARE = float(1 << 61)
#: Up to here sums of products are exact in double precision, in any order.
_EXACT_SQUARE = float(1 << 52)
_NO_BOUND = -(1 << 62)
_ANCHORS_AT_ONCE = 256


@dataclass(frozen=True)
class Settings:
    """sample_rows, sample_bytes: bounds of the sample that split points come from;
    fanout: split points of a node; leaf_rows: rows aimed at in a leaf; block_rows,
    block_anchors: the most rows and anchors that meet in one task group."""

    sample_rows: int = 20_000
    sample_bytes: int = 32_000_000
    fanout: int = 8
    leaf_rows: int = 2_000
    block_rows: int = 20_000
    block_anchors: int = 4_000


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (long) of the rows of two long matrices."""
    if len(a) and len(b) and max((m.astype(np.float64) ** 2).sum(axis=1).max() for m in (a, b)) < _EXACT_SQUARE:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


@dataclass
class _Node:
    points: np.ndarray                       # rows of the sample
    children: list = field(default_factory=list)   # node numbers; ~leaf for leaves
    low: np.ndarray | None = None            # [point, child] least and greatest distances
    high: np.ndarray | None = None


class Tree:
    """Nodes over a sample ``vectors`` (long) of rows; ``square``: the largest squared norm of all rows."""

    def __init__(self, vectors: np.ndarray, square: float, fanout: int, leaf_sample: int):
        self.vectors, self.square = vectors, square
        self.lift = self._lift(vectors)
        self.nodes: list[_Node] = []
        self.leaves = 0
        self.top = self._build(np.arange(len(vectors)), fanout, leaf_sample)

    def _lift(self, vectors: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.square - (vectors.astype(np.float64) ** 2).sum(axis=1), 0.0))

    def distances(self, vectors: np.ndarray, points: np.ndarray, lift: np.ndarray | None = None) -> np.ndarray:
        """Distances of lifted rows to sample rows; anchors have no lift (``lift`` = 0)."""
        v = vectors.astype(np.float64)
        lift = self._lift(vectors) if lift is None else lift
        squares = (v ** 2).sum(axis=1) + lift ** 2
        far = squares[:, None] + self.square - 2 * (
            v @ self.vectors[points].T.astype(np.float64) + lift[:, None] * self.lift[points])
        return np.sqrt(np.maximum(far, 0.0))

    @property
    def slack(self) -> float:
        """More than rounding can take from a distance: the square root of a squared error."""
        return 1e-6 * max(self.square, 1.0) ** 0.5

    def _build(self, rows: np.ndarray, fanout: int, leaf_sample: int) -> int:
        if len(rows) <= leaf_sample or len(points := self._points(rows, fanout)) < 2:
            self.leaves += 1
            return ~(self.leaves - 1)
        at = len(self.nodes)
        self.nodes.append(node := _Node(points))
        nearest = self.distances(self.vectors[rows], points).argmin(axis=1)
        node.children = [self._build(rows[nearest == i], fanout, leaf_sample) for i in range(len(points))]
        return at

    def _points(self, rows: np.ndarray, fanout: int) -> np.ndarray:
        """Sample rows far from each other: each the farthest from those before."""
        some = rows[np.linspace(0, len(rows) - 1, min(len(rows), 40 * fanout)).astype(np.int64)]
        chosen = [some[0]]
        near = self.distances(self.vectors[some], some[:1])[:, 0]
        while len(chosen) < fanout and near.max() > self.slack:
            chosen.append(some[near.argmax()])
            near = np.minimum(near, self.distances(self.vectors[some], np.array(chosen[-1:]))[:, 0])
        return np.array(chosen)

    def route(self, vectors: np.ndarray, met=None) -> np.ndarray:
        """The leaf of every row; ``met(node number, distances, children)`` sees each step."""
        leaf = np.zeros(len(vectors), dtype=np.int32)
        todo = [(self.top, np.arange(len(vectors)))]
        while todo:
            at, rows = todo.pop()
            if at < 0:
                leaf[rows] = ~at
                continue
            far = self.distances(vectors[rows], self.nodes[at].points)
            nearest = far.argmin(axis=1)
            if met is not None:
                met(at, far, nearest)
            todo += [(child, rows[nearest == i]) for i, child in enumerate(self.nodes[at].children)
                     if (nearest == i).any()]
        return leaf

    def set_ranges(self, ranges) -> None:
        """``ranges``: (node, point, child, low, high) of the subtrees that hold rows."""
        for node in self.nodes:
            k = len(node.points)
            node.low, node.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for at, i, j, low, high in ranges:
            self.nodes[at].low[i, j], self.nodes[at].high[i, j] = low, high

    def leaves_of(self, vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """[anchor, leaf]: whether the leaf may hold a row whose score lies between ``low`` and ``high``."""
        out = np.zeros((len(vectors), self.leaves), dtype=bool)
        base = (vectors.astype(np.float64) ** 2).sum(axis=1) + self.square
        inner = np.sqrt(np.maximum(base - 2 * high.astype(np.float64), 0.0)) - self.slack
        outer = np.sqrt(np.maximum(base - 2 * low.astype(np.float64), 0.0)) + self.slack
        flat = np.zeros(len(vectors))
        todo = [(self.top, np.nonzero(low <= high)[0])]
        while todo:
            at, rows = todo.pop()
            if at < 0:
                out[rows, ~at] = True
                continue
            node = self.nodes[at]
            far = self.distances(vectors[rows], node.points, flat[rows])
            # A row at distance r of the anchor, inner <= r <= outer, lies between |far - r| and far + r of the point.
            least = np.maximum(np.maximum(far - outer[rows, None], inner[rows, None] - far), 0.0)
            most = far + outer[rows, None]
            for j, child in enumerate(node.children):
                stays = ((node.low[:, j] <= most + self.slack) & (node.high[:, j] >= least - self.slack)).all(axis=1)
                if stays.any():
                    todo.append((child, rows[stays]))
        return out


def whole_vectors(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id long, label long, v binary, square double) of the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    # Infinity minus itself is not a number, which equals itself in Spark but not zero.
    sound = F.col(label_col).isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & (c - c == F.lit(0.0)))
    given = rows.filter(sound).select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"),
                                      F.col(label_col).cast("long").alias("label"), x.alias("x"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole = [np.floor(scale * np.asarray(v, dtype=np.float64)) for v in batch["x"]]
            square = np.array([float((v ** 2).sum()) for v in whole], dtype=np.float64)
            fits = square < _LARGEST_SQUARE
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"],
                                "v": [v.astype("<i8").tobytes() if ok else b"" for v, ok in zip(whole, fits)],
                                "square": square})[fits]

    return given.mapInPandas(run, "id long, label long, v binary, square double")


def _matrix(values, width: int) -> np.ndarray:
    """Vectors as rows of one matrix; shorter ones count as filled up with zeros."""
    if not len(values):
        return np.zeros((0, width), dtype=np.int64)
    return np.frombuffer(b"".join(v.ljust(8 * width, b"\0") for v in values), dtype="<i8").reshape(-1, width)


@dataclass
class Index:
    """Routed rows (id, label, v, leaf, block), the tree, the sample it was built on and rows per leaf."""

    rows: DataFrame
    tree: object          # broadcast Tree
    sample: object        # broadcast (ids, labels)
    blocks: object        # broadcast: blocks of each leaf
    width: int
    settings: Settings


def build_index(rows: DataFrame, settings: Settings = Settings()) -> Index:
    """Index ``rows`` (of ``whole_vectors``, written): the tree is fitted on a sample
    of at most ``sample_rows`` rows drawn with a fixed seed, every row is routed and counted in the ranges."""
    spark = rows.sparkSession
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.max("square").alias("square"),
                     F.max(F.octet_length("v")).alias("bytes")).first()
    n, width = total["n"], max(1, (total["bytes"] or 0) // 8)
    bound = max(1, min(settings.sample_rows, settings.sample_bytes // (8 * width)))
    # Drawn by a row's place, not its content, so a group of copies is drawn at its share.
    drawn = rows if n <= bound else rows.filter(F.rand(97) < 0.95 * bound / n).limit(bound)
    sample = drawn.select("id", "label", "v").toPandas()
    tree = Tree(_matrix(sample["v"], width), float(total["square"] or 0.0), settings.fanout,
                max(2, settings.leaf_rows * len(sample) // max(n, 1)))
    shared = spark.sparkContext.broadcast(tree)
    leaves = tree.leaves

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(leaf=shared.value.route(_matrix(batch["v"], width)))

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high = {}, {}

        def met(at, far, nearest):
            for j in np.unique(nearest):
                part = far[nearest == j]
                for found, best, take in ((part.min(axis=0), low, np.minimum), (part.max(axis=0), high, np.maximum)):
                    best[at, j] = take(best[at, j], found) if (at, j) in best else found

        for batch in batches:
            shared.value.route(_matrix(batch["v"], width), met)
        out = [(at, i, int(j), float(low[at, j][i]), float(high[at, j][i])) for at, j in low for i in range(len(low[at, j]))]
        yield pd.DataFrame(out, columns=["node", "point", "child", "low", "high"])

    routed = materialise(rows.select("id", "label", "v").mapInPandas(route, "id long, label long, v binary, leaf int"),
                         "routed")
    found = routed.select("v").mapInPandas(ranges, "node int, point int, child int, low double, high double").groupBy(
        "node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    tree.set_ranges(found)
    counts = {r["leaf"]: r["n"] for r in routed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = np.array([-(-counts.get(leaf, 0) // settings.block_rows) for leaf in range(leaves)], dtype=np.int32)
    # Leaves too large are dealt in blocks by row, not by content, as copies of one vector share a leaf.
    of_leaf = spark.createDataFrame([(i, int(b)) for i, b in enumerate(blocks)], "leaf int, blocks int")
    dealt = routed.withColumn("salt", F.monotonically_increasing_id()).join(F.broadcast(of_leaf), "leaf").select(
        "id", "label", "v", "leaf", F.pmod(F.xxhash64("salt"), F.col("blocks")).cast("int").alias("block"))
    context = spark.sparkContext
    return Index(dealt, context.broadcast(tree), context.broadcast((sample["id"].to_numpy(), sample["label"].to_numpy())),
                 context.broadcast(blocks), width, settings)


_VISIT = "anchor long, id long, label long, v binary, lows array<long>, highs array<long>, leaf int, block int"
_FOUND = "anchor long, win int, id long, score long"


def _window_floor(scores: np.ndarray, usable: np.ndarray, low: int, high: int, k: int) -> int:
    """The k-th best usable score of a window, or its lower end if there are not as many."""
    inside = scores[usable & (scores >= low) & (scores <= high)]
    return low if len(inside) < k else int(np.partition(inside, len(inside) - k)[len(inside) - k])


def search(index: Index, anchors: DataFrame, same_label: bool, k: int) -> DataFrame:
    """The best ``k`` rows per anchor and window: anchor, win (window number), id, score, rank (from 1).

    ``anchors``: anchor (unique), id, label, v, lows, highs (arrays: a window of
    scores each, ends included). Rows of the anchor's label compete
    if ``same_label``, else the others; rows with the anchor's id never do.
    Higher scores come first, then smaller ids.
    """
    width, tree, sample, blocks, settings = index.width, index.tree, index.sample, index.blocks, index.settings

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, labels = sample.value
        for whole in batches:
            for at in range(0, len(whole), _ANCHORS_AT_ONCE):
                batch = whole.iloc[at:at + _ANCHORS_AT_ONCE].reset_index(drop=True)
                v = _matrix(batch["v"], width)
                scores = products(v, tree.value.vectors)
                meet = np.zeros((len(batch), tree.value.leaves), dtype=bool)
                lows, most = [], max(map(len, batch["lows"]), default=0)
                for row, own in enumerate(scores):
                    usable = ((labels == batch["label"][row]) == same_label) & (ids != batch["id"][row])
                    lows.append([_window_floor(own, usable, int(a), int(b), k)
                                 for a, b in zip(batch["lows"][row], batch["highs"][row])])
                for w in range(most):
                    has = [w < len(x) for x in lows]
                    low = np.array([x[w] if h else 1 for x, h in zip(lows, has)], dtype=np.int64)
                    high = np.array([x[w] if h else 0 for x, h in zip(batch["highs"], has)], dtype=np.int64)
                    meet |= tree.value.leaves_of(v, low, high)
                row, leaf = np.nonzero(meet)
                times = blocks.value[leaf]
                row, leaf, block = (np.repeat(row, times), np.repeat(leaf, times),
                                    np.concatenate([np.arange(t) for t in times]) if len(times) else np.zeros(0, int))
                for start in range(0, len(row), 5_000):
                    r = row[start:start + 5_000]
                    yield batch.iloc[r][["anchor", "id", "label", "v"]].assign(
                        lows=[lows[i] for i in r], highs=[batch["highs"][i] for i in r],
                        leaf=leaf[start:start + 5_000].astype(np.int32), block=block[start:start + 5_000].astype(np.int32))

    def meet_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        right = right.sort_values("id", kind="stable").reset_index(drop=True)
        rows, ids, labels = _matrix(right["v"], width), right["id"].to_numpy(), right["label"].to_numpy()
        for at in range(0, len(left), _ANCHORS_AT_ONCE):
            batch = left.iloc[at:at + _ANCHORS_AT_ONCE].reset_index(drop=True)
            scores = products(_matrix(batch["v"], width), rows)
            for i, own in enumerate(scores):
                usable = ((labels == batch["label"][i]) == same_label) & (ids != batch["id"][i])
                for w, (low, high) in enumerate(zip(batch["lows"][i], batch["highs"][i])):
                    inside = np.nonzero(usable & (own >= low) & (own <= high))[0]
                    if not len(inside):
                        continue
                    best = inside[np.argsort(-own[inside], kind="stable")[:k]]  # rows are in order of id
                    out.append(pd.DataFrame({"anchor": batch["anchor"][i], "win": w, "id": ids[best],
                                             "score": own[best]}))
        return pd.concat(out) if out else pd.DataFrame(columns=["anchor", "win", "id", "score"])

    sent = materialise(anchors.mapInPandas(visits, _VISIT), "visits")
    groups = ["leaf", "block", "slice"]
    slices = F.greatest(F.lit(1), F.ceil(F.col("n") / settings.block_anchors))
    per_block = sent.groupBy("leaf", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "leaf", "block", slices.cast("int").alias("slices"))
    left = sent.join(per_block, ["leaf", "block"]).withColumn("slice", F.pmod(F.xxhash64("anchor"), F.col("slices")))
    right = index.rows.join(per_block, ["leaf", "block"]).withColumn(
        "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - F.lit(1).cast("long"))))
    found = left.drop("slices").groupBy(*groups).cogroup(right.drop("slices").groupBy(*groups)).applyInPandas(
        meet_block, _FOUND)
    order = Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", scale: int = 256, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90, settings: Settings = Settings()) -> DataFrame:
    """Hard negatives of every anchor and positive: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    ``is_anchor`` chooses the anchors by ``id_col``. Positives are an anchor's first
    ``positives`` other rows of its label, negatives the first ``negatives`` rows of
    another label with low * p <= 100 * s <= high * p, where p is the
    positive's score. Ids and labels are whole numbers.

    Rows with a null label or vector, or a null or non-finite component, take no
    part; nor do those so large that a score could leave the longs (squared norm
    of 2^61 and more). A shorter vector counts as filled up with zeros, an empty
    one scores 0. A null id is no anchor and comes last among ties (the largest
    long stands for it). Repeated rows are rows of their own, but a row is no
    partner of an anchor with its id. An anchor without positives, or a
    positive without negatives, gives no row; so do empty tables. Other columns are
    ignored.
    """
    whole = materialise(whole_vectors(rows, id_col, label_col, vector_col, scale), "whole_vectors")
    index = build_index(whole, settings)
    anchors = materialise(
        whole.withColumn(id_col, F.col("id")).filter(is_anchor & (F.col("id") != _NO_ID)).select(
            F.monotonically_increasing_id().alias("anchor"), "id", "label", "v"), "anchors")
    everything = anchors.withColumns({"lows": F.array(F.lit(_NO_BOUND)), "highs": F.array(F.lit(-_NO_BOUND))})
    best = materialise(search(index, everything, True, positives).groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("positive")), "positives")
    # Whole numbers: 100 s >= low p and 100 s <= high p, with the ends rounded inwards.
    p = F.col("positive.score")
    windows = anchors.join(best, "anchor").select(
        "anchor", "id", "label", "v",
        F.transform(p, lambda s: _ceil_div(s, low)).alias("lows"),
        F.transform(p, lambda s: _floor_div(s, high)).alias("highs"))
    found = search(index, windows, False, negatives)
    names = anchors.select("anchor", F.col("id").alias("anchor_id")).join(best, "anchor").select(
        "anchor", "anchor_id", F.posexplode("positive").alias("win", "p"))

    def shown(c: str) -> Column:
        return F.when(F.col(c) != _NO_ID, F.col(c))

    return found.join(names, ["anchor", "win"]).select(
        "anchor_id", shown("p.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        shown("id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))


def _floor_div(score: Column, percent: int) -> Column:
    """floor(percent * score / 100) without leaving the longs: by hundreds and the rest."""
    rest, hundred = F.pmod(score, F.lit(100)), F.lit(100)
    return F.call_function("div", score - rest, hundred) * percent + F.call_function("div", rest * percent, hundred)


def _ceil_div(score: Column, percent: int) -> Column:
    return -_floor_div(-score, percent)
