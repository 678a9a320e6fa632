"""Near-duplicate vectors by PCA-ordered tiled comparison.

Vectors are rotated into the axes of their own second-moment matrix, strongest
axis first. Tiles of at most ``tile_rows`` vectors are compared pairwise: the
products of the leading axes are accumulated first, the rest is bounded by the
product of the suffix norms, and a pair is dropped as soon as its cosine can no
longer reach the threshold. Survivors are checked by the full cosine in double
precision.

Tiles hold vectors of one slab of the first axis. Two unit vectors with cosine
t differ by at most sqrt(2 - 2t) on any axis, so only tiles of the same or of
adjacent slabs of that width meet. The number of tile pairs within a slab still
grows with the square of its rows; that is the method's nature.

Equal vectors are compared once. A tile pair returns link counts per vector and
the components among its own vectors, never the pairs themselves, so a group of
near copies costs rows in proportion to its size times the tiles it meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import materialise
from skyfold.llm.components import connected_components

_EPS = 1e-9          # slack of the pruning bounds, far above rounding
_BLOCK = 1024        # rows of a tile compared at once
_STEPS = (16, 32)    # leading axes accumulated before each bound


def _unit(rows: np.ndarray) -> np.ndarray:
    x = rows.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _matrix(blobs, dim: int, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=dtype).reshape(-1, dim)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the edges i-j."""
    lab = np.arange(n)
    while True:
        low = np.minimum(lab[i], lab[j])
        new = lab.copy()
        np.minimum.at(new, lab[i], low)
        np.minimum.at(new, lab[j], low)
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def compare_tiles(a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray, rotation: np.ndarray,
                  threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between the rows of two tiles (a row is not compared with itself).

    a, b: unit vectors; wa, wb: copies each row stands for. Returns the copies
    linked to each row of a, the same for b, and for the rows of a followed by
    those of b the smallest position of their component.
    """
    ra, rb = a @ rotation, b @ rotation
    tails_a = [np.sqrt(np.maximum(0, (ra[:, s:] ** 2).sum(axis=1))) for s in _STEPS]
    tails_b = [np.sqrt(np.maximum(0, (rb[:, s:] ** 2).sum(axis=1))) for s in _STEPS]
    na, nb = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
    forest_i, forest_j = [], []
    for lo in range(0, len(a), _BLOCK):
        hi = min(len(a), lo + _BLOCK)
        s = _STEPS[0]
        part = ra[lo:hi, :s] @ rb[:, :s].T
        i, j = np.nonzero(part + np.outer(tails_a[0][lo:hi], tails_b[0]) >= threshold - _EPS)
        if same:
            later = i + lo < j
            i, j = i[later], j[later]
        links = []
        for at in range(0, len(i), 1 << 16):  # bounds what the gathered rows of a dense tile take
            x, y = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
            p = part[x, y]
            for step, (frm, to) in enumerate(zip(_STEPS[:-1], _STEPS[1:]), 1):
                p = p + np.einsum("ij,ij->i", ra[lo + x, frm:to], rb[y, frm:to])
                on = p + tails_a[step][lo + x] * tails_b[step][y] >= threshold - _EPS
                x, y, p = x[on], y[on], p[on]
            on = np.einsum("ij,ij->i", a[lo + x], b[y]) >= threshold
            links.append((x[on], y[on]))
        if not links:
            continue
        i, j = np.concatenate([x for x, _ in links]) + lo, np.concatenate([y for _, y in links])
        na += np.bincount(i, wb[j], minlength=len(a)).astype(np.int64)
        nb += np.bincount(j, wa[i], minlength=len(b)).astype(np.int64)
        j = j if same else j + len(a)
        root = _roots(len(a) + (0 if same else len(b)), i, j)
        node = np.unique(np.concatenate([i, j]))
        forest_i.append(node)
        forest_j.append(root[node])
    size = len(a) + (0 if same else len(b))
    if not forest_i:
        return na, nb, np.arange(size)
    return na, nb, _roots(size, np.concatenate(forest_i), np.concatenate(forest_j))


def _moments(dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            pdf = batch.to_pandas()
            for dim, part in pdf.groupby("dim"):
                x = _unit(_matrix(part["raw"], dim, dtype))
                sums[dim] = sums.get(dim, 0) + x.T @ x
        for dim, m in sums.items():
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array(np.full(dim * dim, dim), pa.int32()),
                "at": pa.array(np.arange(dim * dim), pa.int32()),
                "x": pa.array(m.ravel(), pa.float64())})

    return run


def principal_axes(vectors: DataFrame, dtype: str) -> dict[int, np.ndarray]:
    """Per dimension the eigenvectors of the second moments, strongest first.

    All vectors count. Only the d*d sums reach the driver.
    """
    sums = (vectors.select("dim", "raw").mapInArrow(_moments(dtype), "dim int, at int, x double")
            .groupBy("dim", "at").agg(F.sum("x").alias("x")))
    found: dict[int, np.ndarray] = {}
    for row in sums.collect():
        found.setdefault(row["dim"], np.zeros(row["dim"] ** 2))[row["at"]] = row["x"]
    return {dim: np.linalg.eigh(m.reshape(dim, dim))[1][:, ::-1].copy() for dim, m in found.items()}


def _slabs(axes: dict[int, np.ndarray], dtype: str, width: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                first = _unit(_matrix(part["raw"], dim, dtype)) @ axes[dim][:, 0]
                yield part.assign(slab=np.floor(first / width).astype(np.int32))

    return run


def _tile_pair(axes: dict[int, np.ndarray], dtype: str, threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = int(pdf["dim"].iloc[0])
        pdf = pdf.sort_values("rep", kind="stable")
        left, right = pdf[pdf["side"] != 1], pdf[pdf["side"] != 0]
        same = bool((pdf["side"] == 2).any())
        out = []
        if len(left) and len(right):
            a, b = (_unit(_matrix(x["raw"], dim, dtype)) for x in (left, right))
            wa, wb = left["copies"].to_numpy(), right["copies"].to_numpy()
            na, nb, root = compare_tiles(a, b, wa, wb, axes[dim], threshold, same)
            ids = left["rep"].to_numpy() if same else np.concatenate([left["rep"].to_numpy(), right["rep"].to_numpy()])
            n = na + nb if same else np.concatenate([na, nb])
            on = n > 0
            out.append(pd.DataFrame({"rep": ids[on], "n": n[on], "root": ids[root][on]}))
        return pd.concat(out) if out else pd.DataFrame({"rep": [], "n": [], "root": []})

    return run


def embedding_links(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = 0.95, tile_rows: int = 6144) -> DataFrame:
    """One row per input row: id_col, n_links, component_id, kept.

    n_links: other vectors whose cosine with this one is at least ``threshold``
    (0 < threshold <= 1); component_id: smallest id reachable over links, the
    row's own included. Null, empty and zero vectors, vectors with a null or
    non-finite component, and rows with a null id link with nothing; vectors of
    different length do not link. Rows that repeat an id together with its
    vector are one vector and come back as often as they were given. Ids are
    integers; other columns are ignored.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0 and at most 1")
    element = df.schema[vec_col].dataType.elementType.simpleString()
    kind, dtype = ("float", np.dtype(np.float32).str) if element == "float" else ("double", np.dtype(np.float64).str)
    base = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(f"array<{kind}>").alias("v"))
    base = base.withColumn("ok", F.coalesce(F.expr(
        "id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) "
        f"AND abs(x) < CAST('Infinity' AS {kind})) AND exists(v, x -> x != 0)"), F.lit(False)))
    unique = (base.filter("ok").groupBy("v", "id").agg(F.first("ok").alias("ok"))
              .groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    unique = materialise(unique, "unique_vectors")

    packed = _packed(unique, dtype)
    axes = principal_axes(packed, dtype)
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    slabs = packed.mapInPandas(_slabs(axes, dtype, width), packed.schema.simpleString()[7:-1].replace(":", " ")
                               + ", slab int")
    slabs = materialise(slabs, "slabs")
    # At most 2 / width + 2 slabs per dimension, whatever the number of rows.
    tiles = {(r["dim"], r["slab"]): -(-r["n"] // tile_rows)
             for r in slabs.groupBy("dim", "slab").agg(F.count(F.lit(1)).alias("n")).collect()}
    pairs = _paired(slabs, tiles)
    found = pairs.groupBy("dim", "slab_a", "tile_a", "slab_b", "tile_b").applyInPandas(
        _tile_pair(axes, dtype, threshold), "rep long, n long, root long")
    found = materialise(found, "tile_links")

    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    roots = connected_components(found.select("rep", "root"), "rep", "root")
    per_vector = (unique.select("v", "rep", "copies")
                  .join(counts, "rep", "left")
                  .join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
                  .select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                          F.coalesce("root", "rep").alias("component_id")))
    linked = base.filter("ok").join(per_vector, "v").select("id", "n_links", "component_id")
    alone = base.filter("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"),
                                         F.col("id").alias("component_id"))
    out = linked.union(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _packed(unique: DataFrame, dtype: str) -> DataFrame:
    """The vectors as raw bytes: (rep, copies, dim, raw)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            raw = [np.asarray(x, dtype=dtype).tobytes() for x in lists.to_pandas()]
            yield pa.RecordBatch.from_pydict({
                "rep": batch.column("rep"), "copies": batch.column("copies"),
                "dim": pa.compute.list_value_length(lists).cast(pa.int32()),
                "raw": pa.array(raw, pa.binary())})

    return unique.select("rep", "copies", "v").mapInArrow(run, "rep long, copies long, dim int, raw binary")


def _paired(slabs: DataFrame, tiles: dict[tuple[int, int], int]) -> DataFrame:
    """Each vector once per tile pair it takes part in; side 0, 1, or 2 within a tile."""
    if not tiles:
        tiles = {(0, 0): 1}
    count = F.create_map(*(F.lit(x) for (d, s), n in sorted(tiles.items()) for x in (f"{d}:{s}", n)))
    placed = slabs.withColumn("_tiles", count)

    def n_at(delta: int):
        return F.coalesce(F.try_element_at("_tiles", F.concat_ws(":", "dim", (F.col("slab") + delta).cast("string"))),
                          F.lit(0)).cast("int")

    placed = (placed.withColumns({"_here": n_at(0), "_up": n_at(1), "_down": n_at(-1)})
              .withColumn("tile", F.pmod(F.xxhash64("rep"), "_here").cast("int")))
    meet = F.expr("""concat(
        transform(sequence(1, _here), k -> named_struct(
            'slab_a', slab, 'tile_a', least(tile, k - 1), 'slab_b', slab, 'tile_b', greatest(tile, k - 1),
            'side', CASE WHEN tile = k - 1 THEN 2 WHEN tile < k - 1 THEN 0 ELSE 1 END)),
        CASE WHEN _up > 0 THEN transform(sequence(1, _up), k -> named_struct(
            'slab_a', slab, 'tile_a', tile, 'slab_b', slab + 1, 'tile_b', k - 1, 'side', 0)) ELSE array() END,
        CASE WHEN _down > 0 THEN transform(sequence(1, _down), k -> named_struct(
            'slab_a', slab - 1, 'tile_a', k - 1, 'slab_b', slab, 'tile_b', tile, 'side', 1)) ELSE array() END)""")
    return placed.select("dim", "rep", "copies", "raw", F.explode(meet).alias("m")).select(
        "dim", "rep", "copies", "raw", "m.*")
