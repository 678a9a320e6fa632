"""SimHash near-duplicate detection by multi-index hashing.

Every text becomes a 64-bit SimHash. Texts link when their fingerprints differ
in at most ``max_distance`` bits; linked texts form components.

The fingerprint is cut into segments. For each segment the small Hamming ball
around its value is enumerated and each variant, together with the unchanged
other segments, is a key of the index: two fingerprints at distance 2 or less
meet under a key that lies within one bit of both, whether their two bits fall
in one segment or in two. Keeping the other segments in the key bounds a bucket:
at most 65 fingerprints lie within one bit of a key, however many near copies
a group has, so no bucket is ever paired with itself in full. Rows meeting
under a key are linked to its smallest fingerprint, and the complete distance
of each such link is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.common import materialise, packed_row
from skyfold.llm.components import connected_components

SEGMENT_BITS = 32
_CHUNK = 1 << 16


def simhash64(words: list[bytes], shingle_words: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of the word shingles, repeats included.

    Fewer words than a shingle: the whole sequence is the one shingle; no
    words: zero. A bit is set when it is set in over half of the XXH64 values.
    """
    n = len(words)
    if n == 0:
        return 0
    k = min(shingle_words, n)
    total = n - k + 1
    votes = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, total, _CHUNK):  # bounds the bit matrix of a very long text
        stop = min(total, start + _CHUNK)
        part = words[start:stop + k - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(k))))
        h = np.fromiter((digest(g, seed) for g in grams), dtype=np.uint64, count=stop - start)
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > total).tobytes(), "big")


def fingerprint(text_col: str, shingle_words: int = 3) -> Column:
    """Column of signed 64-bit SimHashes of a text column (null text: zero)."""

    @F.pandas_udf("long")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            # bytes.lower() and bytes.split() act on ASCII A-Z and ASCII white space only.
            yield pd.Series(np.array([simhash64(t.lower().split(), shingle_words) if t else 0 for t in texts],
                                     dtype=np.uint64).view(np.int64))

    return udf(F.col(text_col).cast("binary"))


def _links(prints: DataFrame, max_distance: int) -> DataFrame:
    """Links (fp, low) that connect all fingerprints within ``max_distance`` bits."""
    if max_distance not in (0, 1, 2):
        raise ValueError("max_distance must be 0, 1 or 2")
    if max_distance == 0:
        return prints.select("fp", F.col("fp").alias("low")).filter("false")
    balls = ["array(fp)"]
    for first in range(0, 64, SEGMENT_BITS):
        balls.append(f"transform(sequence({first}, {first + SEGMENT_BITS - 1}), i -> fp ^ shiftleft(1L, i))")
    keys = prints.select("fp", F.expr(f"explode(concat({', '.join(balls)})) AS key"))
    met = keys.withColumn("low", F.min("fp").over(Window.partitionBy("key")))
    return met.filter(f"fp != low AND bit_count(fp ^ low) <= {max_distance}").select("fp", "low").distinct()


def _links_one(prints: DataFrame) -> DataFrame:
    """Links at distance exactly one: each ball meets the fingerprints themselves."""
    ball = "transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))"
    probes = prints.select("fp", F.expr(f"explode({ball}) AS key")).filter("key < fp")
    return probes.join(prints.select(F.col("fp").alias("key")), "key").select("fp", F.col("key").alias("low"))


def link_fingerprints(prints: DataFrame, max_distance: int = 2) -> DataFrame:
    """(fp, root) of all linked fingerprints; ``prints`` holds distinct ``fp``."""
    links = _links_one(prints) if max_distance == 1 else _links(prints, max_distance)
    found = connected_components(links, "fp", "low")
    return found.select(F.col("node").alias("fp"), "root")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """One row per document: id_col, fp (signed long), root, component_id.

    root is the smallest fingerprint of the component, component_id is the smallest id reachable over links, the document's own
    included. Null and wordless texts have fingerprint zero and link like any
    other. Repeated rows come back repeated; a null id never becomes a
    component_id unless every id of its component is null. Other columns are
    ignored.
    """
    rows = materialise(docs.select(F.col(id_col).alias("id"), fingerprint(text_col, shingle_words).alias("fp")),
                       "simhash")
    prints = rows.groupBy("fp").agg(F.min("id").alias("low_id"))
    linked = link_fingerprints(prints.select("fp"), max_distance)
    rooted = prints.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    groups = rooted.join(lowest, "root").select("fp", "root", "component_id")
    return rows.join(groups, "fp").select(F.col("id").alias(id_col), "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Rows that repeat the id of a kept document (also null ids, if no id of the
    component is known) count as its copies: one row of them stays, that with
    the smallest text. All columns are kept as they are.
    """
    groups = materialise(simhash_groups(docs, id_col, text_col, shingle_words, max_distance), "simhash_groups")
    is_kept = F.col(id_col).eqNullSafe(F.col("component_id"))
    per_id = groups.groupBy(F.col(id_col).alias("sid")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_kept).alias("kept"))
    dropped = per_id.filter("kept = 0").select("sid")
    out = docs.join(dropped, docs[id_col].eqNullSafe(dropped["sid"]), "left_anti")
    repeated = per_id.filter("kept > 0 AND n > 1").select("sid")
    if repeated.isEmpty():
        return out
    single = out.join(repeated, docs[id_col].eqNullSafe(repeated["sid"]), "left_anti")
    again = docs.join(repeated, docs[id_col].eqNullSafe(repeated["sid"]), "left_semi")
    # The fingerprint tells which rows of a repeated id belong to which kept group.
    roots = groups.filter(is_kept).select(F.col(id_col).alias("sid"), F.col("fp").alias("sfp"), "root").distinct()
    again = again.select(packed_row(docs.columns, "doc"), F.col(id_col).alias("id"),
                         F.col(text_col).alias("txt"), fingerprint(text_col, shingle_words).alias("fp"))
    order = Window.partitionBy("id", "root").orderBy(F.col("txt").asc_nulls_last())
    again = (again.join(roots, F.col("id").eqNullSafe(F.col("sid")) & (F.col("fp") == F.col("sfp")))
             .withColumn("place", F.row_number().over(order)).filter("place = 1"))
    return single.unionByName(again.select("doc.*"))
