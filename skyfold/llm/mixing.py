"""Mixing sources to target weights by Poisson replication.

Each source gets a rate: its target share of the output over its share of the
input. A document's number of copies is the Poisson distribution with that
mean, inverted at a uniform number drawn from a hash of seed and id: nothing is
drawn at random, so a re-run or a recomputed task gives the same copies. The
copies are dealt to partitions by a hash and sorted by it: a global shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import cut, packed_row, quoted

BROADCAST_SOURCES = 50_000
SHORT = 16.0  # rates beyond this are drawn as a sum of independent parts


def uniform(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of seed and values."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(c.cast("string"), F.lit("null")) for c in cols))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson_inverse(rate: str, u: str) -> str:
    """SQL: the smallest k whose cumulative probability exceeds u, for a rate up to SHORT.

    The walk ends at the first k that does; the bound only ends it for a u
    within rounding of one.
    """
    steps = int(SHORT + 12 * math.sqrt(SHORT) + 20)
    return (f"aggregate(sequence(1, {steps}), named_struct('k', 0, 'p', exp(-({rate})), 'c', exp(-({rate}))), "
            f"(a, i) -> CASE WHEN {u} < a.c THEN a ELSE named_struct('k', i, 'p', a.p * ({rate}) / i, "
            f"'c', a.c + a.p * ({rate}) / i) END, a -> a.k)")


def source_rates(docs: DataFrame, source_col: str, weights: dict[str, float], other: float,
                 epochs: float) -> DataFrame:
    """(source, rate): epochs * target share / share of the rows.

    ``weights`` names sources; every source it does not name weighs ``other``.
    A null source is a source of its own. Weights are relative to the sources
    that are there.
    """
    weight = F.lit(float(other))
    for name, value in weights.items():
        weight = F.when(F.col("source") == name, F.lit(float(value))).otherwise(weight)
    counts = cut(docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n"))
                 .withColumn("weight", weight))
    total = counts.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("k")).first()
    rate = F.lit(float(epochs)) * F.col("weight") / F.lit(total["weight"] or 1.0) * F.lit(total["n"] or 0) / F.col("n")
    rates = counts.select("source", rate.alias("rate"))
    # A table of few sources goes to every task; a larger one is joined by source.
    return F.broadcast(rates) if total["k"] <= BROADCAST_SOURCES else rates


def mix(docs: DataFrame, weights: dict[str, float], other: float = 1.0, epochs: float = 1.0, seed: int = 13,
        id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """All columns of ``docs`` plus replica (1, 2, ...) and mix_rank, shuffled globally.

    The expected number of rows is ``epochs`` times that of ``docs``, dealt to
    sources by weight. A source of weight 0 gives no rows. mix_rank is the
    hash by which the rows of a partition are ordered; rows of equal id and source draw alike and come
    as often as they are given. A row without an id draws by its content and place in the
    table, so such rows come at the rate too. Rows are dealt to partitions by rank and place, so equal
    rows do not meet in one. Columns of ``docs``
    named replica or mix_rank are replaced. Negative weights are refused.
    """
    if min([other, epochs, *weights.values()]) < 0:
        raise ValueError("weights and epochs must not be negative")
    rates = source_rates(docs, source_col, weights, other, epochs).select(
        F.col("source").alias("rate_source"), "rate")
    kept = [c for c in docs.columns if c not in ("replica", "mix_rank")]
    content = [quoted(f.name) for f in docs.schema.fields if f.name in kept and "map<" not in f.dataType.simpleString()]
    rows = docs.select(packed_row(kept, "doc"), F.col(id_col).cast("string").alias("id"),
                       F.col(source_col).alias("source"), F.monotonically_increasing_id().alias("place"),
                       F.xxhash64(F.lit(seed), *content).alias("content"))
    own = F.concat_ws("|", F.lit("null"), F.col("content").cast("string"), F.col("place").cast("string"))
    rows = rows.withColumn("id", F.coalesce("id", own))
    rows = rows.join(rates, rows["source"].eqNullSafe(F.col("rate_source")))
    rows = rows.withColumns({"u": uniform(seed, F.lit("n"), F.col("id")),
                             "parts": F.greatest(F.lit(1), F.ceil(F.col("rate") / SHORT)).cast("int")})
    rows = rows.withColumn("part_rate", F.col("rate") / F.col("parts"))
    # A sum of Poisson numbers is Poisson; each further part has its own draw.
    many = F.expr(f"aggregate(sequence(1, parts), 0, (t, j) -> t + {poisson_inverse('part_rate', _part_draw(seed))})")
    n = F.when(F.col("parts") == 1, F.expr(poisson_inverse("part_rate", "u"))).otherwise(many)
    rows = rows.withColumn("n", n).filter("n > 0").withColumn("replica", F.explode(F.sequence(F.lit(1), F.col("n"))))
    rows = rows.withColumn("mix_rank", F.xxhash64(F.lit(seed), "id", "content", "replica"))
    rows = rows.repartition(F.xxhash64("mix_rank", "place")).sortWithinPartitions("mix_rank")
    return rows.select("doc.*", "replica", "mix_rank")


def _part_draw(seed: int) -> str:
    return (f"(CAST(conv(substring(md5(CAST(concat_ws('|', '{seed}', concat('p', CAST(j AS string)), "
            f"coalesce(CAST(id AS string), 'null')) AS binary)), 1, 13), 16, 10) AS bigint) / {float(1 << 52)!r}D)")
