"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.session import ensure_checkpoint_dir, work_path


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package, if the job was not submitted with it.

    A cluster job names the package in --py-files or PYTHONPATH; otherwise
    Spark's own file server hands it to the executors, once per application.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    name = f"skyfold-{sc.applicationId}.zip"
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or any(name in f for f in sc.listFiles):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="skyfold-package-"), name)
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(os.path.join(root, "skyfold")):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(archive)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column name as an expression may hold it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def packed_row(names: list[str], alias: str) -> Column:
    """The named columns as one struct, so that an operator's own names cannot clash with them."""
    return F.struct(*map(quoted, names)).alias(alias)


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet (with the writer's ``options``) under the shared checkpoint folder and read it back.

    Cuts the lineage at a table every executor can read, so a lost executor
    costs only the tasks it was running.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small iterated table (removed once unreferenced)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """All of ``df``, or about 95 % of ``bound`` rows of it chosen by a hash of ``key``.

    Only classifiers' training rows go through this; the same rows are chosen
    on every run.
    """
    n = df.count()
    if n <= bound:
        return df
    cutoff = int(0.95 * bound / n * (1 << 30))
    return df.filter(F.pmod(F.xxhash64(F.lit(97), F.col(key)), F.lit(1 << 30)) < cutoff)


def heaviest(df: DataFrame, value: str, bound: int, key: str | None = None) -> DataFrame:
    """The rows with the largest ``value`` (positive), at most ``bound`` of them.

    The cut-off comes from a histogram of logarithmic steps (some thousands of
    counts at most), so choosing the rows moves none of them. A step that does not fit
    whole is left out, or, with a ``key`` that tells its rows apart, taken in part by a
    hash of that (about 95 % of the room, never more than there is in expectation).
    """
    step = F.floor(F.log2(value) * 64).cast("int")
    cutoff, taken, part = None, 0, F.lit(False)
    for row in sorted(df.groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect(),
                      key=lambda r: -r["b"]):
        if taken + row["n"] > bound:
            if key is not None:
                share = int(0.95 * (bound - taken) / row["n"] * (1 << 30))
                part = (step == row["b"]) & (F.pmod(F.xxhash64(F.lit(41), F.col(key)), F.lit(1 << 30)) < share)
            break
        taken += row["n"]
        cutoff = row["b"]
    whole = step >= F.lit(cutoff) if cutoff is not None else F.lit(False)
    return df.filter(whole | part)
