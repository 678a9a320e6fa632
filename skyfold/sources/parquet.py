"""Parquet day outputs and staging views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def rebalance(df: DataFrame, columns: list[str]) -> DataFrame:
    """Group rows of one output partition into few tasks before a partitioned
    write, so each task writes few files. AQE sizes the result: a partition
    value that holds a large share of the rows is split over several tasks,
    small ones are merged."""
    return df.hint("rebalance", *columns)


def write_partitions(df: DataFrame, path: str, partition_by: str | list[str], *, append: bool = False,
                     dealt: bool = False) -> int:
    """Replace only the partitions present in ``df`` (dynamic overwrite), or
    add to them with ``append``. ``dealt``: the rows are already grouped by partition.

    Returns the rows written, counted while writing.
    """
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    seen = Observation("written")
    ((df if dealt else rebalance(df, cols)).observe(seen, F.count(F.lit(1)).alias("rows"))
       .write.mode("append" if append else "overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*cols)
       .parquet(path))
    return int(seen.get["rows"])


def load_staging(spark: SparkSession, path: str, view: str, *, day: str | None = None,
                 day_column: str = "ingest_date", columns: list[str] | None = None) -> DataFrame:
    """Parquet output as a temporary view; the schema comes from the files.

    With ``day`` only that date partition is read (a partition filter)."""
    df = spark.read.parquet(path)
    if day is not None:
        df = df.filter(F.col(day_column) == F.lit(day).cast("date"))
    if columns is not None:
        df = df.select(*columns)
    df.createOrReplaceTempView(view)
    return df


def drop_staging(spark: SparkSession, view: str) -> bool:
    """Drop a staging view; a missing one is not an error."""
    return spark.catalog.dropTempView(view)


def hadoop_fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path object (driver side,
    metadata calls only)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def drop_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    """Remove one partition folder; a missing one is not an error."""
    fs, jpath = hadoop_fs(spark, f"{path.rstrip('/')}/{column}={value}")
    fs.delete(jpath, True)


def partition_folder(column: str, value) -> str:
    """Folder name of one partition value (a date, a number or plain text; None
    for the null partition)."""
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_fs(spark, path)
    return fs.exists(jpath)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a data file, at any depth. The listing is lazy
    and stops at the first one; a folder that cannot be listed is an error."""
    fs, jpath = hadoop_fs(spark, path)
    if not fs.exists(jpath):
        return False
    root = fs.resolvePath(jpath).toString()
    files = fs.listFiles(jpath, True)
    while files.hasNext():
        below = files.next().getPath().toString()[len(root):]
        if not any(part.startswith(("_", ".")) for part in below.split("/")):
            return True
    return False
