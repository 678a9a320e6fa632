"""Incremental accumulation of landed snapshots into the history (T1).

A file-source stream over the landing folder sees only files it has not
processed before (the checkpoint records them). Each micro-batch:

1. keeps one whole copy of each snapshot (others are re-fetched copies);
2. explodes, maps, filters and transforms the vectors;
3. merges the rows into the history by key.

No streaming state is kept: the keyed merge makes a re-run of a batch (after a
failure) and a late catch-up batch give the same table as one full load. A
watermarked streaming dedup would instead drop a backlog older than the
watermark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from skyfold.plans import named
from skyfold.plans.preset import snapshot_rows
from skyfold.plans.tables import merge_into, with_history_partition
from skyfold.schema import RAW_SCHEMA
from skyfold.session import ensure_checkpoint_dir
from skyfold.sources.parquet import folder_exists, hadoop_fs
from skyfold.sources.snapshots import one_copy, read_documents

#: Files per micro-batch: a backlog is worked off in bounded batches, none is left out.
MAX_FILES_PER_TRIGGER = 10_000


def accumulate(spark: SparkSession, landing: str, history: str, checkpoint: str, *,
               ingested_at: Column | None = None, multi_line: bool = False,
               key_order: str | Column | Sequence[str | Column] | None = None,
               max_files_per_trigger: int = MAX_FILES_PER_TRIGGER, dated_folders: bool = False,
               box: tuple[float, float, float, float] | None = None, archive: str | None = None) -> dict:
    """Process every landed file not yet seen, then stop (``availableNow``).

    ``history`` is a path or a table name; ``box`` keeps the vectors within a
    bounding box only. ``archive``: files of finished batches are moved there (one or two
    batches later), so that the landing that has to be listed stays small.

    A batch that was merged before the run stopped comes again. Its keyed rows match themselves; so that
    its rows without a key are not added twice, finished batches are
    remembered: by a table by name in the publication itself, exactly; for a folder (and a plain
    catalog table) by a marker in the stream's checkpoint folder, written after the merge.

    ``dated_folders`` reads ``<landing>/<yyyy-MM-dd>/`` folders, which a file
    stream does not find below a plain path.

    Two rows with one key in a batch stop the run, as a MERGE would, unless
    ``key_order`` gives the columns or expressions that pick one (smallest
    first; ``-F.col("last_contact")`` keeps the newest report).
    Returns a summary of the run: batches, rows merged and the history
    partitions touched (None: all, as on a first run).
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    ensure_checkpoint_dir(spark)
    stream = read_documents(reader, f"{landing.rstrip('/')}/*-*-*" if dated_folders else landing, multi_line)
    stats = {"batches": 0, "rows_merged": 0, "touched": []}
    ledger = _Ledger(spark, history, checkpoint)

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        if ledger.finished(epoch_id):
            return
        docs = one_copy(batch.select(*[f.name for f in RAW_SCHEMA.fields]))
        rows = with_history_partition(snapshot_rows(docs, ingested_at, box))
        # The merge writes its source once to the shared checkpoint folder.
        result = merge_into(batch.sparkSession, history, rows, dedup_order=key_order, note=ledger.note(epoch_id))
        ledger.finish(epoch_id)
        stats["batches"] += 1
        stats["rows_merged"] += result["rows_written"]
        known = stats["touched"]
        stats["touched"] = (None if known is None or result["touched"] is None
                            else known + [v for v in result["touched"] if v not in known])

    query = (stream.writeStream
             .foreachBatch(merge_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return stats


class _Ledger:
    """Which batches of a stream are in the history."""

    def __init__(self, spark: SparkSession, history: str, checkpoint: str):
        self.spark, self.history, self.by_name = spark, history, not named.is_path(history)
        # One stream is one checkpoint folder, under whatever spelling of its path.
        fs, folder = hadoop_fs(spark, checkpoint)
        self.key = "epoch." + hashlib.sha256(fs.makeQualified(folder).toString().rstrip("/").encode()).hexdigest()[:16]
        self.marker = f"{checkpoint.rstrip('/')}/merged_epoch"

    def note(self, epoch_id: int) -> dict[str, str] | None:
        return {self.key: str(epoch_id)} if self.by_name else None

    def finished(self, epoch_id: int) -> bool:
        table = named.find(self.spark, self.history) if self.by_name else None
        noted = table is not None and epoch_id <= int(table.notes.get(self.key, -1))
        return noted or folder_exists(self.spark, f"{self.marker}/{epoch_id}")

    def finish(self, epoch_id: int) -> None:
        fs, marker = hadoop_fs(self.spark, f"{self.marker}/{epoch_id}")
        fs.create(marker, True).close()
        fs.delete(hadoop_fs(self.spark, f"{self.marker}/{epoch_id - 1}")[1], False)     # only the last can come again
