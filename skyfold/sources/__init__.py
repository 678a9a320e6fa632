"""Sources and sinks."""

from skyfold.sources.parquet import (  # noqa: F401
    drop_staging, load_staging, path_exists, write_partitions,
)
from skyfold.sources.snapshots import (  # noqa: F401
    DATE_PARTITION, land_snapshots, non_empty, pack_snapshots, read_snapshots,
    one_copy, select_day, snapshot_day, with_copy,
)
