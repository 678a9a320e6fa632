"""skyfold: snapshot data on Spark.

Read nested JSON snapshots, flatten positional vectors into typed rows, clean
and label them, profile their quality, upsert them by key into a partitioned
history table and build fact, dimension and daily summary tables from it.
Every operator takes and returns a DataFrame.
"""

__version__ = "0.1.0"
