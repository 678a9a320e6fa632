SF_SMALL = "/root/testdata/sf0.001"


def events_small(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")
