"""Session settings that pay for this job."""

from pyspark.sql import SparkSession

# These may be set while a session runs.
RUN_SETTINGS = {
    # HotSpot compiles no method above 8000 bytes; let Spark split those.  The cleaning of
    # a row's many texts is one such method, and took twice as long interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The distinct keys of the increments and all lookups are dealt by unit, once; without
    # this, Spark deals them anew for each of the five joins.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A task that publishes has a file open for each table at once, and need not sort its
    # rows by table; beyond this number it does.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # What is staged and published takes less of the disk than with the default, snappy.
    "spark.sql.parquet.compression.codec": "zstd",
    # Shuffle files go when their query has ended, not when the driver next collects
    # garbage; a run is many queries.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

SETTINGS = RUN_SETTINGS | {
    # The default of 100 compiled classes is less than one run needs, and
    # compiling them again and again doubled the run time.
    "spark.sql.codegen.cache.maxEntries": "4000",
    # An oversized partition is split by adaptive execution: from 64 MB on, not from
    # 256 MB, if it is three times the median, into parts of about 32 MB.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
}


def tune(spark: SparkSession) -> None:
    """Apply RUN_SETTINGS to a session made elsewhere, except those it was started with."""
    given = spark.sparkContext.getConf()
    for key, value in RUN_SETTINGS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
