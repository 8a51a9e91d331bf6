"""The report table: a scan of five columns, cleaned."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallymill.operators.clean import clean_reports


def read_reports(
    spark: SparkSession,
    table: str | None = None,
    path: str | None = None,
    source: str = "parquet",
    keep: Sequence[str] = (),
    **options: str,
) -> DataFrame:
    """Cleaned reports from a catalog table, or from any Spark source.

    Only the needed columns reach the scan.  Over JDBC pass ``source="jdbc"``
    with ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``, or one task will read everything.
    """
    if table is not None:
        raw = spark.read.table(table)
    else:
        raw = spark.read.format(source).options(**options).load(path)
    return clean_reports(raw, keep)
