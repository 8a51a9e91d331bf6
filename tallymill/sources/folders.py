"""Folders of any file system that Spark can reach."""

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    """Hadoop's path and its file system."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def entries(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """(path, is a folder) of what lies directly in a folder; one listing."""
    path, system = _path(spark, folder)
    if not system.exists(path):
        raise FileNotFoundError(f"no such folder: {folder}")
    return [(s.getPath().toString(), s.isDirectory()) for s in system.listStatus(path)]


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, system = _path(spark, path)
    return system.exists(hadoop)


def drop(spark: SparkSession, path: str) -> None:
    hadoop, system = _path(spark, path)
    system.delete(hadoop, True)


def make_until_exit(spark: SparkSession, path: str) -> None:
    """Make a folder that goes when this application ends, whether it fails or not."""
    hadoop, system = _path(spark, path)
    system.mkdirs(hadoop)
    system.deleteOnExit(hadoop)
