"""Folders that every executor can reach."""

import tempfile
import uuid

from pyspark.sql import SparkSession

from tallymill.sources.folders import make_until_exit

_RUNS: dict[str, str] = {}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one the cluster names in spark.checkpoint.dir.

    Where that is unset a local session, as in tests, gets a temporary folder;
    on a cluster there is no safe guess.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tallymill-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def run_folder(spark: SparkSession) -> str:
    """The folder of this application below the shared one; it goes when that ends."""
    application = spark.sparkContext.applicationId
    if application not in _RUNS:
        _RUNS[application] = shared_folder(spark, "run")
        make_until_exit(spark, _RUNS[application])
    return _RUNS[application]
