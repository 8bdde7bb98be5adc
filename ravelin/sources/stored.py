"""Tables and folders that a query writes for itself, below the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of local sessions that name none, by application.
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path below ``spark.checkpoint.dir``; only a session in one process may leave that unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local:
            _local[app] = tempfile.mkdtemp(prefix="ravelin-")
            atexit.register(shutil.rmtree, _local[app], ignore_errors=True)
        base = "file://" + _local[app]
    return f"{base.rstrip('/')}/ravelin/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written and read back, which cuts its lineage; a lost executor costs its own tasks only."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
