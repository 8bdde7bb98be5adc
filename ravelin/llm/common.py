"""Shared plumbing: written intermediate tables, worker functions, worker caches, row splits.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir``, a folder that the
driver and all executors share; a lost executor then only costs its own tasks.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.shipping import ship

#: Rows that a worker function sees at a time; texts can be long, and the session's own batches of them are too much.
BATCH_ROWS = 2000
#: Folders of local sessions that name none, and written tables that a result may still read, by application.
_local: dict[str, str] = {}
_written: dict[str, dict[str, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], ddl: str) -> DataFrame:
    """``df.mapInArrow`` with the package shipped, and batches of at most ``BATCH_ROWS`` rows."""
    ship(df.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (b.slice(i, BATCH_ROWS) for b in batches for i in range(0, b.num_rows, BATCH_ROWS))

    return df.mapInArrow(lambda batches: run(cut(batches)), ddl)


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables; only a session that runs in one process may leave it unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local:
            _local[app] = tempfile.mkdtemp(prefix="ravelin-")
            atexit.register(shutil.rmtree, _local[app], ignore_errors=True)
        base = "file://" + _local[app]
    return base.rstrip("/") + "/ravelin"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``discard`` or ``release`` deletes it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._ravelin_path = path
    _written.setdefault(spark.sparkContext.applicationId, {})[path] = out
    return out


def discard(df: DataFrame | None) -> None:
    """Delete a table made by ``materialize`` that nothing will read any more."""
    path = getattr(df, "_ravelin_path", None)
    if path:
        jvm, spark = df.sparkSession._jvm, df.sparkSession
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
        _written.get(spark.sparkContext.applicationId, {}).pop(path, None)


def release(spark: SparkSession, keep: set[str] | None = None) -> None:
    """Delete all written tables but those of the paths in ``keep``; results that read them end here.

    An operator's result is lazy and may read tables that it wrote; whoever has consumed the result calls this.
    """
    for path, df in list(_written.get(spark.sparkContext.applicationId, {}).items()):
        if path not in (keep or ()):
            discard(df)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables written inside go at the end, also after an error, but for those given to the function that it yields."""
    stay = set(_written.get(spark.sparkContext.applicationId, {}))

    def keep(df: DataFrame) -> DataFrame:
        stay.add(df._ravelin_path)
        return df

    try:
        yield keep
    finally:
        release(spark, stay)


_worker_caches: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """A table that outlives tasks in a Python worker; the tables of other owners are let go."""
    for name, held in _worker_caches.items():
        if name != owner:
            held.clear()
    return _worker_caches.setdefault(owner, {})


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``divisor``; a null id counts as remainder -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % divisor, F.lit(-1))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name like ``wanted`` that ``df`` doesn't have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
