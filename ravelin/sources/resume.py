"""Work by page that can be taken up again: what is done is written down, step by step.

The manifest is a table of (document, page_num, hash). A start leaves out the pages that it has with the same hash of
their input, and does the others in steps; a step's pages are written down once its results are in place. A run that is killed
between the two does that step again, so results must be such that writing them again changes nothing, as page files are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.sources.stored import written
from ravelin.sources.timeindex import exists

#: Pages of a step, about.
STEP = 500
SCHEMA = "document string, page_num long, hash string"


def done_pages(spark: SparkSession, manifest: str) -> DataFrame:
    """(document, page_num, hash) of the manifest; one that was never written is empty."""
    return spark.read.schema(SCHEMA).parquet(manifest) if exists(spark, manifest) else spark.createDataFrame([], SCHEMA)


def keyed(pages: DataFrame, hashed: Column) -> DataFrame:
    return pages.withColumns({"_document": F.col("document").cast("string"), "_page": F.col("page_num").cast("long"), "_hash": hashed})


def pending(pages: DataFrame, hashed: Column, manifest: str) -> DataFrame:
    """The rows of ``pages`` (document, page_num, ...) that are not done with this ``hashed`` input."""
    done = done_pages(pages.sparkSession, manifest).select(F.col("document").alias("_document"), F.col("page_num").alias("_page"), F.col("hash").alias("_hash")).distinct()
    return keyed(pages, hashed).join(done, ["_document", "_page", "_hash"], "left_anti").select(*pages.columns)


def in_steps(pages: DataFrame, hashed: Column, manifest: str, work: Callable[[DataFrame], DataFrame], step: int = STEP) -> int:
    """Do ``work`` on what is pending, and return in how many steps.

    ``work`` puts the results of its pages in place and returns the (document, page_num) of those that are done; the others are
    pending again at the next start.
    """
    left = pending(pages, hashed, manifest).select("document", "page_num", hashed.alias("hash"))
    left = written(left, "pending")
    steps = -(-left.count() // step)
    dealt = F.pmod(F.xxhash64(F.col("document").cast("string"), F.col("page_num").cast("long")), F.lit(max(1, steps)))
    for i in range(steps):
        keys = left.where(dealt == i)
        done = work(pages.join(keys.drop("hash"), ["document", "page_num"], "left_semi"))
        finished = keys.join(done.select("document", "page_num").distinct(), ["document", "page_num"], "left_semi")
        finished.select(F.col("document").cast("string"), F.col("page_num").cast("long"), "hash").write.mode("append").parquet(manifest)
    return steps
