"""The timestamp index as a table keyed by page: a run over some pages replaces theirs and leaves the others.

Pages lie in partitions by document and ``PAGES`` page numbers. An upsert reads the partitions it touches, and overwrites
only these; a run that is repeated writes the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ravelin.sources.stored import written

#: Page numbers of a partition.
PAGES = 100
SCHEMA = "page_num long, timestamps array<string>, document string, part long"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a folder or file, in any file system that Spark knows."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def _part(page_num: str = "page_num"):
    return F.floor(F.col(page_num) / PAGES).cast("long")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(document, page_num, timestamps) of the index; an index that was never written has no pages."""
    if not exists(spark, path):
        return spark.createDataFrame([], StructType.fromDDL(SCHEMA)).select("document", "page_num", "timestamps")
    return spark.read.schema(SCHEMA).parquet(path).select("document", "page_num", "timestamps")


def upsert(lists: DataFrame, path: str, whole: bool = False) -> None:
    """Put the pages of ``lists`` (document, page_num, timestamps) in the place of those of the same number.

    ``whole`` leaves no other page of any document.
    """
    spark = lists.sparkSession
    new = lists.select(F.col("page_num").cast("long"), "timestamps", F.col("document").cast("string")).withColumn("part", _part())
    if not whole and exists(spark, path):
        new = written(new, "times-new")  # what is read below is about to be overwritten
        old = spark.read.schema(SCHEMA).parquet(path)
        touched = old.join(new.select("document", "part").distinct(), ["document", "part"], "left_semi")
        kept = touched.join(new.select("document", "page_num"), ["document", "page_num"], "left_anti")
        new = written(new.unionByName(kept), "times-merged")
    mode = "static" if whole else "dynamic"
    new.repartition("document", "part").write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("document", "part").parquet(path)
