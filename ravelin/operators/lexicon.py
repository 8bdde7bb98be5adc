"""A lexicon kept up to date: counts of words and bigrams by load, added up when they are read.

A load is a set of documents that is counted once, by itself; its counts are partitions of the stored table. A load that is stored
again replaces itself, so a repeated or interrupted load changes nothing, and loads may come in any order. ``compact`` makes
one load of many. Terms with a large share of all counts are few by that share; joins on terms send these to where the rows
are, and only the rest through a shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.operators.terms import term_counts

SCHEMA = "term string, n long, n_docs long, load string, kind string"
#: Terms of one in so many of all counts, or more, are heavy; there are at most as many.
HEAVY = 1000
MERGED = "merged"


def kind_of(term: str) -> Column:
    """Words have no blank in them, bigrams have one."""
    return F.when(F.col(term).contains(" "), "bigram").otherwise("word")


def store(documents: DataFrame, path: str, load: str) -> None:
    """Count ``documents`` (doc_id, text) as the load of that name."""
    # A row without a term in each partition, so that a load without words replaces one that had some.
    marks = documents.sparkSession.createDataFrame([("word",), ("bigram",)], "kind string").select(F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("n_docs"), "kind")
    rows = term_counts(documents).withColumn("kind", kind_of("term")).unionByName(marks).withColumn("load", F.lit(load)).select("term", "n", "n_docs", "load", "kind")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load", "kind").parquet(path)


def all_counts(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """(kind, term, n, n_docs) over all loads; a document is in one load only, so documents add up as well."""
    stored = spark.read.schema(SCHEMA).parquet(path).where(F.col("term").isNotNull())
    stored = stored if kind is None else stored.where(F.col("kind") == kind)
    return stored.groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")).select(kind_of("term").alias("kind"), "term", "n", "n_docs")


def counts(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(term, n, n_docs) of that kind over all loads."""
    return all_counts(spark, path, kind).drop("kind")


def compact(spark: SparkSession, path: str) -> None:
    """All loads become one. Loads can be stored on top of it, but those in it not again.

    The merged table is written beside ``path`` and takes its place by renaming; where that is cut short, it is still there.
    """
    fresh = f"{path.rstrip('/')}-merged-{uuid.uuid4().hex}"
    merged = all_counts(spark, path).withColumn("load", F.lit(MERGED))
    merged.select("term", "n", "n_docs", "load", "kind").write.partitionBy("load", "kind").parquet(fresh)
    jvm = spark._jvm
    old, new = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, fresh))
    files = old.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.delete(old, True)
    if not files.rename(new, old):
        raise OSError(f"{fresh} could not be renamed to {path}")


def with_counts(rows: DataFrame, counted: DataFrame, key: str) -> DataFrame:
    """``rows`` with n, the count of the term in ``key`` (0 where there is none), skewed as terms are.

    The counts add up to their total, so heavy terms are at most ``HEAVY``; they are broadcast, and all other rows joined by term.
    """
    total = counted.agg(F.sum("n")).first()[0] or 0
    heavy = F.broadcast(counted.where(F.col("n") * HEAVY >= F.lit(total)).select(F.col("term").alias(key), F.col("n").alias("heavy")))
    told = rows.join(heavy, key, "left")
    rest = told.where(F.col("heavy").isNull()).drop("heavy").join(counted.select(F.col("term").alias(key), "n"), key, "left")
    return told.where(F.col("heavy").isNotNull()).withColumnRenamed("heavy", "n").unionByName(rest.withColumn("n", F.coalesce("n", F.lit(0))))
