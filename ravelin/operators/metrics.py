"""What a run did: totals, times by stage, rates and time left, the last messages; measures of images."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Percentiles that become black and white.
BLACK, WHITE = 2, 98


def totals(results: DataFrame) -> DataFrame:
    """(document, total, succeeded, failed) of rows (document, page_num, error)."""
    return results.groupBy("document").agg(F.count("*").alias("total"), F.count_if(F.col("error").isNull()).alias("succeeded"), F.count_if(F.col("error").isNotNull()).alias("failed"))


def stage_seconds(timings: DataFrame) -> DataFrame:
    """(document, stage, pages, seconds) of rows (document, page_num, stage, seconds); nulls count as none."""
    return timings.groupBy("document", "stage").agg(F.count_distinct("page_num").alias("pages"), F.sum(F.coalesce("seconds", F.lit(0.0))).alias("seconds"))


def page_seconds(timings: DataFrame) -> DataFrame:
    """(document, page_num, seconds, stages): the sum over stages and the map of them."""
    per = timings.groupBy("document", "page_num", "stage").agg(F.sum("seconds").alias("seconds"))
    return per.groupBy("document", "page_num").agg(F.sum("seconds").alias("seconds"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("stage", "seconds")))).alias("stages"))


def progress(done: DataFrame) -> DataFrame:
    """``done`` (document, done, total, elapsed seconds) with pages a second and the seconds left; null before the first page."""
    rate = F.when((F.col("done") > 0) & (F.col("elapsed") > 0), F.col("done") / F.col("elapsed"))
    return done.withColumns({"rate": rate, "seconds_left": F.floor((F.col("total") - F.col("done")) / rate).cast("bigint")})


def last_lines(log: DataFrame, n: int = 14) -> DataFrame:
    """The newest ``n`` rows of each document of (document, seen, message)."""
    newest = Window.partitionBy("document").orderBy(F.desc("seen"), F.desc("message"))
    return log.withColumn("k", F.row_number().over(newest)).where(F.col("k") <= n).drop("k")


def median_angle(angles: DataFrame) -> DataFrame:
    """(document, page_num, angle): the median skew of a page's lines."""
    return angles.groupBy("document", "page_num").agg(F.median("angle").alias("angle"))


def stretch_points(pixels: DataFrame) -> DataFrame:
    """(document, page_num, black, white): the values that become black and white, of rows (document, page_num, value)."""
    at = lambda p: F.expr(f"percentile(value, {p / 100})")
    return pixels.groupBy("document", "page_num").agg(at(BLACK).alias("black"), at(WHITE).alias("white"))


def page_pixels(pages: DataFrame, dpi: int = 300) -> DataFrame:
    """``pages`` (width_pts, height_pts, ...) with their size in pixels."""
    px = lambda c: (F.col(c) * dpi / 72).cast("int")
    return pages.withColumns({"width_px": px("width_pts"), "height_px": px("height_pts")})
