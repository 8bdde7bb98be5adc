"""The corrections along a document as streams, over tables that are fed to them piece by piece.

Each query writes its table in pieces, starts the stream anew for every one of them on the same checkpoint, and returns what
the stream wrote: the rows that the scan over the whole table gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.plans import fixtures, transcripts
from ravelin.plans.registry import ORACLES, query
from ravelin.sources.stored import shared_folder, written
from ravelin.streaming import pages

#: Pieces of a table, seconds from one to the next, and seconds that a page waits.
PIECES, APART, PATIENCE = 4, 1000, 500


def fed(spark: SparkSession, rows: DataFrame, label: str, stream: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``stream`` wrote of ``rows`` (with ``piece``, from 0), one start for each piece and one when time has passed."""
    session = spark.newSession()  # its settings are its own
    for key, value in pages.STATE_STORE.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    top = shared_folder(spark, label)
    held = written(rows.withColumn("arrived", F.timestamp_seconds((F.col("piece") + 1) * APART)), label)
    tick = spark.range(1).select(F.lit(PIECES).alias("piece"), F.timestamp_seconds(F.lit((PIECES + 20) * APART)).alias("arrived"))
    schema = held.drop("piece").schema
    for i in range(PIECES + 1):
        piece = held.where(F.col("piece") == i) if i < PIECES else held.limit(0).unionByName(tick, allowMissingColumns=True)
        piece.drop("piece").write.mode("append").parquet(f"{top}/in/{i}")
        source = session.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{top}/in").withWatermark("arrived", "1 second")
        run = stream(source).writeStream.format("parquet").option("checkpointLocation", f"{top}/state").option("path", f"{top}/out").trigger(availableNow=True).start()
        run.awaitTermination()
    return spark.read.parquet(f"{top}/out")


@query(ORACLES["timestamp_correction"])
def timestamp_correction_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts go through the middle of pages."""
    rows = fixtures.kinds(spark, sf_dir).select("document", "page_num", "block_idx", "type", F.expr(transcripts._BLANKED).alias("timestamp"))
    piece = F.least(F.call_function("div", F.col("page_num") * 10 + F.least("block_idx", F.lit(9)) - 10, F.lit(27).cast("long")), F.lit(PIECES - 1)).cast("int")
    return fed(spark, rows.withColumn("piece", piece), "clock", lambda s: pages.corrected_times_stream(s, patience=PATIENCE))


@query(ORACLES["tape_dead_reckoning"])
def tape_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages come in an order of their own: those of one remainder together."""
    block = F.struct(F.lit("meta").alias("type"), F.when(F.col("end_of_tape"), "** End of tape **").otherwise("go").alias("text"))
    rows = fixtures.pages(spark, sf_dir).select("document", "page_num", "ocr_tape", F.array(block).alias("blocks"))
    piece = ((F.col("page_num") * 7 + F.col("document")) % PIECES).cast("int")
    return fed(spark, rows.withColumn("piece", piece), "tapes", lambda s: pages.tapes_stream(s, patience=PATIENCE * 10))
