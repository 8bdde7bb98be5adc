"""Transcript views derived from the driver's tables by arithmetic that both engines understand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _div(x: str, k: int) -> str:
    return f"CAST(({x} - {x} % {k}) / {k} AS BIGINT)"


def timecode_sql(s: str) -> str:
    parts = [_div(s, 86400), _div(f"({s} % 86400)", 3600), _div(f"({s} % 3600)", 60), f"CAST({s} % 60 AS BIGINT)"]
    return " || ' ' || ".join(f"lpad(CAST({p} AS STRING), 2, '0')" for p in parts)


BLOCKS = f"""
SELECT document, page_num, block_idx, type, s, timestamp_clean,
  CASE WHEN k % 4 = 0 THEN replace(timestamp_clean, '0', 'O') WHEN k % 4 = 1 THEN replace(timestamp_clean, '1', 'I')
       WHEN k % 4 = 2 THEN replace(timestamp_clean, ' ', ':') ELSE timestamp_clean END AS timestamp_raw,
  CASE WHEN k % 6 = 0 THEN NULL WHEN role = 'assistant' THEN CASE WHEN k3 % 5 = 0 THEN 'C' ELSE 'CC' END
       WHEN conv_id % 3 = 0 THEN CASE WHEN k3 % 5 = 0 THEN 'CDF' ELSE 'CDR' END WHEN conv_id % 3 = 1 THEN 'CMP' ELSE 'LMP' END AS speaker,
  CASE conv_id % 8 WHEN 0 THEN 'EAGLE' WHEN 1 THEN 'TRANQ' WHEN 2 THEN 'LAUGHTER' WHEN 3 THEN '04 08' ELSE NULL END AS location,
  text
FROM (SELECT *, {timecode_sql("s")} AS timestamp_clean FROM (
  SELECT *, CAST(CASE WHEN (conv_id * 5 + turn) % 13 = 0 THEN base_s - 7200 WHEN (conv_id * 5 + turn) % 9 = 0 THEN base_s - 45 ELSE base_s END AS BIGINT) AS s FROM (
    SELECT conv_id, role, text, conv_id + turn AS k, conv_id * 3 + turn AS k3, turn, turn AS block_idx,
      {_div("conv_id", 10)} AS document, conv_id % 10 + 1 AS page_num,
      86400 + (conv_id % 10 + 1) * 600 + turn * 37 AS base_s,
      CASE WHEN role = 'system' THEN 'meta' WHEN (conv_id * 7 + turn) % 11 = 0 THEN 'annotation' ELSE 'comm' END AS type
    FROM {{conversations}}) a) b) c
"""

#: ``BLOCKS`` with more annotations between comm blocks: five of seven blocks in a third of the pages.
KINDS = f"""
SELECT * REPLACE (CASE WHEN (document + page_num) % 3 = 0 AND block_idx % 7 IN (1, 2, 3, 4, 5) AND type = 'comm' THEN 'annotation' ELSE type END AS type) FROM ({BLOCKS}) k
"""
#: ``BLOCKS``, and every third block's text again as an annotation behind it, with other blanks and another end; each page begins
#: and ends with the same remark, and has two blank ones at its end.
REMARKS = f"""
SELECT document, page_num, block_idx * 2 AS block_idx, CASE WHEN block_idx % 3 = 0 THEN 'annotation' ELSE type END AS type, text FROM ({BLOCKS}) a
UNION ALL SELECT document, page_num, block_idx * 2 + 1 AS block_idx, 'annotation' AS type, replace(text, ' ', ' - ') || CASE WHEN block_idx % 2 = 0 THEN ' !' ELSE ' x' END AS text FROM ({BLOCKS}) b WHERE block_idx % 3 = 0
UNION ALL SELECT DISTINCT document, page_num, -1 AS block_idx, 'annotation' AS type, 'Same - remark' AS text FROM ({BLOCKS}) c
UNION ALL SELECT DISTINCT document, page_num, 100000 AS block_idx, 'annotation' AS type, '' AS text FROM ({BLOCKS}) d
UNION ALL SELECT DISTINCT document, page_num, 100001 AS block_idx, 'annotation' AS type, '' AS text FROM ({BLOCKS}) e
UNION ALL SELECT DISTINCT document, page_num, 100002 AS block_idx, 'annotation' AS type, 'SAME remark!' AS text FROM ({BLOCKS}) f
"""

PAGES = f"""
SELECT DISTINCT {_div("conv_id", 10)} AS document, conv_id % 10 + 1 AS page_num, conv_id % 7 = 6 AS end_of_tape,
  CASE WHEN conv_id % 5 = 0 THEN NULL WHEN conv_id % 5 = 1 THEN 'x'
       ELSE CAST({_div("(conv_id % 10)", 3)} + 1 AS STRING) || '/' || CAST(conv_id % 3 + 2 AS STRING) END AS ocr_tape
FROM {{conversations}}
"""

STATIONS = """
SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'AND ' WHEN 1 THEN 'THE ' ELSE '' END || replace(upper(n_name), '_', ' ') AS station
FROM {nation}
"""


def _view(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    return spark.sql(sql, **{name: spark.read.parquet(f"{sf_dir}/{name}.parquet")})


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, BLOCKS, "conversations")


def kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocks(spark, sf_dir)
    more = F.expr("(document + page_num) % 3 = 0 AND block_idx % 7 IN (1, 2, 3, 4, 5) AND type = 'comm'")
    return rows.withColumn("type", F.when(more, "annotation").otherwise(F.col("type")))


def remarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, REMARKS, "conversations")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, PAGES, "conversations")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, STATIONS, "nation")
