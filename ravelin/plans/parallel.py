"""The corrections along a document with its rows in several tasks, whose SQL is that of the scans, and the lexicon by loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.operators import lexicon, ranges, spelling
from ravelin.plans import fixtures
from ravelin.plans.registry import ORACLES, query
from ravelin.sources.stored import shared_folder, written


@query(ORACLES["monotonic_fix"])
def monotonic_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.monotonic(fixtures.blocks(spark, sf_dir))


@query(ORACLES["tape_dead_reckoning"])
def tape_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.tapes(fixtures.pages(spark, sf_dir))


@query("""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word FROM w),
bigrams AS (SELECT a || ' ' || b AS bigram FROM (SELECT unnest(w[1:len(w) - 1]) AS a, unnest(w[2:len(w)]) AS b FROM w WHERE len(w) > 1) x)
SELECT 'word' AS kind, word AS term, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM words GROUP BY word
UNION ALL SELECT 'bigram', bigram, count(*), NULL FROM bigrams GROUP BY bigram""")
def lexicon_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts after three loads of the documents, one of them stored twice and two made one, equal a recount of all."""
    path, documents = shared_folder(spark, "lexicon"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    third = lambda k: documents.where(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3)) == k)
    lexicon.store(third(0), path, "first")
    lexicon.store(third(1), path, "second")
    lexicon.store(third(1), path, "second")
    lexicon.compact(spark, path)
    lexicon.store(third(2), path, "third")
    return lexicon.all_counts(spark, path)


@query("""WITH w AS (SELECT regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents),
counts AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM w) x GROUP BY word),
said AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM conversations)
SELECT conv_id, turn, count(*) AS words, count(*) FILTER (n IS NULL) AS unknown, CAST(coalesce(sum(n), 0) AS BIGINT) AS seen
FROM said LEFT JOIN counts ON counts.word = said.word GROUP BY conv_id, turn""")
def known_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each turn the documents know, and how often they have them."""
    counted = written(spelling.word_totals(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(F.col("word").alias("term"), "n"), "word-totals")
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    said = turns.select("conv_id", "turn", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1))).alias("word"))
    told = lexicon.with_counts(said, counted, "word")
    return told.groupBy("conv_id", "turn").agg(F.count("*").alias("words"), F.count_if(F.col("n") == 0).alias("unknown"), F.sum("n").alias("seen"))
