"""More named queries: mission time, speakers, lines of page text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.functions import lines
from ravelin.operators import corrections, pages, similar, spelling, stitches
from ravelin.plans import fixtures
from ravelin.plans.registry import KINDS, V1, query

_BLANKED = "CASE WHEN (page_num + block_idx) % 5 = 0 THEN NULL ELSE timestamp_clean END"


@query(f"""WITH RECURSIVE v AS (SELECT *, CASE WHEN type <> 'comm' OR (page_num + block_idx) % 5 = 0 THEN NULL ELSE s END AS tm FROM ({KINDS}) x),
u AS (SELECT document, page_num, block_idx, type, tm, list_filter(list(tm) OVER (PARTITION BY document, page_num ORDER BY block_idx ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING), lambda t: t IS NOT NULL) AS r FROM v),
w AS (SELECT document, page_num, block_idx, tm, r, row_number() OVER (PARTITION BY document ORDER BY page_num, block_idx) AS rn FROM u WHERE type = 'comm'),
c AS (SELECT *, coalesce(len(r) >= 3 AND r[2] > r[1] AND r[3] > r[2] AND r[2] - r[1] <= 600 AND r[3] - r[2] <= 600, FALSE) AS stable FROM w),
f AS (
  SELECT document, CAST(0 AS BIGINT) AS rn, CAST(-1 AS BIGINT) AS page_num, CAST(0 AS BIGINT) AS block_idx, CAST(NULL AS BIGINT) AS tm, CAST(NULL AS BIGINT) AS fixed, CAST(NULL AS BIGINT) AS cursor, FALSE AS begun, CAST(NULL AS BIGINT) AS listed, CAST(NULL AS STRING) AS correction
  FROM (SELECT DISTINCT document FROM c) d
  UNION ALL
  SELECT document, rn, page_num, block_idx, tm, res,
    CASE WHEN k = 'out_of_order' THEN l ELSE coalesce(res, l) END, CASE WHEN k IN ('corrected_hour', 'inferred_tens') THEN b WHEN res IS NULL THEN b ELSE TRUE END, coalesce(res, listed), k FROM (
    SELECT *, CASE k WHEN 'inferred_missing' THEN l + 1 WHEN 'inferred_monotonic' THEN l + 1 WHEN 'corrected_jump' THEN l + 1 WHEN 'corrected_hour' THEN snap WHEN 'inferred_tens' THEN tm + 40 ELSE tm END AS res FROM (
      SELECT *, CASE WHEN tm IS NULL AND l IS NULL THEN NULL WHEN tm IS NULL THEN 'inferred_missing' WHEN l IS NULL THEN NULL
        WHEN tm - l < -3600 AND (NOT b OR stable) THEN 'sequence_reset'
        WHEN tm - l > 3600 AND snap IS NOT NULL THEN 'corrected_hour'
        WHEN tm <= l AND tm // 60 = l // 60 AND l % 60 < 20 AND tm % 60 + 40 <= 59 AND tm + 40 - l BETWEEN 1 AND 60 THEN 'inferred_tens'
        WHEN tm - l < -300 AND snap IS NOT NULL THEN 'corrected_hour' WHEN tm - l < -300 THEN 'inferred_monotonic' WHEN tm <= l THEN 'out_of_order'
        WHEN tm - l > 43200 AND tm // 86400 = l // 86400 THEN 'corrected_jump' END AS k FROM (
        SELECT *, CASE WHEN tm // 86400 = l // 86400 THEN list_min(list_filter([tm - tm % 86400 + (l % 86400 // 3600 - 1) * 3600 + tm % 3600, tm - tm % 86400 + (l % 86400 // 3600) * 3600 + tm % 3600, tm - tm % 86400 + (l % 86400 // 3600 + 1) * 3600 + tm % 3600],
          lambda t: t > l AND t - l <= 600 AND t // 86400 = l // 86400)) END AS snap FROM (
          SELECT c.*, f.listed, CASE WHEN c.page_num <> f.page_num THEN f.listed ELSE f.cursor END AS l, CASE WHEN c.page_num <> f.page_num THEN FALSE ELSE f.begun END AS b
          FROM f JOIN c ON c.document = f.document AND c.rn = f.rn + 1) x1) x2) x3) x4)
SELECT document, page_num, block_idx, CASE WHEN tm IS NOT NULL THEN {fixtures.timecode_sql("tm")} END AS timestamp, CASE WHEN fixed IS NOT NULL THEN {fixtures.timecode_sql("fixed")} END AS fixed, correction FROM f WHERE rn > 0""")
def timestamp_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrections.corrected_times(fixtures.kinds(spark, sf_dir).withColumn("timestamp", F.expr(_BLANKED)))


_NUMBERED = "'04 05 06 07 ' || coalesce(text, '')"


@query(f"""WITH RECURSIVE c AS (SELECT document, page_num, block_idx, trim({_NUMBERED}) AS text, CASE WHEN speaker = 'C' THEN 'CC' WHEN speaker = 'CDF' THEN 'CDR' ELSE speaker END AS told,
  row_number() OVER (PARTITION BY document, page_num ORDER BY block_idx) AS rn FROM ({V1}) v WHERE type = 'comm'),
f AS (
  SELECT document, page_num, CAST(0 AS BIGINT) AS block_idx, CAST(0 AS BIGINT) AS rn, '' AS speaker, '' AS text, CAST(NULL AS STRING) AS voice, CAST(NULL AS STRING) AS crew FROM (SELECT DISTINCT document, page_num FROM c) d
  UNION ALL
  SELECT document, page_num, block_idx, rn, coalesce(found, ''), text, coalesce(found, voice), CASE WHEN found IN ('CDR', 'CMP', 'LMP') THEN found ELSE crew END FROM (
    SELECT c.*, f.voice, f.crew, coalesce(c.told, CASE WHEN f.voice = 'CC' THEN f.crew WHEN f.voice IN ('CDR', 'CMP', 'LMP') THEN 'CC' END) AS found
    FROM f JOIN c ON c.document = f.document AND c.page_num = f.page_num AND c.rn = f.rn + 1) x)
SELECT document, page_num, block_idx, speaker, text FROM f WHERE rn > 0""")
def speaker_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whose turn it is where no speaker was read; each text is taken whole, behind four numbers that name nobody."""
    told = fixtures.blocks(spark, sf_dir).withColumn("text", F.expr(_NUMBERED))
    return corrections.corrected_speakers(told)


_LINE = """CASE (conv_id + turn) % 12 WHEN 0 THEN 'Tape 12/3  Page 45' WHEN 1 THEN 'PAGE ' || CAST(conv_id AS STRING) WHEN 2 THEN 'GOSS NET 1' WHEN 3 THEN 'TIG 12 04 05 06 07' WHEN 4 THEN 'Pnrc 107'
  WHEN 5 THEN '(60:33 NOT 1)' WHEN 6 THEN 'LOS at ' || CAST(turn AS STRING) WHEN 7 THEN '... and ' || coalesce(text, '') WHEN 8 THEN 'go for the bur-' WHEN 9 THEN 'REST PERIOD - NO COMMUNICATIONS'
  WHEN 10 THEN 'AIR-TO-GROUND VOICE' ELSE coalesce(text, '') END"""


@query(f"""SELECT conv_id, turn, regexp_matches(upper(x), '{lines.HEADER_WORDS}') AS header_word, regexp_matches(upper(x), '{lines.TRANSITIONS}') AS transition, regexp_matches(x, '{lines.IGNITION}') AS ignition,
  regexp_matches(x, '{lines.HEADER_ONLY}') AS header_only, length(x) <= 60 AND ((length(trim(x)) < 15 AND regexp_matches(trim(x), '{lines.GARBLED_SHORT}')) OR regexp_matches(x, '{lines.GARBLED_LABEL}')) AS garbled,
  length(trim(x)) <= 36 AND (regexp_matches(upper(trim(x)), '{lines.NOT_ONE}') OR regexp_matches(upper(trim(x)), '{lines.NOT_ONE_SHORT.replace("'", "''")}')) AS not_one,
  regexp_matches(x, '^(\\p{{Ll}}|\\.\\.\\.)') AS continued,
  length(rtrim(x)) >= 3 AND (suffix(rtrim(x), '-') OR (regexp_matches(rtrim(x), '\\p{{Ll}}$') AND length(regexp_split_to_array(rtrim(x), '\\s+')[-1]) > 2)) AS truncated
FROM (SELECT conv_id, turn, {_LINE} AS x FROM conversations) l""")
def line_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", F.expr(_LINE).alias("x"))
    tests = {"header_word": lines.has_header_word, "transition": lines.has_transition, "ignition": lines.is_ignition_time, "header_only": lines.is_header_only, "garbled": lines.is_garbled_label, "not_one": lines.is_not_one, "continued": lines.starts_continuation, "truncated": lines.looks_truncated}
    return rows.select("conv_id", "turn", *(f(F.col("x")).alias(name) for name, f in tests.items()))


_MODE = "CASE conv_id % 6 WHEN 0 THEN 'P0O' WHEN 1 THEN 'PS2' WHEN 2 THEN 'p1' WHEN 3 THEN 'PXX' WHEN 4 THEN 'Q12' ELSE 'P' END"


@query("SELECT conv_id, turn, CASE conv_id % 6 WHEN 0 THEN 'P00' WHEN 1 THEN 'P52' WHEN 2 THEN 'P10' END AS mode FROM conversations")
def program_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", lines.program_mode(F.expr(_MODE)).alias("mode"))


_REST = "CASE conv_id % 4 WHEN 0 THEN '12 go Page 12/3' WHEN 1 THEN '** End of  Tape ** go' WHEN 2 THEN 'go 12/345 for 7' ELSE 'go' END"


@query("SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN 'go' WHEN 1 THEN 'go' WHEN 2 THEN 'go  for' ELSE 'go' END AS rest FROM conversations")
def footer_rests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", lines.without_footer_rest(lines.without_tape_end(F.expr(_REST))).alias("rest"))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text per page as a reader would see it: labels, then a line per block."""
    rows = fixtures.blocks(spark, sf_dir)
    line = F.concat_ws(" ", "timestamp_raw", "speaker", "text")
    lines_ = F.transform(F.sort_array(F.collect_list(F.struct("block_idx", line.alias("t")))), lambda x: x["t"])
    body = rows.groupBy("document", "page_num").agg(F.array_join(lines_, "\n").alias("body"))
    label = F.concat(F.lit("Tape 1/"), F.col("page_num").cast("string"), F.lit("\nPage "), F.col("page_num").cast("string"))
    return body.select("document", "page_num", F.concat_ws("\n", label, "body").alias("text"))


@query()
def parse_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.parsed(page_texts(spark, sf_dir))


@query()
def pass_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reading with gaps and cut texts, filled from one that is whole but names fewer speakers."""
    comm = fixtures.blocks(spark, sf_dir).where("type = 'comm'").withColumn("timestamp", F.col("timestamp_clean"))
    cut = F.when(F.col("block_idx") % 2 == 1, F.substring("text", 1, 40)).otherwise(F.col("text"))
    preferred = comm.where((F.col("document") + F.col("page_num") + F.col("block_idx")) % 5 != 0).withColumn("text", cut)
    fallback = comm.withColumn("speaker", F.when(F.col("block_idx") % 3 != 0, F.col("speaker")))
    return pages.merged_passes(preferred, fallback)


@query()
def stitched_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stitches.stitched(pages.parsed(page_texts(spark, sf_dir)))


@query(f"""WITH b AS (SELECT document, page_num, string_agg('> ' || trim(text) || chr(10), chr(10) ORDER BY block_idx) FILTER (type <> 'comm' AND trim(text) <> '') AS remarks,
  string_agg('| ' || replace(timestamp_clean, ' ', ':') || ' | ' || coalesce(speaker, '—') || ' | ' || coalesce(location, '') || ' | ' || replace(coalesce(trim(text), ''), '|', '\\|') || ' |', chr(10) ORDER BY block_idx) FILTER (type = 'comm') AS tab
  FROM ({V1}) v GROUP BY ALL),
p AS (SELECT document, page_num, concat_ws(chr(10), '## Page ' || CAST(page_num AS STRING) || chr(10), remarks,
  '| Time | Speaker | Location | Dialogue |' || chr(10) || '|:-----|:--------|:---------|:---------|' || chr(10) || tab || chr(10), '---' || chr(10)) AS body FROM b)
SELECT document, count(*) AS page_count, '# ' || CAST(document AS STRING) || ' Transcript' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || string_agg(body, chr(10) ORDER BY page_num) AS markdown FROM p GROUP BY document""")
def render_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stitches.rendered_markdown(fixtures.blocks(spark, sf_dir), "timestamp_clean")


@query()
def spelling_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations against all words of the documents."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return spelling.table_suggestions(spelling.word_pairs(turns), spelling.word_counts(documents).select("word", "n"), lambda asked: spelling.bigram_counts(documents, asked))


_LETTERS = "SELECT word, len(word) AS n, unnest(string_split(word, '')) AS c FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM {table}) w"


@query(f"""WITH a AS (SELECT word AS low, n AS la, c, count(*) AS k FROM ({_LETTERS.format(table="benchmark")}) x WHERE n >= 3 GROUP BY ALL),
b AS (SELECT word, n AS lb, c, count(*) AS k FROM ({_LETTERS.format(table="conversations")}) x GROUP BY ALL),
s AS (SELECT low, word, la, lb, CAST(sum(least(a.k, b.k)) AS INTEGER) AS shared FROM a JOIN b ON a.c = b.c AND 2 * least(la, lb) >= 0.8 * (la + lb) - 1e-9 GROUP BY ALL)
SELECT low, word, shared, round(2 * shared / CAST(la + lb AS DOUBLE), 9) AS bound FROM s WHERE shared >= 0.4 * (la + lb) - 1e-9""")
def near_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the benchmark and of the conversations that share as many letters as a ratio of 0.8 needs."""
    words = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1))).alias("word")).distinct()
    asked, known = words("benchmark").where(F.length("word") >= 3).withColumnRenamed("word", "low"), words("conversations")
    left, right, sizes = similar.indexed(asked, known)
    return similar.candidate_pairs(left, right, sizes, lambda n: F.lit(0.8)).withColumn("bound", F.round("bound", 9))
