"""Named queries over the driver's tables and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ravelin.functions import speakers, texts, timecodes
from ravelin.operators import blocks as ops
from ravelin.operators import folds, spelling
from ravelin.plans import fixtures
from ravelin.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

V1 = fixtures.BLOCKS.format(conversations="conversations")
V2 = fixtures.PAGES.format(conversations="conversations")
REMARKS = fixtures.REMARKS.format(conversations="conversations")
KINDS = fixtures.KINDS.format(conversations="conversations")
V3 = fixtures.STATIONS.format(nation="nation")
KEY = ["document", "page_num", "block_idx"]
DOC_LINES = "SELECT doc_id, line_no, line FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no FROM documents) x"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("at", "line")).select("doc_id", (F.col("at") + 1).cast("bigint").alias("line_no"), "line")


_SPEC = "CASE document % 4 WHEN 0 THEN '1-3,5' WHEN 1 THEN '4-20' WHEN 2 THEN '' ELSE CAST(document % 7 + 1 AS STRING) || ', 2-3,2' END"


@query(f"""WITH d AS (SELECT document, {_SPEC} AS spec, max(page_num) AS last FROM ({V1}) v GROUP BY document),
p AS (SELECT document, spec, last, unnest(string_split(CASE spec WHEN '' THEN '1-' || CAST(last AS STRING) ELSE replace(spec, ' ', '') END, ',')) AS part FROM d),
r AS (SELECT document, spec, unnest(range(CAST(string_split(part, '-')[1] AS BIGINT), least(CAST(string_split(part, '-')[-1] AS BIGINT), last) + 1)) AS page_num FROM p)
SELECT DISTINCT document, spec, page_num - 1 AS page FROM r""")
def page_range_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages that each document's own range has."""
    specs = fixtures.blocks(spark, sf_dir).groupBy("document").agg(F.max("page_num").alias("max_pages")).withColumn("spec", F.expr(_SPEC))
    return ops.page_ranges(specs).select("document", "spec", "page")


@query(f"""SELECT document, count(*) FILTER (type = 'comm') AS n_comm, count(*) FILTER (type = 'meta') AS n_meta,
  count(*) FILTER (type = 'annotation') AS n_annotation, bool_or(type = 'meta') AS has_meta FROM ({V1}) v GROUP BY document""")
def block_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.type_counts(fixtures.blocks(spark, sf_dir))


@query(f"""SELECT document, type, arg_min(text, page_num * 1000 + block_idx) AS first_text, arg_max(text, page_num * 1000 + block_idx) AS last_text,
  count(*) AS n FROM ({V1}) v GROUP BY ALL""")
def first_last_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.ends_of_type(fixtures.blocks(spark, sf_dir))


_CLEAN = """replace(replace(translate(upper(timestamp_raw), 'OQIL][SB)(°'':?./', '00111158000'), '--', '00'), '-', '0')"""
_PARSED = f"""
SELECT document, page_num, block_idx, timestamp_raw,
  CASE WHEN h <= 23 AND m <= 59 AND sec <= 59 THEN
    CAST((CASE WHEN d = 94 THEN 4 WHEN d = 55 THEN 5 WHEN d > 10 THEN d % 10 ELSE d END) * 86400 + h * 3600 + m * 60 + sec AS BIGINT) END AS seconds
FROM (SELECT *, TRY_CAST(g[1] AS BIGINT) AS d, TRY_CAST(g[2] AS BIGINT) AS h, TRY_CAST(g[3] AS BIGINT) AS m, TRY_CAST(g[4] AS BIGINT) AS sec FROM (
  SELECT *, CASE WHEN regexp_matches(clean, '(\\d{{1,2}})[\\s:]+(\\d{{1,2}})[\\s:]+(\\d{{1,2}})[\\s:]+(\\d{{1,2}})') THEN
      regexp_extract_all(regexp_extract(clean, '(\\d{{1,2}})[\\s:]+(\\d{{1,2}})[\\s:]+(\\d{{1,2}})[\\s:]+(\\d{{1,2}})'), '\\d+')
    WHEN len(regexp_extract_all(clean, '\\d+')) = 3 THEN list_append(regexp_extract_all(clean, '\\d+'), '00')
    WHEN len(regexp_extract_all(clean, '\\d+')) = 4 THEN regexp_extract_all(clean, '\\d+') END AS g
  FROM (SELECT *, {_CLEAN} AS clean FROM ({V1}) v) a) b) c"""


@query(_PARSED)
def timecode_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.blocks(spark, sf_dir).select(*KEY, "timestamp_raw", timecodes.parsed_seconds(F.col("timestamp_raw")).alias("seconds"))


@query(f"""SELECT document, page_num, block_idx, noisy, {fixtures.timecode_sql("(s - s % 60 + 60 + 3600 * (block_idx % 3))")} AS carried
  FROM (SELECT *, substr(timestamp_clean, 1, 3) || lpad(CAST(CAST(substr(timestamp_clean, 4, 2) AS BIGINT) + block_idx % 3 AS STRING), 2, '0') || substr(timestamp_clean, 6, 4) || '60' AS noisy FROM ({V1}) v) a""")
def timecode_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("timestamp_clean")
    hour = F.lpad((F.substring(c, 4, 2).cast("bigint") + F.col("block_idx") % 3).cast("string"), 2, "0")
    noisy = F.concat(F.substring(c, 1, 3), hour, F.substring(c, 6, 4), F.lit("60"))
    return fixtures.blocks(spark, sf_dir).select(*KEY, noisy.alias("noisy"), timecodes.carried(noisy).alias("carried"))


@query(f"SELECT document, page_num, block_idx, s AS seconds, timestamp_clean AS back, {fixtures.timecode_sql('(s + 1)')} AS bumped FROM ({V1}) v")
def timecode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = timecodes.canonical_seconds(F.col("timestamp_clean"))
    return fixtures.blocks(spark, sf_dir).select(*KEY, at.alias("seconds"), timecodes.formatted(at).alias("back"), timecodes.formatted(at + 1).alias("bumped"))


@query(f"""SELECT document, page_num, block_idx, s, last_s, (SELECT min(x) FROM (VALUES
    (CAST(s - s % 86400 + s % 3600 + (last_s % 86400 - last_s % 3600) AS BIGINT)), (CAST(s - s % 86400 + s % 3600 + (last_s % 86400 - last_s % 3600) - 3600 AS BIGINT)),
    (CAST(s - s % 86400 + s % 3600 + (last_s % 86400 - last_s % 3600) + 3600 AS BIGINT))) t(x)
    WHERE x > last_s AND x - last_s <= 600 AND s - s % 86400 = last_s - last_s % 86400 AND x - x % 86400 = s - s % 86400) AS snapped
  FROM (SELECT *, lag(s) OVER (PARTITION BY document ORDER BY page_num, block_idx) AS last_s FROM ({V1}) v) a""")
def hour_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.blocks(spark, sf_dir).withColumn("last_s", F.lag("s").over(ops.by_document()))
    return rows.select(*KEY, "s", "last_s", timecodes.hour_snapped(F.col("s"), F.col("last_s")).cast("bigint").alias("snapped"))


@query(f"""WITH v AS ({V1}), p AS (SELECT DISTINCT document, page_num FROM v),
  t AS (SELECT document, page_num, arg_max(timestamp_clean, block_idx) AS l FROM v WHERE type = 'comm' GROUP BY ALL)
SELECT p.document, p.page_num, last_value(l IGNORE NULLS) OVER (PARTITION BY p.document ORDER BY p.page_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_before
FROM p LEFT JOIN t ON p.document = t.document AND p.page_num = t.page_num""")
def asof_last_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.blocks(spark, sf_dir)
    return ops.last_before(rows, ops.page_times(rows))


@query(f"""WITH c AS (SELECT *, list_filter(list(CASE WHEN type = 'comm' THEN s END) OVER (PARTITION BY document, page_num ORDER BY block_idx ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING), lambda t: t IS NOT NULL) AS r FROM ({KINDS}) v)
SELECT document, page_num, block_idx, len(r) >= 3 AND r[2] > r[1] AND r[3] > r[2] AND r[2] - r[1] <= 600 AND r[3] - r[2] <= 600 AS stable FROM c WHERE type = 'comm'""")
def stable_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With annotations between comm blocks, which count as rows of the window."""
    return ops.stable_run(fixtures.kinds(spark, sf_dir)).select(*KEY, "stable")


@query(f"""WITH RECURSIVE p AS (SELECT *, row_number() OVER (PARTITION BY document ORDER BY page_num) AS rn,
    TRY_CAST(regexp_extract(ocr_tape, '^(\\d+)/(\\d+)$', 1) AS INTEGER) AS ox, TRY_CAST(regexp_extract(ocr_tape, '^(\\d+)/(\\d+)$', 2) AS INTEGER) AS oy FROM ({V2}) v),
f AS (
  SELECT document, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS page_num, CAST(NULL AS STRING) AS ocr_tape, 1 AS x, 1 AS y, FALSE AS ended, FALSE AS corrected FROM (SELECT DISTINCT document FROM p)
  UNION ALL
  SELECT document, rn, page_num, ocr_tape, CASE WHEN trusted THEN ox ELSE ex END, CASE WHEN trusted THEN oy ELSE ey END, end_of_tape, ocr_tape IS NOT NULL AND NOT trusted FROM (
    SELECT *, coalesce((ox = ex AND oy = ey) OR (ended AND oy = 1 AND abs(ox - ex) <= 1) OR (NOT ended AND oy = ey AND abs(ox - ex) <= 1) OR (NOT ended AND oy = 1 AND ey = 1 AND ox - ex = 2 AND NOT contains(CAST(ex AS STRING), CAST(ox AS STRING)) AND ox // 10 <> ex // 10), FALSE) AS trusted FROM (
      SELECT p.*, f.ended, CASE WHEN f.ended THEN f.x + 1 ELSE f.x END AS ex, CASE WHEN f.ended THEN 1 ELSE f.y + 1 END AS ey
      FROM f JOIN p ON p.document = f.document AND p.rn = f.rn + 1) a) b)
SELECT document, page_num, ocr_tape, CAST(x AS STRING) || '/' || CAST(y AS STRING) AS tape, corrected FROM f WHERE rn > 0""")
def tape_dead_reckoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.tapes(fixtures.pages(spark, sf_dir))


@query(f"""WITH RECURSIVE c AS (SELECT document, page_num, block_idx, s, row_number() OVER (PARTITION BY document ORDER BY page_num, block_idx) AS rn FROM ({V1}) v WHERE type = 'comm'),
f AS (
  SELECT document, page_num, block_idx, rn, s, s AS fixed FROM c WHERE rn = 1
  UNION ALL
  SELECT document, page_num, block_idx, rn, s, CASE WHEN s > l THEN s WHEN tried <= l THEN l + 1 ELSE tried END FROM (
    SELECT *, CAST(d * 86400 + hh * 3600 + (CASE WHEN d = l // 86400 AND hh = l % 86400 // 3600 THEN greatest(s % 3600 // 60, l % 3600 // 60) ELSE s % 3600 // 60 END) * 60 + s % 60 AS BIGINT) AS tried FROM (
      SELECT *, CASE WHEN d = l // 86400 THEN greatest(s % 86400 // 3600, l % 86400 // 3600) ELSE s % 86400 // 3600 END AS hh FROM (
        SELECT c.*, f.fixed AS l, greatest(c.s // 86400, f.fixed // 86400) AS d FROM f JOIN c ON c.document = f.document AND c.rn = f.rn + 1) x) y) z)
SELECT document, page_num, block_idx, {fixtures.timecode_sql("s")} AS timestamp, {fixtures.timecode_sql("fixed")} AS fixed, s <> fixed AS corrected FROM f""")
def monotonic_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.monotonic(fixtures.blocks(spark, sf_dir))


_FIX = "CASE speaker WHEN 'C' THEN 'CC' WHEN 'CDF' THEN 'CDR' ELSE coalesce(speaker, '') END"


@query(f"SELECT document, page_num, block_idx, speaker, {_FIX} AS corrected FROM ({V1}) v")
def speaker_fix_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.blocks(spark, sf_dir).select(*KEY, "speaker", speakers.corrected_speaker(F.col("speaker")).alias("corrected"))


_NOISY_SPEAKER = "CASE block_idx % 6 WHEN 0 THEN speaker WHEN 1 THEN speaker || ' ' || speaker WHEN 2 THEN '12' WHEN 3 THEN speaker || '!' WHEN 4 THEN 'TLI' ELSE '(TR) (TR)' END"


@query(f"""SELECT document, page_num, block_idx, noisy, CASE WHEN noisy IS NULL THEN TRUE ELSE block_idx % 6 <> 0 END AS garbage FROM (SELECT *, {_NOISY_SPEAKER} AS noisy FROM ({V1}) v) a""")
def garbage_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.blocks(spark, sf_dir).withColumn("noisy", F.expr(_NOISY_SPEAKER))
    return rows.select(*KEY, "noisy", speakers.is_garbage_speaker(F.col("noisy"), keywords=["TLI", "DSKY"]).alias("garbage"))


@query(f"""WITH v AS ({V1}), m AS (SELECT document, timestamp_clean, min('PAO') AS manual FROM v WHERE type = 'meta' GROUP BY ALL)
SELECT v.document, page_num, block_idx, coalesce(manual, speaker) AS speaker FROM v LEFT JOIN m ON m.document = v.document AND m.timestamp_clean = v.timestamp_clean""")
def manual_speaker_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.blocks(spark, sf_dir)
    manual = rows.where("type = 'meta'").groupBy("document", "timestamp_clean").agg(F.lit("PAO").alias("manual"))
    return rows.join(manual, ["document", "timestamp_clean"], "left").select(*KEY, F.coalesce("manual", "speaker").alias("speaker"))


@query(f"SELECT document, page_num, block_idx, location, CASE WHEN location IN ('EAGLE', 'TRANQ') THEN location ELSE '' END AS corrected FROM ({V1}) v")
def location_exact_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.blocks(spark, sf_dir).select(*KEY, "location", speakers.exact_location(F.col("location")).alias("corrected"))


@query(f"""WITH a AS (SELECT *, CASE WHEN type = 'annotation' AND text <> '' THEN trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9 ]+', ' ', 'g'), '\\s+', ' ', 'g')) END AS n FROM ({REMARKS}) v),
b AS (SELECT *, lag(n) OVER (PARTITION BY document, page_num ORDER BY block_idx) AS p FROM a)
SELECT document, page_num, block_idx, type FROM b WHERE n IS NULL OR p IS NULL OR n <> p""")
def adjacent_annotation_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole normalised texts are compared; every third block's text is said again as a remark behind it, with other marks. Pages
    begin and end with one remark, which stays on both sides of a page's end, and two blank ones."""
    return ops.without_repeated_annotations(fixtures.remarks(spark, sf_dir), texts.comparable(F.col("text"))).select(*KEY, "type")


_PAIRED = fixtures.timecode_sql("(86400 + page_num * 600 + (block_idx - block_idx % 3) * 37)")


@query(f"""WITH a AS (SELECT document, page_num, block_idx, type, text, coalesce(speaker, 'CC') AS speaker, {_PAIRED} AS ts FROM ({V1}) v),
b AS (SELECT *, CASE WHEN type = 'comm' AND lag(type) OVER w = 'comm' AND lag(ts) OVER w = ts AND lag(speaker) OVER w = speaker THEN 0 ELSE 1 END AS n FROM a WINDOW w AS (PARTITION BY document, page_num ORDER BY block_idx)),
c AS (SELECT *, sum(n) OVER (PARTITION BY document, page_num ORDER BY block_idx) AS i FROM b)
SELECT document, page_num, min(block_idx) AS block_idx, arg_min(type, block_idx) AS type, arg_min(ts, block_idx) AS ts, arg_min(speaker, block_idx) AS speaker, count(*) AS n_merged,
  coalesce(string_agg(trim(text), ' ' ORDER BY block_idx) FILTER (trim(text) <> ''), '') AS text FROM c GROUP BY document, page_num, i""")
def same_ts_speaker_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.blocks(spark, sf_dir).withColumns({"ts": F.expr(_PAIRED), "speaker": F.coalesce("speaker", F.lit("CC"))})
    return ops.merged_runs(rows, "ts")


@query(
    """SELECT doc_id, round(CASE WHEN n > 0 THEN (n - length(regexp_replace(text, '\\p{L}', '', 'g'))) / CAST(n AS DOUBLE) + len(regexp_extract_all(text, '[A-Za-z]{2,}')) / 8.0
  - least(0.5, length(regexp_replace(text, '[\\p{L}\\p{Nd}\\s.,;:''"\\-()/?!]', '', 'g')) / CAST(n AS DOUBLE)) ELSE 0.0 END, 6) AS quality
FROM (SELECT *, length(text) AS n FROM documents) d"""
)
def text_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", F.round(texts.quality(F.col("text")), 6).alias("quality"))


_NEXT = "SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS ahead FROM conversations"


def _with_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_turn = Window.partitionBy("conv_id").orderBy("turn")
    return _table(spark, sf_dir, "conversations").withColumn("ahead", F.lead("text").over(by_turn)).where("ahead is not null")


@query(f"""WITH p AS (SELECT *, list_distinct(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '')) AS a,
  list_distinct(list_filter(regexp_split_to_array(lower(ahead), '\\s+'), lambda w: w <> '')) AS b FROM ({_NEXT}) x WHERE ahead IS NOT NULL)
SELECT conv_id, turn, CASE WHEN least(len(a), len(b)) > 0 THEN round(len(list_intersect(a, b)) / CAST(least(len(a), len(b)) AS DOUBLE), 6) END AS overlap FROM p""")
def word_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_next(spark, sf_dir).select("conv_id", "turn", F.round(texts.overlap(F.col("text"), F.col("ahead")), 6).alias("overlap"))


@query(f"""WITH p AS (SELECT *, list_distinct(regexp_extract_all(lower(text), '[a-z]+')) AS a, list_distinct(regexp_extract_all(lower(ahead), '[a-z]+')) AS b FROM ({_NEXT}) x WHERE ahead IS NOT NULL)
SELECT conv_id, turn, round(len(list_intersect(a, b)) / CAST(greatest(1, len(list_distinct(list_concat(a, b)))) AS DOUBLE), 6) AS jaccard FROM p""")
def word_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_next(spark, sf_dir).select("conv_id", "turn", F.round(texts.jaccard(F.col("text"), F.col("ahead")), 6).alias("jaccard"))


@query(f"""SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, len(regexp_extract_all(line, '[A-Za-z]{{2,}}')) >= 3 AND length(trim(line)) >= 20 AS substantive FROM ({DOC_LINES}) l""")
def substantive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("doc_id", "line_no", texts.is_substantive(F.col("line")).alias("substantive"))


@query(f"""SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, length(t) < 2 OR regexp_full_match(t, '[?!.*-]+') OR regexp_full_match(t, '\\d{{1,2}}') OR regexp_full_match(t, '\\d[.-]') AS noise
FROM (SELECT *, trim(line) AS t FROM ({DOC_LINES}) l) x""")
def noise_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("doc_id", "line_no", texts.is_noise(F.col("line")).alias("noise"))


_FOOTED = "trim(coalesce(text, '')) || CASE conv_id % 4 WHEN 0 THEN '. Tape 12/3 Page 45' WHEN 1 THEN ' Page 45 TAPE 1/2' WHEN 2 THEN '  PAGO 7 ' ELSE ' go' END"


@query(f"""SELECT conv_id, turn, trim(regexp_replace(regexp_replace(regexp_replace({_FOOTED}, '{texts.FOOTERS[0]}', ''), '{texts.FOOTERS[1]}', ''), '{texts.FOOTERS[2]}', '')) AS stripped FROM conversations""")
def footer_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", texts.without_footer(F.expr(_FOOTED)).alias("stripped"))


_MISREAD = "CASE conv_id % 5 WHEN 0 THEN '0MNI ' WHEN 1 THEN 'PYR0 0ver ' WHEN 2 THEN 'five-boy PFESS ' WHEN 3 THEN 'Pass  light ' ELSE 'Unindentifiable ' END || coalesce(text, '')"


@query(
    """SELECT conv_id, turn, CASE conv_id % 5 WHEN 0 THEN 'OMNI ' WHEN 1 THEN 'PYRO Over ' WHEN 2 THEN 'five-by PRESS ' WHEN 3 THEN 'PRESS light ' ELSE 'Unidentifiable ' END || coalesce(text, '') AS repaired FROM conversations"""
)
def generic_ocr_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", texts.repaired(F.expr(_MISREAD)).alias("repaired"))


@query(f"SELECT n_nationkey, 'NATION ' || CAST(n_nationkey AS STRING) || '|' || CAST(n_nationkey AS STRING) AS variants FROM ({V3}) v")
def station_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.stations(spark, sf_dir).select("n_nationkey", F.array_join(texts.station_variants(F.col("station")), "|").alias("variants"))


_WORDS = "SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents"


@query(f"SELECT word, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM ({_WORDS}) w GROUP BY word")
def word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.word_counts(_table(spark, sf_dir, "documents"))


@query(
    """SELECT a || ' ' || b AS bigram, count(*) AS n FROM (SELECT unnest(w[1:len(w) - 1]) AS a, unnest(w[2:len(w)]) AS b FROM (
  SELECT regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents) x WHERE len(w) > 1) y GROUP BY ALL"""
)
def bigram_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.bigram_counts(_table(spark, sf_dir, "documents"))


_WANTED = "CASE WHEN block_idx % 2 = 0 THEN 'NOBODY' WHEN block_idx % 3 = 0 THEN '' ELSE speaker END"


@query(f"""WITH v AS ({V1}), w AS (SELECT document, page_num, block_idx, timestamp_clean, {_WANTED} AS speaker FROM v)
SELECT w.document, w.page_num, w.block_idx, w.timestamp_clean, coalesce(min(v.block_idx) FILTER (w.speaker IS NULL OR w.speaker = '' OR upper(v.speaker) = upper(w.speaker)), min(v.block_idx)) AS found_idx
FROM w LEFT JOIN v ON v.type = 'comm' AND v.document = w.document AND v.page_num = w.page_num AND v.timestamp_clean = w.timestamp_clean GROUP BY ALL""")
def pass_lookup_relaxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.blocks(spark, sf_dir)
    return ops.relaxed_lookup(rows.select(*KEY, "timestamp_clean", F.expr(_WANTED).alias("speaker")), rows)


@query(f"""WITH g AS (SELECT *, CASE WHEN (page_num + block_idx) % 3 = 0 THEN NULL ELSE timestamp_clean END AS t FROM ({V1}) v)
SELECT document, page_num, block_idx, last_value(t IGNORE NULLS) OVER (PARTITION BY document, page_num ORDER BY block_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before,
  first_value(t IGNORE NULLS) OVER (PARTITION BY document, page_num ORDER BY block_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM g""")
def ts_fill_forward_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.when((F.col("page_num") + F.col("block_idx")) % 3 != 0, F.col("timestamp_clean"))
    ahead, back = ops.by_page().rowsBetween(0, Window.unboundedFollowing), ops.by_page().rowsBetween(Window.unboundedPreceding, 0)
    return fixtures.blocks(spark, sf_dir).withColumn("t", t).select(*KEY, F.last("t", ignorenulls=True).over(back).alias("before"), F.first("t", ignorenulls=True).over(ahead).alias("after"))


@query(f"""WITH e AS (SELECT *, row_number() OVER (PARTITION BY document, page_num ORDER BY block_idx) AS k FROM ({V1}) v WHERE type = 'comm' AND block_idx % 2 = 0),
f AS (SELECT *, row_number() OVER (PARTITION BY document, page_num ORDER BY block_idx) AS k FROM ({V1}) v WHERE type = 'comm' AND block_idx % 2 = 1)
SELECT e.document, e.page_num, e.block_idx, f.text AS filled FROM e JOIN f ON e.document = f.document AND e.page_num = f.page_num AND e.k = f.k""")
def column_fill_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    comm = fixtures.blocks(spark, sf_dir).where("type = 'comm'")
    empty, lines = (comm.where(F.col("block_idx") % 2 == i) for i in (0, 1))
    return ops.column_fill(empty, lines, "block_idx")


@query(f"""WITH b AS (SELECT document, page_num, block_idx, CASE WHEN type = 'comm' THEN rtrim(rpad(timestamp_clean, 11, ' ') || '  ' || rpad(coalesce(speaker, ''), 5, ' ') || '  ' || CASE WHEN coalesce(location, '') = '' THEN '' ELSE '(' || location || ') ' END || trim(text)) ELSE trim(text) END AS line FROM ({V1}) v),
p AS (SELECT document, page_num, '==== PAGE ' || CAST(page_num AS STRING) || ' ====' || chr(10) || string_agg(line, chr(10) ORDER BY block_idx) AS body FROM b GROUP BY document, page_num)
SELECT document, count(*) AS page_count, string_agg(body, chr(10) || chr(10) ORDER BY page_num) AS rendered FROM p GROUP BY document""")
def render_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.rendered_text(fixtures.blocks(spark, sf_dir), "timestamp_clean")


@query(f"""WITH p AS (SELECT document, page_num, '{{"header":{{"page":' || CAST(page_num AS STRING) || '}},"blocks":[' || string_agg('{{"type":"' || type || '","timestamp":"' || timestamp_clean || '"' ||
    CASE WHEN speaker IS NULL THEN '' ELSE ',"speaker":"' || speaker || '"' END || '}}', ',' ORDER BY block_idx) || ']}}' AS j FROM ({V1}) v GROUP BY document, page_num)
SELECT document, count(*) AS page_count, '{{"document":' || CAST(document AS STRING) || ',"page_count":' || CAST(count(*) AS STRING) || ',"pages":[' || string_agg(j, ',' ORDER BY page_num) || ']}}' AS merged FROM p GROUP BY document""")
def merged_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = F.struct("block_idx", F.struct("type", F.col("timestamp_clean").alias("timestamp"), "speaker").alias("b"))
    blocks = F.transform(F.sort_array(F.collect_list(block)), lambda x: x["b"])
    pages = fixtures.blocks(spark, sf_dir).groupBy("document", "page_num").agg(F.struct(F.first("page_num").alias("page")).alias("header"), blocks.alias("blocks"))
    return files.merged_documents(pages)


_RADIO = "CASE conv_id % 3 WHEN 0 THEN '(over) ' WHEN 1 THEN '(Roger.) ' ELSE '' END || coalesce(text, '')"


@query("SELECT conv_id, turn, CASE conv_id % 3 WHEN 0 THEN 'OVER ' WHEN 1 THEN 'ROGER. ' ELSE '' END || coalesce(text, '') AS called FROM conversations")
def radio_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", texts.radio_called(F.expr(_RADIO)).alias("called"))


_KINDLY = """CASE block_idx % 8 WHEN 0 THEN ' -- Begin Lunar Rev 4 ' || coalesce(text, '') WHEN 1 THEN 'BEGIN LUNAR REV 4 ' || coalesce(text, '') WHEN 2 THEN '(Unidentifiable) ' || coalesce(text, '')
  WHEN 3 THEN coalesce(text, '') || ' (unidentifiable)' WHEN 4 THEN '(go) UNINDENTIFIABLE' WHEN 5 THEN '-- (unidentifiable)' ELSE text END"""


@query(f"""SELECT document, page_num, block_idx, CASE WHEN rev THEN 'meta' WHEN unknown THEN 'annotation' ELSE type END AS type,
  CASE WHEN rev OR unknown THEN NULL WHEN type = 'comm' AND coalesce(speaker, '') = '' THEN 'SC' ELSE speaker END AS speaker, CASE WHEN NOT rev AND NOT unknown THEN location END AS location
FROM (SELECT *, coalesce(type = 'comm' AND starts_with(said, '--') AND contains(upper(said), 'LUNAR REV'), FALSE) AS rev,
  coalesce(type = 'comm' AND starts_with(said, '(') AND (contains(upper(said), 'UNIDENTIFIABLE') OR contains(upper(said), 'UNINDENTIFIABLE')), FALSE) AS unknown
  FROM (SELECT *, ltrim({_KINDLY}) AS said FROM ({V1}) v) a) b""")
def reclassified_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that tell a revolution with and without dashes in front, and unidentifiable ones with and without a bracket."""
    return ops.reclassified(fixtures.blocks(spark, sf_dir).withColumn("text", F.expr(_KINDLY))).select(*KEY, "type", "speaker", "location")


_VOICE = "CASE WHEN block_idx % 3 = 0 THEN 'CC' WHEN coalesce(speaker, '') = '' THEN 'SC' ELSE speaker END"
_UTTERED = "CASE (document + page_num + block_idx) % 5 WHEN 0 THEN '12' WHEN 1 THEN lower(text) WHEN 2 THEN rtrim(text, '.?! ') WHEN 3 THEN 'GOSS NET 1' ELSE text END"


@query(rf"""WITH v AS (SELECT document, page_num, block_idx, type, {_VOICE} AS speaker, {_UTTERED} AS text, CASE WHEN block_idx % 4 = 0 THEN 'k' || CAST(block_idx AS STRING) END AS tc FROM ({V1}) x),
q AS (SELECT * FROM v WHERE NOT (regexp_full_match(text, '(?i)\(?\s*GOSS\s+NET\s+1\s*\)?') OR (type = 'comm' AND (length(trim(text)) < 2 OR regexp_full_match(trim(text), '[?!.*-]+|\d{{1,2}}|\d[.-]'))))),
l AS (SELECT *, CASE WHEN type = 'comm' AND lag(type) OVER w = 'comm' AND lag(speaker) OVER w = speaker AND (regexp_matches(text, '^(\p{{Ll}}|\.\.\.|[,;.)])') OR regexp_matches(rtrim(lag(text) OVER w), '[^.?!]$')) THEN 0 ELSE 1 END AS n
  FROM q WINDOW w AS (PARTITION BY document, page_num ORDER BY block_idx)),
i AS (SELECT *, sum(n) OVER (PARTITION BY document, page_num ORDER BY block_idx) AS island FROM l)
SELECT document, page_num, min(block_idx) AS block_idx, arg_min(type, block_idx) AS type, arg_min(speaker, block_idx) AS speaker, arg_min(tc, block_idx) FILTER (tc IS NOT NULL) AS timestamp_correction,
  CASE WHEN count(*) > 1 THEN trim(string_agg(rtrim(text), ' ' ORDER BY block_idx)) ELSE min(text) END AS text FROM i GROUP BY document, page_num, island""")
def one_voice_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without noise, neighbours of one speaker joined, as the engine ends its corrections."""
    rows = fixtures.blocks(spark, sf_dir).select(*KEY, "type", F.expr(_VOICE).alias("speaker"), F.expr(_UTTERED.replace("rtrim(text, '.?! ')", "rtrim('.?! ', text)")).alias("text"), F.expr("CASE WHEN block_idx % 4 = 0 THEN 'k' || CAST(block_idx AS STRING) END").alias("timestamp_correction"), F.lit(None).cast("boolean").alias("continuation_from_prev"))
    return ops.one_voice(ops.quiet(rows)).drop("continuation_from_prev")
