"""Further named queries: pages and their headers, selections, stations, joins of words, exports, what a run did."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin import engine
from ravelin.config import Settings
from ravelin.functions import lines, stations, texts, timecodes
from ravelin.operators import blocks as ops
from ravelin.operators import building, export, metrics
from ravelin.plans import fixtures
from ravelin.plans.registry import KEY, KINDS, REMARKS, V1, query
from ravelin.plans.transcripts import page_texts
from ravelin.sources import files


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(f"""SELECT document, count(*) FILTER (coalesce(t, '') <> '') AS n_timed, count(*) FILTER (coalesce(speaker, '') <> '') AS n_named, count(*) FILTER (type = 'comm' AND coalesce(t, '') <> '') AS n_timed_comm
FROM (SELECT *, CASE WHEN block_idx % 3 = 0 THEN '' ELSE timestamp_clean END AS t FROM ({V1}) v) x GROUP BY document""")
def block_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.blocks(spark, sf_dir).withColumn("t", F.when(F.col("block_idx") % 3 == 0, "").otherwise(F.col("timestamp_clean")))
    n = lambda df, name: df.groupBy("document").agg(F.count("*").alias(name))
    counted = n(ops.with_timestamp(rows, "t"), "n_timed").join(n(ops.with_speaker(rows), "n_named"), "document", "full").join(n(ops.timed_comm(rows, "t"), "n_timed_comm"), "document", "full")
    every = rows.select("document").distinct().join(counted, "document", "left")
    return every.select("document", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_timed", "n_named", "n_timed_comm")))


_SCRAP = "CASE (conv_id + turn) % 5 WHEN 0 THEN '..' WHEN 1 THEN '' WHEN 2 THEN 'a' WHEN 3 THEN ' -? ' ELSE coalesce(text, '') END"


@query(f"""SELECT conv_id, turn, said, role = 'user' AND length(trim(said)) < 3 AND NOT regexp_matches(trim(said), '[\\p{{L}}\\p{{Nd}}]') AS scrap FROM (SELECT *, {_SCRAP} AS said FROM conversations) c""")
def nameless_scraps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").withColumns({"said": F.expr(_SCRAP), "speaker": F.when(F.col("role") == "user", "SC").otherwise(F.upper("role"))})
    return rows.select("conv_id", "turn", "said", lines.is_scrap(F.col("speaker"), F.col("said")).alias("scrap"))


_EVENT = "CASE (conv_id + turn) % 5 WHEN 0 THEN coalesce(text, '') || ' -- Begin Lunar Rev 4' WHEN 1 THEN 'END LUNAR REV 12 ' || coalesce(text, '') WHEN 2 THEN coalesce(text, '') || ' - Rest Period - no communications. go' ELSE coalesce(text, '') END"
_EVENT_AT = "coalesce(nullif(instr(lower(said), 'begin lunar rev'), 0), nullif(instr(lower(said), 'end lunar rev'), 0), nullif(instr(lower(said), 'rest period - no communications'), 0))"


@query(f"""SELECT conv_id, turn, CASE WHEN p IS NULL THEN said ELSE regexp_replace(substr(said, 1, p - 1), '[ \\t-]+$', '') END AS before, trim(substr(said, p)) AS event,
  starts_with(upper(said), 'BEGIN LUNAR REV') OR starts_with(upper(said), 'END LUNAR REV') OR contains(upper(said), 'REST PERIOD - NO COMMUNICATIONS') AS is_event
FROM (SELECT *, {_EVENT_AT} AS p FROM (SELECT *, {_EVENT} AS said FROM conversations) a) b""")
def event_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.expr(_EVENT)
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", export.event_before(said).alias("before"), export.event_of(said).alias("event"), export.is_event(said).alias("is_event"))


_MARKED = "CASE WHEN document % 3 = 0 AND block_idx = 2 THEN 'meta' ELSE type END AS type, CASE WHEN document % 3 = 0 AND block_idx = 2 THEN '** end of tape **' WHEN page_num = 4 AND block_idx = 1 THEN 'Rest  period' ELSE text END AS text"


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.blocks(spark, sf_dir)
    ends = (F.col("document") % 3 == 0) & (F.col("block_idx") == 2)
    text = F.when(ends, "** end of tape **").when((F.col("page_num") == 4) & (F.col("block_idx") == 1), "Rest  period").otherwise(F.col("text"))
    return rows.withColumns({"type": F.when(ends, "meta").otherwise(F.col("type")), "text": text})


@query(f"""SELECT document, page_num, coalesce(bool_or(type = 'meta' AND contains(upper(text), 'END OF TAPE')), FALSE) AS end_of_tape, coalesce(bool_or(regexp_matches(upper(text), '\\bREST\\s+PERIOD\\b')), FALSE) AS rest_period,
  arg_max(type, block_idx) AS last_type FROM (SELECT document, page_num, block_idx, {_MARKED} FROM ({V1}) v) m GROUP BY document, page_num""")
def page_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.page_flags(_marked(spark, sf_dir))


@query(f"""SELECT document, page_num, lag(l) OVER (PARTITION BY document ORDER BY page_num) AS previous_type FROM (SELECT document, page_num, arg_max(type, block_idx) AS l FROM ({KINDS}) v GROUP BY ALL) x""")
def previous_block_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.type_before(fixtures.kinds(spark, sf_dir))


@query(f"""SELECT document, '{{' || string_agg('"' || CAST(page_num AS STRING) || '":[' || ts || ']', ',' ORDER BY page_num) || '}}' AS index FROM (
  SELECT document, page_num, coalesce(string_agg('"' || timestamp_clean || '"', ',' ORDER BY block_idx) FILTER (type = 'comm'), '') AS ts FROM ({V1}) v GROUP BY document, page_num) p GROUP BY document""")
def timestamp_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.index_of(ops.page_time_lists(fixtures.blocks(spark, sf_dir)))


@query(f"""WITH w AS (SELECT document, page_num, block_idx, timestamp_clean, CASE WHEN block_idx % 2 = 0 THEN ' cc ' ELSE '' END AS speaker, CASE WHEN block_idx % 3 = 0 THEN 'eagle' ELSE NULL END AS location FROM ({V1}) v)
SELECT w.document, w.page_num, w.block_idx, w.timestamp_clean, coalesce(max(v.block_idx) FILTER ((trim(w.speaker) = '' OR upper(trim(w.speaker)) = upper(v.speaker)) AND (w.location IS NULL OR upper(w.location) = upper(v.location))), min(v.block_idx)) AS found_idx
FROM w LEFT JOIN ({V1}) v ON v.type = 'comm' AND v.document = w.document AND v.page_num = w.page_num AND v.timestamp_clean = w.timestamp_clean GROUP BY ALL""")
def located_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last agreeing block by time, speaker and place, else the first by time."""
    rows = fixtures.blocks(spark, sf_dir)
    wanted = rows.select(*KEY, "timestamp_clean", F.when(F.col("block_idx") % 2 == 0, " cc ").otherwise("").alias("speaker"), F.when(F.col("block_idx") % 3 == 0, "eagle").alias("location"))
    return ops.relaxed_lookup(wanted, rows, located=True, last=True)


@query("""SELECT n_nationkey, list_aggregate(list_distinct([n_name, upper(r_name), 'HAWAII']), 'count') AS n, n_name || '|HAWAII' || CASE WHEN upper(r_name) IN (n_name, 'HAWAII') THEN '' ELSE '|' || upper(r_name) END AS members
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def keyword_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "nation").join(F.broadcast(_table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    union = texts.ordered_union(F.array("n_name", F.lit("HAWAII"), F.lit("")), F.array(F.upper("r_name"), "n_name"), F.lit(None).cast("array<string>"))
    return rows.select("n_nationkey", F.size(union).cast("bigint").alias("n"), F.array_join(union, "|").alias("members"))


@query(f"""SELECT document, page_num, CAST(page_num AS INTEGER) AS page, '1/' || CAST(page_num AS STRING) AS tape, FALSE AS is_apollo_title, CAST(NULL AS STRING) AS page_type, FALSE AS footer FROM ({V1}) v GROUP BY document, page_num""")
def page_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and tape label of the lines before the first time."""
    built = building.built_pages(page_texts(spark, sf_dir), building.Building())
    return built.select("document", "page_num", "header.*")


@query()
def build_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of three readings each, one cut and one with gaps, merged and put together."""
    whole = page_texts(spark, sf_dir)
    cut = whole.withColumns({"pass": F.lit("raw"), "text": F.regexp_replace("text", r"(?m)^(.{60}).*$", "$1")})
    gaps = whole.withColumns({"pass": F.lit("raw_fallback"), "text": F.regexp_replace("text", r"(?m)^\d.*7$\n?", "")})
    passes = cut.unionByName(gaps).unionByName(whole.withColumn("pass", F.lit("faint_fallback")))
    return engine.TranscriptEngine(spark).parse(passes)


@query()
def corrected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of pages through all corrections."""
    e = engine.TranscriptEngine(spark, Settings(mission_keywords=["HAWAII", "MADRID"]))
    return e.postprocess(e.parse(page_texts(spark, sf_dir)))


@query()
def exported_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of whole documents, with stations in their texts, made ready for export."""
    rows = fixtures.blocks(spark, sf_dir)
    text = F.when(F.col("block_idx") % 4 == 3, F.concat(F.lit("HAWAII (REV 4) "), F.col("text"))).otherwise(F.col("text"))
    blocks = rows.select(*KEY, "type", F.col("timestamp_clean").alias("timestamp"), "speaker", "location", text.alias("text"))
    return export.exported(blocks, {"the": "teh"}, ["CC", "CDR"], ["HAWAII"])


_SAID = "CASE WHEN turn % 3 = 0 THEN array_to_string(regexp_split_to_array(trim(text), '\\s+')[-5:], ' ') || ' ' || coalesce(ahead, '') WHEN turn % 3 = 1 THEN ahead ELSE substr(text, 3, 9) END"


@query(f"""WITH p AS (SELECT conv_id, turn, a, b, list_filter(regexp_split_to_array(a, '\\s+'), lambda w: w <> '') AS x, list_filter(regexp_split_to_array(b, '\\s+'), lambda w: w <> '') AS y FROM (
  SELECT conv_id, turn, coalesce(text, '') AS a, coalesce({_SAID}, '') AS b FROM (SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS ahead FROM conversations) l) m),
q AS (SELECT *, list_max(list_filter(range(1, 13), lambda k: k <= len(x) AND k <= len(y) AND x[len(x) - k + 1:] = y[1:k])) AS k FROM p)
SELECT conv_id, turn, CASE WHEN a = '' THEN b WHEN b = '' THEN a WHEN contains(a, b) THEN a WHEN contains(b, a) THEN b WHEN k IS NOT NULL THEN array_to_string(list_concat(x, y[k + 1:]), ' ') ELSE trim(a || ' ' || b) END AS stitched FROM q""")
def overlap_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    ahead = F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    w = F.split(F.trim("text"), r"\s+")
    tail = F.array_join(F.slice(w, F.greatest(F.size(w) - 4, F.lit(1)), 5), " ")
    said = F.when(F.col("turn") % 3 == 0, F.concat(tail, F.lit(" "), F.coalesce("ahead", F.lit("")))).when(F.col("turn") % 3 == 1, F.col("ahead")).otherwise(F.substring("text", 3, 9))
    rows = _table(spark, sf_dir, "conversations").withColumn("ahead", ahead).select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("a"), F.coalesce(said, F.lit("")).alias("b"))
    return rows.select("conv_id", "turn", texts.stitched(F.col("a"), F.col("b")).alias("stitched"))


_TWICE = "coalesce(text, '') || CASE WHEN turn % 3 = 0 THEN ' ' || array_to_string(regexp_split_to_array(trim(text), '\\s+')[-7:], ' ') WHEN turn % 3 = 1 THEN ' so ' || array_to_string(regexp_split_to_array(trim(text), '\\s+')[-14:], ' ') ELSE '' END"


@query(f"""WITH t AS (SELECT conv_id, turn, said, list_filter(regexp_split_to_array(said, '\\s+'), lambda w: w <> '') AS w FROM (SELECT conv_id, turn, coalesce({_TWICE}, '') AS said FROM conversations) a),
f AS (SELECT conv_id, turn, span, i, i + span + d AS j FROM t, (SELECT unnest(range(6, 13)) AS span) s, LATERAL (SELECT unnest(range(0, len(w) - 2 * span + 1)) AS i) x, (SELECT unnest(range(0, 20)) AS d) y
  WHERE i + 2 * span + d <= len(w) AND w[i + 1:i + span] = w[i + span + d + 1:i + 2 * span + d]),
g AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY span DESC, i, j) AS k FROM f)
SELECT t.conv_id, t.turn, CASE WHEN len(w) >= 12 AND g.j IS NOT NULL THEN array_to_string(list_concat(w[1:g.j], w[g.j + g.span + 1:]), ' ') ELSE said END AS said FROM t LEFT JOIN g ON g.conv_id = t.conv_id AND g.turn = t.turn AND k = 1""")
def repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.split(F.trim("text"), r"\s+")
    tail = lambda n: F.array_join(F.slice(w, F.greatest(F.size(w) - n + 1, F.lit(1)), n), " ")
    more = F.when(F.col("turn") % 3 == 0, F.concat(F.lit(" "), tail(7))).when(F.col("turn") % 3 == 1, F.concat(F.lit(" so "), tail(14))).otherwise("")
    said = F.coalesce(F.concat(F.coalesce("text", F.lit("")), more), F.lit(""))
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", said.alias("said")).withColumn("w", texts.words_of(F.col("said"))).select("conv_id", "turn", texts.without_repeats(F.col("said"), F.col("w")).alias("said"))


_RAW_TIME = "'(' || replace(timestamp_raw, ' ', CASE WHEN block_idx % 2 = 0 THEN ' :' ELSE '.' END) || CASE WHEN block_idx % 5 = 0 THEN 'S' ELSE ')' END"


@query(f"""SELECT document, page_num, block_idx, raw, CASE WHEN length(d) = 8 THEN substr(d, 1, 2) || ' ' || substr(d, 3, 2) || ' ' || substr(d, 5, 2) || ' ' || substr(d, 7, 2) END AS at FROM (
  SELECT *, translate(array_to_string(regexp_extract_all(raw, '[0-9OIilCSB]')[1:8], ''), 'OoCcIilSsBb', '00001115588') AS d FROM (SELECT *, {_RAW_TIME} AS raw FROM ({V1}) v) a) b""")
def embedded_timecode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.blocks(spark, sf_dir).withColumn("raw", F.expr(_RAW_TIME))
    return rows.select(*KEY, "raw", timecodes.embedded(F.col("raw")).alias("at"))


_STATION = "CASE conv_id % 4 WHEN 0 THEN 'and over ' || role WHEN 1 THEN 'THE ' || role || '!' WHEN 2 THEN 'go to the ' || role ELSE 'this is far off ' || role END"


@query(f"""SELECT conv_id, turn, CASE WHEN conv_id % 4 <> 3 AND role <> 'system' THEN upper(role) END AS station, {_STATION} AS said FROM conversations""")
def station_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.expr(_STATION)
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", stations.known_station(said, ["USER", "ASSISTANT", "HAWAII"]).alias("station"), said.alias("said"))


@query("""SELECT doc_id, replace(replace(t, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM (SELECT doc_id, replace(coalesce(text, ''), chr(10), CASE doc_id % 3 WHEN 0 THEN chr(13) || chr(10) WHEN 1 THEN chr(13) ELSE chr(10) END) AS t FROM documents) d""")
def newline_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = F.when(F.col("doc_id") % 3 == 0, "\r\n").when(F.col("doc_id") % 3 == 1, "\r").otherwise("\n")
    return _table(spark, sf_dir, "documents").select("doc_id", texts.with_line_feeds(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), to)).alias("text"))


_COLUMN = "CASE (conv_id + turn) % 6 WHEN 0 THEN 'CDR' WHEN 1 THEN ' (TRANQ) ' WHEN 2 THEN 'Page 12' WHEN 3 THEN 'LMP CC/CDR (EAGLE)' WHEN 4 THEN ' ' ELSE coalesce(text, '') END"


@query(f"""SELECT conv_id, turn, trim(x) <> '' AND NOT (regexp_matches(trim(x), '{lines.NAME_LINE}') OR regexp_matches(trim(x), '{lines.PLACE_LINE}') OR regexp_matches(trim(x), '{lines.HEADER_ONLY}')) AS said
FROM (SELECT conv_id, turn, {_COLUMN} AS x FROM conversations) c""")
def column_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", lines.is_column_text(F.expr(_COLUMN)).alias("said"))


_O5 = "CASE conv_id % 4 WHEN 0 THEN 'at O5 RFV 3 ' WHEN 1 THEN 'we twelve  done $5 ' WHEN 2 THEN 'R''id ' ELSE '' END || coalesce(text, '')"


@query(f"""SELECT conv_id, turn, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_O5}, '\\bRFV\\b', 'REV', 'g'), '\\bO([1-9])\\b', '0\\1', 'g'), '\\btwelve\\s+(been|had|done|come|got|seen)\\b', 'we''ve \\1', 'g'), '^[Rr]''?id\\b', 'I''d $\\\\', 'g') AS said FROM conversations""")
def pattern_replacements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables whose replacements hold groups, dollar signs and backslashes."""
    table = {r"\bRFV\b": "REV", r"\bO([1-9])\b": r"0\1", r"\btwelve\s+(been|had|done|come|got|seen)\b": r"we've \1", r"^[Rr]'?id\b": "I'd $\\"}
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", lines.replaced_by_patterns(F.expr(_O5), table).alias("said"))


@query("""SELECT conv_id, turn, 'C' || CAST(conv_id AS STRING) || '/pages/Page_' || CASE WHEN turn + 998 < 1000 THEN lpad(CAST(turn + 998 AS STRING), 3, '0') ELSE CAST(turn + 998 AS STRING) END AS page_dir, 'C' || CAST(conv_id AS STRING) || '_page_' || lpad(CAST(turn + 998 AS STRING), 4, '0') AS page_id FROM conversations""")
def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("document"), (F.col("turn") + 998).cast("bigint").alias("page_num"))
    return files.page_paths(pages).select("conv_id", "turn", "page_dir", "page_id")


_JSON_BLOCK = """'{"type":"' || type || '"' || CASE WHEN type = 'comm' THEN ',"timestamp":"' || timestamp_clean || '"' || CASE WHEN speaker IS NULL THEN '' ELSE ',"speaker":"' || speaker || '"' END || CASE WHEN location IS NULL THEN '' ELSE ',"location":"' || location || '"' END || ',"text":' || CAST(to_json(text) AS STRING)
  ELSE CASE WHEN type = 'meta' THEN ',"timestamp":"' || timestamp_clean || '","text":' || CAST(to_json(text) AS STRING) ELSE ',"text":' || CAST(to_json(text) AS STRING) || ',"timestamp":"' || timestamp_clean || '"' END || CASE WHEN speaker IS NULL THEN '' ELSE ',"speaker":"' || speaker || '"' END || CASE WHEN location IS NULL THEN '' ELSE ',"location":"' || location || '"' END END || '}'"""


@query(f"""WITH p AS (SELECT document, page_num, '{{"header":{{"page":' || CAST(page_num AS STRING) || '}},"blocks":[' || string_agg({_JSON_BLOCK}, ',' ORDER BY block_idx) || '],"source":"p' || CAST(page_num AS STRING) || '.json"}}' AS j FROM ({V1}) v GROUP BY document, page_num)
SELECT document, count(*) AS page_count, '{{"document":' || CAST(document AS STRING) || ',"page_count":' || CAST(count(*) AS STRING) || ',"pages":[' || string_agg(j, ',' ORDER BY page_num) || ']}}' AS merged FROM p GROUP BY document""")
def merged_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged JSON with members in the order of their kind, whole texts and sources."""
    rows = fixtures.blocks(spark, sf_dir)
    blocks = rows.select(*KEY, "type", F.col("timestamp_clean").alias("timestamp"), "speaker", "location", "text", F.lit("dropped").alias("timestamp_correction"))
    headers = rows.select("document", "page_num").distinct().select("document", "page_num", F.struct(F.col("page_num").cast("int").alias("page"), F.lit(None).cast("string").alias("tape")).alias("header"), F.concat(F.lit("p"), F.col("page_num").cast("string"), F.lit(".json")).alias("source"))
    return export.merged_json(blocks, headers)


@query("""SELECT l_suppkey AS document, count(*) AS total, count(*) FILTER (l_returnflag <> 'R') AS succeeded, count(*) FILTER (l_returnflag = 'R') AS failed FROM lineitem GROUP BY l_suppkey""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("document"), F.when(F.col("l_returnflag") == "R", "lost").alias("error"))
    return metrics.totals(rows)


@query("""SELECT l_suppkey AS document, l_linestatus AS stage, count(DISTINCT l_orderkey) AS pages, round(sum(CASE WHEN l_linenumber = 1 THEN 0 ELSE CAST(l_quantity AS DOUBLE) END), 4) AS seconds FROM lineitem GROUP BY ALL""")
def stage_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.when(F.col("l_linenumber") != 1, F.col("l_quantity").cast("double"))
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("document"), F.col("l_orderkey").alias("page_num"), F.col("l_linestatus").alias("stage"), seconds.alias("seconds"))
    return metrics.stage_seconds(rows).withColumn("seconds", F.round("seconds", 4))


@query("""SELECT c_custkey AS document, c_nationkey AS done, 30 AS total, CAST(c_nationkey * 2 AS DOUBLE) AS elapsed, CASE WHEN c_nationkey > 0 THEN CAST(0.5 AS DOUBLE) END AS rate, CASE WHEN c_nationkey > 0 THEN CAST((30 - c_nationkey) * 2 AS BIGINT) END AS seconds_left FROM customer""")
def page_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("document"), F.col("c_nationkey").alias("done"), F.lit(30).alias("total"), (F.col("c_nationkey") * F.lit(2.0)).alias("elapsed"))
    return metrics.progress(rows)


@query("""SELECT conv_id AS document, seen, message FROM (SELECT conv_id, turn AS seen, coalesce(text, '') AS message, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, coalesce(text, '') DESC) AS k FROM conversations) x WHERE k <= 3""")
def last_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("document"), F.col("turn").alias("seen"), F.coalesce("text", F.lit("")).alias("message"))
    return metrics.last_lines(rows, 3)


@query("""SELECT l_suppkey AS document, l_linenumber AS page_num, median(CAST(l_quantity AS DOUBLE) / 10 - 2) AS angle FROM lineitem GROUP BY ALL""")
def median_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.median_angle(_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("document"), F.col("l_linenumber").alias("page_num"), (F.col("l_quantity").cast("double") / 10 - 2).alias("angle")))


@query("""SELECT l_suppkey AS document, l_linenumber AS page_num, round(quantile_cont(CAST(l_quantity AS DOUBLE), 0.02), 6) AS black, round(quantile_cont(CAST(l_quantity AS DOUBLE), 0.98), 6) AS white FROM lineitem GROUP BY ALL""")
def stretch_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("document"), F.col("l_linenumber").alias("page_num"), F.col("l_quantity").cast("double").alias("value"))
    return metrics.stretch_points(rows).withColumns({"black": F.round("black", 6), "white": F.round("white", 6)})


@query("""SELECT p_partkey, CAST(trunc((p_size * 12.25) * 300 / 72) AS INTEGER) AS width_px, CAST(trunc((p_size + 0.5) * 300 / 72) AS INTEGER) AS height_px FROM part""")
def page_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * F.lit(12.25)).alias("width_pts"), (F.col("p_size") + F.lit(0.5)).alias("height_pts"))
    return metrics.page_pixels(rows).select("p_partkey", "width_px", "height_px")


@query(f"SELECT document, page_num, count(*) AS n_remarks FROM ({REMARKS}) r WHERE type = 'annotation' GROUP BY ALL")
def remark_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.of_type(fixtures.remarks(spark, sf_dir), "annotation").groupBy("document", "page_num").agg(F.count("*").alias("n_remarks"))


_WORDS = "SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents"


@query(f"""SELECT word, max(n) AS n FROM (SELECT word, count(*) AS n FROM ({_WORDS}) w GROUP BY word UNION ALL SELECT unnest(['hawaii', 'merritt', 'island', 'the']), 100) x GROUP BY word""")
def keyword_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ravelin.operators import spelling

    counts = spelling.word_counts(_table(spark, sf_dir, "documents"))
    return spelling.with_keywords(counts, ["HAWAII", "Merritt Island", "THE"])
