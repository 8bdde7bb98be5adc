"""Selections, lookups, windows and renderings over exploded blocks (document, page_num, block_idx, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ravelin.functions import lines, texts
from ravelin.functions.timecodes import canonical_seconds, is_blank

ORDER = ["page_num", "block_idx"]


def by_document() -> WindowSpec:
    return Window.partitionBy("document").orderBy(*ORDER)


def by_page() -> WindowSpec:
    return Window.partitionBy("document", "page_num").orderBy("block_idx")


def of_type(blocks: DataFrame, kind: str) -> DataFrame:
    return blocks.where(F.col("type") == kind)


def timed_comm(blocks: DataFrame, timestamp: str = "timestamp_clean") -> DataFrame:
    return of_type(blocks, "comm").where(~is_blank(F.col(timestamp)))


def page_ranges(specs: DataFrame) -> DataFrame:
    """(spec, page): zero-based distinct pages of ``1-50,60`` within ``max_pages``; a blank spec has all.

    Further columns of ``specs`` stay with them. An error on what is no number and on pages below 1; pages beyond the last are left out.
    """
    bare = F.regexp_replace("spec", " ", "")
    asked = specs.withColumn("part", F.explode(F.filter(F.split(bare, ","), lambda p: p != "")))
    bounds = F.split("part", "-", 2)
    number = lambda c: F.when(c.rlike(r"^\d+$"), c.cast("bigint")).otherwise(F.raise_error(F.concat(F.lit("no page: "), F.col("part"))))
    low, high = number(bounds[0]), number(F.element_at(bounds, -1))
    checked = asked.withColumns({"low": F.when(low >= 1, low).otherwise(F.raise_error(F.lit("pages begin at 1"))), "high": F.least(high, F.col("max_pages"))})
    kept = [c for c in specs.columns if c != "max_pages"]
    some = checked.where("low <= high").select(*kept, F.explode(F.sequence(F.col("low") - 1, F.col("high") - 1)).alias("page"))
    every = specs.where((bare == "") & (F.col("max_pages") > 0)).select(*kept, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("max_pages") - 1)).alias("page"))
    return some.union(every).distinct()


def pages_of(spec: str | None, max_pages: int) -> list[int]:
    """``page_ranges`` of one spec on the driver, in order."""
    found: set[int] = set()
    for part in filter(None, (spec or f"1-{max_pages}").replace(" ", "").split(",")):
        first, _, last = part.partition("-")
        if not first.isdigit() or not (last or first).isdigit():
            raise ValueError(f"no page: {part}")
        if int(first) < 1:
            raise ValueError("pages begin at 1")
        found |= set(range(int(first) - 1, min(int(last or first), max_pages)))
    return sorted(found)


def with_timestamp(blocks: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    return blocks.where(~is_blank(F.col(timestamp)))


def with_speaker(blocks: DataFrame, speaker: str = "speaker") -> DataFrame:
    return blocks.where(~is_blank(F.col(speaker)))


def page_flags(blocks: DataFrame) -> DataFrame:
    """(document, page_num, end_of_tape, rest_period, last_type): what a page's blocks say of it."""
    tape = (F.col("type") == "meta") & F.upper("text").contains("END OF TAPE")
    flag = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    return blocks.groupBy("document", "page_num").agg(flag(tape).alias("end_of_tape"), flag(F.upper("text").rlike(texts.as_in_sql(r"\bREST\s+PERIOD\b"))).alias("rest_period"), F.max_by("type", "block_idx").alias("last_type"))


def type_before(blocks: DataFrame) -> DataFrame:
    """(document, page_num, previous_type): the type of the last block of the page before, of those that have blocks."""
    last = blocks.groupBy("document", "page_num").agg(F.max_by("type", "block_idx").alias("last_type"))
    return last.select("document", "page_num", F.lag("last_type").over(Window.partitionBy("document").orderBy("page_num")).alias("previous_type"))


def page_time_lists(blocks: DataFrame, timestamp: str = "timestamp_clean") -> DataFrame:
    """(document, page_num, timestamps): a page's times of comm blocks in order; pages without any have none."""
    held = F.transform(F.sort_array(F.collect_list(F.when((F.col("type") == "comm") & ~is_blank(F.col(timestamp)), F.struct("block_idx", F.col(timestamp).alias("t"))))), lambda x: x["t"])
    return blocks.groupBy("document", "page_num").agg(held.alias("timestamps"))


def type_counts(blocks: DataFrame) -> DataFrame:
    n = lambda kind: F.count_if(F.col("type") == kind)
    return blocks.groupBy("document").agg(n("comm").alias("n_comm"), n("meta").alias("n_meta"), n("annotation").alias("n_annotation"), F.bool_or(F.col("type") == "meta").alias("has_meta"))


def ends_of_type(blocks: DataFrame) -> DataFrame:
    place = F.struct(*ORDER)
    return blocks.groupBy("document", "type").agg(F.min_by("text", place).alias("first_text"), F.max_by("text", place).alias("last_text"), F.count("*").alias("n"))


def page_times(blocks: DataFrame, timestamp: str = "timestamp_clean") -> DataFrame:
    """Last timestamp in list order of each page that has any."""
    return timed_comm(blocks, timestamp).groupBy("document", "page_num").agg(F.max_by(timestamp, "block_idx").alias("last_on_page"))


def last_before(pages: DataFrame, times: DataFrame) -> DataFrame:
    """As-of: the last timestamp of the nearest earlier page that has one."""
    earlier = Window.partitionBy("document").orderBy("page_num").rowsBetween(Window.unboundedPreceding, -1)
    return pages.select("document", "page_num").distinct().join(times, ["document", "page_num"], "left").withColumn("last_before", F.last("last_on_page", ignorenulls=True).over(earlier)).drop("last_on_page")


def stable_run(blocks: DataFrame, timestamp: str = "timestamp_clean", window: int = 6, length: int = 3) -> DataFrame:
    """Comm blocks, and whether the next ``window`` blocks of any kind begin with ``length`` increasing times of comm blocks, 600 s apart at most."""
    ahead = by_page().rowsBetween(0, window - 1)
    at = F.when(F.col("type") == "comm", canonical_seconds(F.col(timestamp)))
    run = F.slice(F.collect_list(at).over(ahead), 1, length)
    steps = F.zip_with(F.slice("run", 1, length - 1), F.slice("run", 2, length - 1), lambda a, b: (b > a) & (b - a <= 600))
    return of_type(blocks.withColumn("run", run), "comm").withColumn("stable", (F.size("run") == length) & F.forall(steps, lambda x: x)).drop("run")


def without_repeated_annotations(blocks: DataFrame, norm: Column) -> DataFrame:
    """Annotations equal to the block just before on their page, itself an annotation, go; blank ones are equal to none."""
    marked = blocks.withColumn("_norm", F.when((F.col("type") == "annotation") & ~is_blank(F.col("text")), norm)).withColumn("_before", F.lag("_norm").over(by_page()))
    return marked.where(F.col("_norm").isNull() | F.col("_before").isNull() | (F.col("_norm") != F.col("_before"))).drop("_norm", "_before")


def merged_runs(blocks: DataFrame, timestamp: str, located: bool = False) -> DataFrame:
    """Neighbouring comm blocks of one page with equal timestamp and speaker become one; ``located`` adds its first place."""
    same = (F.col("type") == "comm") & (F.lag("type").over(by_page()) == "comm") & (F.lag(timestamp).over(by_page()) == F.col(timestamp)) & (F.lag("speaker").over(by_page()) == F.col("speaker")) & ~is_blank(F.col("speaker"))
    island = F.sum(F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).over(by_page())
    grouped = blocks.withColumn("island", island).groupBy("document", "page_num", "island")
    said = F.transform(F.sort_array(F.collect_list(F.struct("block_idx", F.coalesce(F.trim("text"), F.lit("")).alias("t")))), lambda x: x["t"])
    place = [F.min_by("location", F.when(~is_blank(F.col("location")), F.col("block_idx"))).alias("location")] if located else []
    return grouped.agg(F.min("block_idx").alias("block_idx"), *place, F.min_by("type", "block_idx").alias("type"), F.min_by(timestamp, "block_idx").alias(timestamp), F.min_by("speaker", "block_idx").alias("speaker"), F.count("*").alias("n_merged"), F.array_join(F.filter(said, lambda x: x != ""), " ").alias("text")).drop("island")


def relaxed_lookup(wanted: DataFrame, blocks: DataFrame, located: bool = False, last: bool = False) -> DataFrame:
    """First comm block of the page with the wanted timestamp and speaker (and, if ``located``, place), else with the timestamp alone.

    ``last`` takes the last of the agreeing ones. One join on the timestamp; the two strengths are two aggregates over its rows.
    """
    found = blocks.where(F.col("type") == "comm").select("document", "page_num", "timestamp_clean", F.col("block_idx").alias("at"), F.col("speaker").alias("by"), F.col("location").alias("near"))
    keys = ["document", "page_num", "timestamp_clean"]
    agrees = lambda want, has: F.coalesce(F.trim(want) == "", F.lit(True)) | (F.upper(F.trim(want)) == F.upper(has))
    same = agrees(F.col("speaker"), F.col("by")) & (agrees(F.col("location"), F.col("near")) if located else F.lit(True))
    strict = (F.max if last else F.min)(F.when(same, F.col("at")))
    return wanted.join(found, keys, "left").groupBy("document", "page_num", "block_idx", "timestamp_clean").agg(F.coalesce(strict, F.min("at")).alias("found_idx"))


def page_label(page: Column, tape: Column, before: str) -> Column:
    """``PAGE n`` and, where it is known, the tape."""
    return F.concat(page.cast("string"), F.when(is_blank(tape), "").otherwise(F.concat(F.lit(before), tape)))


def with_pages(paged: DataFrame, headers: DataFrame | None) -> DataFrame:
    """``paged`` (document, page_num, ...) with page, tape and page_type; with ``headers`` all of their pages."""
    if headers is None:
        none = F.lit(None).cast("string")
        return paged.withColumns({"page": F.col("page_num"), "tape": none, "page_type": none})
    known = headers.select("document", "page_num", F.coalesce("header.page", F.col("page_num")).alias("page"), "header.tape", "header.page_type")
    return known.join(paged, ["document", "page_num"], "left")


def rendered_text(blocks: DataFrame, timestamp: str, headers: DataFrame | None = None) -> DataFrame:
    """One text per document: a line per block under a line per page; ``headers`` (document, page_num, header) name tapes."""
    lead = F.concat(F.rpad(F.coalesce(F.col(timestamp), F.lit("")), 11, " "), F.lit("  "), F.rpad(F.coalesce("speaker", F.lit("")), 5, " "), F.lit("  "), F.when(is_blank(F.col("location")), "").otherwise(F.concat(F.lit("("), F.col("location"), F.lit(") "))))
    line = F.when(F.col("type") == "comm", F.rtrim(F.concat(lead, F.trim(F.coalesce("text", F.lit("")))))).when(F.col("type") == "continuation", F.concat(F.lit(" " * 20), F.trim("text"))).otherwise(F.trim("text"))
    held = F.transform(F.sort_array(F.collect_list(F.struct("block_idx", line.alias("t")))), lambda x: x["t"])
    paged = with_pages(blocks.groupBy("document", "page_num").agg(F.array_join(held, "\n").alias("lines")), headers)
    label = F.concat(F.lit("==== PAGE "), page_label(F.col("page"), F.col("tape"), " | TAPE "), F.lit(" ===="))
    bodies = F.transform(F.sort_array(F.collect_list(F.struct("page_num", F.concat_ws("\n", label, "lines").alias("body")))), lambda x: x["body"])
    return paged.groupBy("document").agg(F.count("*").alias("page_count"), F.array_join(bodies, "\n\n").alias("rendered"))


def reclassified(blocks: DataFrame) -> DataFrame:
    """Comm blocks that begin with ``--`` and tell a lunar revolution are meta, unidentifiable ones in brackets annotations,
    both without speaker and place; other comm blocks without a speaker are SC's."""
    comm, text = F.col("type") == "comm", F.regexp_replace("text", r"^\s+", "")
    upper = F.upper(text)
    revolution = text.startswith("--") & upper.contains("LUNAR REV")
    unidentified = text.startswith("(") & (upper.contains("UNIDENTIFIABLE") | upper.contains("UNINDENTIFIABLE"))
    kind = F.when(comm & revolution, "meta").when(comm & unidentified, "annotation").otherwise(F.col("type"))
    told = blocks.withColumn("_kind", kind)
    same = F.col("_kind") == F.col("type")
    speaker = F.when(~same, None).when(comm & is_blank(F.col("speaker")), "SC").otherwise(F.col("speaker"))
    places = {"location": F.when(same, F.col("location"))} if "location" in blocks.columns else {}
    return told.withColumns({"speaker": speaker, **places}).withColumn("type", F.col("_kind")).drop("_kind")


#: Fixed value: the label of the net, as a text of its own.
NET = r"^(?i)\(?\s*GOSS\s+NET\s+1\s*\)?$"


def quiet(blocks: DataFrame) -> DataFrame:
    """Without noise: nameless scraps, labels of the net, rests of footers, and comm texts that say nothing."""
    comm, text = F.col("type") == "comm", F.coalesce("text", F.lit(""))
    noise = (comm & lines.is_scrap(F.col("speaker"), text)) | text.rlike(NET) | lines.is_not_one(text) | (comm & texts.is_noise(text))
    return blocks.where(~noise)


def one_voice(blocks: DataFrame) -> DataFrame:
    """Neighbouring comm blocks of one speaker on a page become one where the text goes on, or the one before has no end mark.

    The first gives all columns but the text and, where it has none, timestamp_correction. Continuations from the page before
    stay apart.
    """
    before = lambda c: F.lag(c).over(by_page())
    same = (F.col("type") == "comm") & (before("type") == "comm") & before("speaker").eqNullSafe(F.col("speaker")) & ~F.coalesce("continuation_from_prev", F.lit(False))
    open_ended = F.rtrim(before("text")).rlike(r"[^.?!]$")
    goes_on = lines.starts_continuation(F.col("text")) | F.substring("text", 1, 1).isin(",", ";", ".", ")")
    island = F.sum(F.when(F.coalesce(same & (goes_on | open_ended), F.lit(False)), 0).otherwise(1)).over(by_page())
    rest = [c for c in blocks.columns if c not in ("document", "page_num", "block_idx", "text", "timestamp_correction")]
    first = [F.min_by(c, "block_idx").alias(c) for c in rest]
    told = F.min_by("timestamp_correction", F.when(~is_blank(F.col("timestamp_correction")), F.col("block_idx"))).alias("timestamp_correction")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("block_idx", "text"))), lambda x: F.rtrim(x["text"]))
    text = F.when(F.count("*") > 1, F.trim(F.array_join(parts, " "))).otherwise(F.min_by("text", "block_idx")).alias("text")
    joined = blocks.withColumn("island", island).groupBy("document", "page_num", "island").agg(F.min("block_idx").alias("block_idx"), *first, text, told)
    return joined.select(*blocks.columns)


def column_fill(empty: DataFrame, lines: DataFrame, order: str = "line_no") -> DataFrame:
    """(document, page_num, block_idx, filled): blocks without text and lines of a page, zipped in order; the shorter ends it."""
    k = lambda order: F.row_number().over(Window.partitionBy("document", "page_num").orderBy(order))
    left = empty.select("document", "page_num", "block_idx", k("block_idx").alias("k"))
    right = lines.select("document", "page_num", F.col("text").alias("filled"), k(order).alias("k"))
    return left.join(right, ["document", "page_num", "k"]).drop("k")
