"""Scans and sinks: OCR text files, page JSON, timestamp index, lexicon, configuration."""

from __future__ import annotations

import tomllib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ravelin.sources import pagefiles

PASSES = ("textcol", "faint_fallback", "raw_fallback", "raw")
BLOCK = "struct<type:string,timestamp:string,speaker:string,location:string,text:string,meta_type:string,timestamp_correction:string,hint:string,continuation_from_prev:boolean>"
PAGE = f"header struct<page:int,tape:string,is_apollo_title:boolean,page_type:string,footer:boolean>, blocks array<{BLOCK}>"


def _file() -> Column:
    return F.col("_metadata.file_path")


def ocr_texts(spark: SparkSession, root: str) -> DataFrame:
    """(document, page_num, pass, text): one row per page and pass, the first file of each by path."""
    names = "|".join(PASSES)
    pattern = rf"([^/]+)_page_(\d+)_ocr_({names})\.txt$"
    read = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*_ocr_*.txt").text(root, wholetext=True)
    rows = read.select(F.col("value").alias("text"), _file().alias("path"))
    part = lambda i: F.regexp_extract("path", pattern, i)
    named = rows.select(part(1).alias("document"), part(2).try_cast("int").alias("page_num"), part(3).alias("pass"), "text", "path").where("document <> ''")
    return named.groupBy("document", "page_num", "pass").agg(F.min_by("text", "path").alias("text"))


def page_files(spark: SparkSession, root: str) -> DataFrame:
    """(document, page_num, file, header, blocks) of page JSON below ``Page_*`` folders, in order of (page_num, file).

    Broken files are left out, as are pages up to 0; a folder gives its first file. The document is what the file's
    name has before ``_page_``.
    """
    read = spark.read.schema(PAGE).option("multiLine", True).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(root)
    rows = read.select("*", _file().alias("file")).withColumn("folder", F.regexp_extract("file", r"(.*/Page_\d+)/", 1)).where("folder <> ''")
    first = rows.withColumn("k", F.row_number().over(Window.partitionBy("folder").orderBy("file"))).where("k = 1")
    number = F.coalesce(F.col("header.page"), F.regexp_extract("folder", r"(\d+)$", 1).try_cast("int"))
    return first.select(F.regexp_extract("file", r"([^/]+)_page_\d+[^/]*$", 1).alias("document"), number.cast("long").alias("page_num"), "file", "header", "blocks").where("page_num > 0").orderBy("page_num", "file")


def _stored(spark: SparkSession, root: str, pages: str | None) -> DataFrame:
    read = pagefiles.read_files(spark, root, pages=pages)
    page = F.from_json("content", f"{PAGE}, _broken string", {"columnNameOfCorruptRecord": "_broken"})
    return read.withColumn("page", page).withColumn("error", F.coalesce("error", F.when(F.col("page._broken").isNotNull() | F.col("page").isNull(), "no page JSON")))


def stored_pages(spark: SparkSession, root: str, pages: str | None = None) -> DataFrame:
    """(document, page_num, header, blocks, source) of the page files that ``write_pages`` wrote; ``pages`` are ranges, of which
    only the files are opened. Broken files are left out."""
    return _stored(spark, root, pages).where("error IS NULL").select("document", "page_num", "page.header", "page.blocks", F.col("file").alias("source"))


def broken_pages(spark: SparkSession, root: str, pages: str | None = None) -> DataFrame:
    """(document, page_num, file, error) of page files that can't be read, or hold no page."""
    return _stored(spark, root, pages).where("error IS NOT NULL").select("document", "page_num", "file", "error")


def page_folder(page_num: Column) -> Column:
    """``Page_NNN`` of a page counted from 1."""
    return F.concat(F.lit("Page_"), F.when(page_num < 1000, F.lpad(page_num.cast("string"), 3, "0")).otherwise(page_num.cast("string")))


def page_id(document: Column, page_num: Column) -> Column:
    """``<document>_page_NNNN`` of a page counted from 1."""
    return F.concat(document.cast("string"), F.lit("_page_"), F.when(page_num < 10000, F.lpad(page_num.cast("string"), 4, "0")).otherwise(page_num.cast("string")))


def page_paths(pages: DataFrame) -> DataFrame:
    """``pages`` (document, page_num) with the folders and files that belong to each page."""
    folder = F.concat_ws("/", F.col("document").cast("string"), F.lit("pages"), page_folder(F.col("page_num")))
    name = page_id(F.col("document"), F.col("page_num"))
    return pages.withColumns({"page_dir": folder, "page_id": name, "page_json": F.concat(folder, F.lit("/"), name, F.lit(".json")), "raw_pdf": F.concat(folder, F.lit("/assets/"), name, F.lit("_raw.pdf")), "image": F.concat(folder, F.lit("/assets/"), name, F.lit("_enhanced.png"))})


def numbered_folders(paths: DataFrame) -> DataFrame:
    """``paths`` (path) with the number at the end, 0 without one, in its order."""
    return paths.withColumn("n", F.coalesce(F.regexp_extract("path", r"(\d+)/?$", 1).try_cast("bigint"), F.lit(0).cast("bigint"))).orderBy("n", "path")


def timestamp_index(spark: SparkSession, path: str) -> DataFrame:
    """(page_num, idx, timestamp) of an index file, a map of pages to lists of timestamps."""
    read = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,array<string>>").alias("m"))
    pages = read.where("m is not null").select(F.explode("m").alias("page", "ts"))
    return pages.select(F.col("page").try_cast("int").alias("page_num"), F.posexplode("ts").alias("idx", "timestamp")).where("page_num is not null")


def lexicon(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words with frequency, vocabulary, and bigrams with frequency; all empty for a broken file."""
    read = spark.read.text(path, wholetext=True).select(F.from_json("value", "top_words map<string,bigint>, alphabetical_vocabulary array<string>, common_bigrams map<string,bigint>").alias("x"))
    return read.select(F.explode("x.top_words").alias("word", "n")), read.select(F.explode("x.alphabetical_vocabulary").alias("word")), read.select(F.explode("x.common_bigrams").alias("bigram", "n"))


def configuration(default: str, mission: str | None = None, file_name: str | None = None) -> dict:
    """Settings from TOML texts: the mission of that file name (case does not matter) over the defaults."""
    settings = tomllib.loads(default)
    for values in tomllib.loads(mission or "").get("mission", {}).values():
        if file_name and str(values.get("file_name", "")).strip().lower() == file_name.lower():
            settings |= values
    return settings


def write_pages(pages: DataFrame, root: str) -> None:
    """One file of page JSON per page below ``root``; absent keys are left out, files of other pages stay."""
    content = F.concat(F.to_json(F.struct("header", "blocks")), F.lit("\n"))
    pagefiles.write_files(pages.select("document", "page_num", content.alias("content")), root)


def write_texts(rows: DataFrame, path: str, text: str, by: list[str]) -> None:
    """One text per row, with a newline at its end, in folders by the columns ``by``."""
    rows.select(*by, F.concat(F.regexp_replace(text, r"\s+$", ""), F.lit("\n")).alias("value")).write.mode("overwrite").partitionBy(*by).option("lineSep", "\n").text(path)


def index_of(lists: DataFrame) -> DataFrame:
    """(document, index): the JSON map of pages to their times, of (document, page_num, timestamps)."""
    entries = F.sort_array(F.collect_list(F.struct("page_num", "timestamps")))
    named = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["page_num"].cast("string"), e["timestamps"])))
    return lists.groupBy("document").agg(F.to_json(named).alias("index"))


def write_index(lists: DataFrame, path: str) -> None:
    index_of(lists).write.mode("overwrite").partitionBy("document").text(path)


def merged_documents(pages: DataFrame) -> DataFrame:
    """(document, page_count, merged): one JSON text per document, pages in order, those numbered below 1 left out."""
    held = F.sort_array(F.collect_list(F.struct("page_num", "header", "blocks")))
    kept = F.transform(held, lambda p: F.struct(p["header"].alias("header"), p["blocks"].alias("blocks")))
    grouped = pages.where(F.coalesce("header.page", F.lit(0)) > 0).groupBy("document").agg(F.count("*").alias("page_count"), kept.alias("pages"))
    return grouped.select("document", "page_count", F.to_json(F.struct("document", "page_count", "pages")).alias("merged"))
