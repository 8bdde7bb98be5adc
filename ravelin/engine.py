"""The transcript engine: OCR text to pages, blocks corrected, documents exported.

Each stage maps DataFrames to DataFrames keyed (document, page_num, block_idx), so any of them can be
run alone from stored results, as ``python -m ravelin.engine`` does.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin import config, ocr
from ravelin.config import Settings
from ravelin.functions import repairs
from ravelin.operators import blocks as ops
from ravelin.operators import building, export, folds, metrics, postprocess, spelling, stitches
from ravelin.operators.building import exploded, page_rows
from ravelin.shipping import ship
from ravelin.sources import files, pagefiles, pdf, resume, timeindex
from ravelin.sources.stored import written

__all__ = ["Settings", "TranscriptEngine", "exploded", "main"]
KEY = ["document", "page_num", "block_idx"]
#: The readings of a page, best-named first, and that of its text column.
PASSES = building.PASSES


class TranscriptEngine:
    def __init__(self, spark: SparkSession, settings: Settings | None = None) -> None:
        self.spark, self.settings = spark, settings or Settings()
        ship(spark)

    def building(self) -> building.Building:
        s = self.settings
        return building.Building(s.valid_speakers, tuple(s.mission_keywords), tuple(s.valid_locations), tuple(s.invalid_location_annotations), s.footer_text_overrides, s.page_offset)

    def corrector(self) -> repairs.TextCorrector | None:
        """Words are corrected only where there is a lexicon; its file is held by the driver and every worker."""
        s = self.settings
        if not s.lexicon or not os.path.exists(s.lexicon):
            return None
        top, vocabulary, bigrams = files.lexicon(self.spark, s.lexicon)
        counts = lambda df, key: {r[key]: r["n"] for r in df.collect()}
        speller = spelling.lexicon_speller(counts(top, "word"), [r["word"] for r in vocabulary.collect()], counts(bigrams, "bigram"), s.mission_keywords)
        return repairs.TextCorrector(speller, s.mission_keywords, s.text_replacements) if speller.known else None

    def read(self, page_texts: DataFrame) -> DataFrame:
        """(document, page_num, header, blocks) of (document, page_num, text), or of several passes of each page.

        The best-named pass is read first and each further one fills it; the text column fills what has no text.
        ValueError on a pass of another name or none. Passes that the settings turn off are left out.
        """
        if "pass" in page_texts.columns:
            unknown = page_texts.where(F.col("pass").isNull() | ~F.col("pass").isin(*PASSES, building.COLUMN)).select("pass").first()
            if unknown:
                raise ValueError(f"unknown pass {unknown[0]!r}")
            page_texts = page_texts.where(F.col("pass").isin(self.settings.readings))
        return building.continued_pages(building.built_pages(page_texts, self.building()))

    def parse(self, page_texts: DataFrame) -> DataFrame:
        """The blocks of ``read``."""
        return exploded(self.read(page_texts))

    def postprocess(self, blocks: DataFrame, listed: DataFrame | None = None) -> DataFrame:
        """Blocks with corrected structure, times, speakers, places and texts, without noise.

        ``listed`` is a timestamp index (document, page_num, timestamps), for the times before pages of a selection.
        """
        s = self.settings
        c = postprocess.Correction(s.valid_speakers, s.speaker_ocr_fixes, s.valid_locations, s.invalid_location_annotations, s.mission_keywords, s.manual_speaker_corrections, self.corrector())
        return postprocess.postprocessed(blocks, c, listed)

    def headers(self, pages: DataFrame) -> DataFrame:
        """(document, page_num, header) with each page's number and tape, by dead reckoning along the document."""
        page = (F.col("page_num") + self.settings.page_offset).cast("int")
        read = pages.select("document", "page_num", "header", page.alias("page"), F.col("header.tape").alias("ocr_tape"), building.end_of_tape(F.col("blocks")).alias("end_of_tape"))
        tapes = folds.tapes(read).select("document", "page_num", "tape")
        told = F.col("header").withField("page", F.col("page")).withField("tape", F.col("tape"))
        return read.drop("ocr_tape", "end_of_tape").join(tapes, ["document", "page_num"]).select("document", "page_num", told.alias("header"))

    def corrected_pages(self, pages: DataFrame, listed: DataFrame | None = None) -> DataFrame:
        """(document, page_num, header, blocks) of corrected blocks under corrected headers."""
        done = page_rows(self.postprocess(exploded(pages), listed), pages.select("document", "page_num", "header"))
        return page_rows(exploded(done), self.headers(done))

    def export(self, blocks: DataFrame) -> DataFrame:
        """Blocks of whole documents: speakers told by who spoke before, times strictly increase, annotations don't repeat, equal utterances are one."""
        s = self.settings
        return export.exported(blocks, s.post_merge, s.valid_speakers, s.mission_keywords)

    def page_json(self, blocks: DataFrame) -> DataFrame:
        """(document, page_num, header, blocks), as the page writer takes them."""
        return page_rows(blocks)

    def run(self, page_texts: DataFrame) -> DataFrame:
        """Blocks of the texts of all pages, ready for export; pages that the document numbers below 1 go last."""
        return self.export(self.postprocess(self.parse(page_texts)).where(F.col("page_num") + self.settings.page_offset > 0))

    def write_merged(self, pages: DataFrame, target: str) -> None:
        """Merged JSON, text and Markdown of each document, and its pages, below ``target``."""
        pages = export.displayed(pages)
        source = [F.col("source")] if "source" in pages.columns else []
        headers = pages.select("document", "page_num", "header", *source)
        blocks = self.export(exploded(pages))
        files.write_pages(page_rows(blocks, headers.select("document", "page_num", "header")), target)
        files.write_texts(export.merged_json(blocks, headers), f"{target}_merged/json", "merged", ["document"])
        files.write_texts(ops.rendered_text(blocks, "timestamp", headers), f"{target}_merged/text", "rendered", ["document"])
        files.write_texts(stitches.rendered_markdown(blocks, "timestamp", headers), f"{target}_merged/markdown", "markdown", ["document"])

    def write_index(self, pages: DataFrame, target: str, whole: bool = True) -> None:
        """The timestamp index of each document: the table, in which pages take the place of those before, and its JSON."""
        timeindex.upsert(page_times(pages), f"{target}_times", whole)
        files.write_index(timeindex.read(self.spark, f"{target}_times"), f"{target}_index")

    def process(self, images: DataFrame, backend: ocr.OcrBackend, prompts: dict[str, str] | None = None) -> DataFrame:
        """(document, page_num, pass, text, error) of page images, one row per page and reading."""
        s, told = self.settings, prompts or config.PROMPTS
        asked = {"raw": told[s.ocr_prompt], "raw_fallback": told["column" if s.ocr_prompt == "plain" else "plain"], "faint_fallback": told[s.ocr_prompt], "textcol": told["text_column"]}
        return ocr.read_images(images, backend, {k: v for k, v in asked.items() if k in s.readings})


def read_all(engine: TranscriptEngine, images: DataFrame, backend: ocr.OcrBackend, target: str, prompts: dict[str, str] | None = None, step: int = resume.STEP) -> DataFrame:
    """(document, page_num, pass, text) of page images, read as far as an earlier run to ``target`` has not done so.

    Every reading is a file below ``target``_ocr. Pages of which a reading failed are tried again at the next start, and pages
    whose image, prompts or readings are others than before.
    """
    told = str(sorted((prompts or config.PROMPTS).items())) + str(engine.settings.readings) + engine.settings.ocr_prompt + (engine.settings.ocr_model or "")
    hashed = F.sha2(F.concat(F.coalesce("image", F.lit(b"")), F.lit(told).cast("binary")), 256)

    def work(part: DataFrame) -> DataFrame:
        read = written(engine.process(part, backend, prompts), "readings")
        pagefiles.write_files(read.where("error IS NULL").select("document", "page_num", F.col("pass").alias("reading"), F.col("text").alias("content")), f"{target}_ocr")
        return read.groupBy("document", "page_num").agg(F.count("error").alias("failed")).where("failed = 0")

    resume.in_steps(images, hashed, f"{target}_read", work, step)
    texts = pagefiles.read_files(engine.spark, f"{target}_ocr", "text").where("error IS NULL")
    wanted = images.select(F.col("document").cast("string"), F.col("page_num").cast("long"))
    return texts.join(wanted, ["document", "page_num"], "left_semi").select("document", "page_num", F.col("reading").alias("pass"), F.col("content").alias("text"))


def page_times(pages: DataFrame) -> DataFrame:
    """(document, page_num, timestamps) of all pages, also of those without blocks."""
    lists = ops.page_time_lists(exploded(pages), "timestamp")
    return pages.select("document", "page_num").join(lists, ["document", "page_num"], "left").withColumn("timestamps", F.coalesce("timestamps", F.array()))


def selected(pages: DataFrame, spec: str | None) -> DataFrame:
    """The pages of a range such as ``1-50,60``; all without one."""
    if not spec:
        return pages
    last = pages.agg(F.max("page_num")).first()[0] or 0
    wanted = pages.sparkSession.createDataFrame([(spec, int(last))], "spec string, max_pages bigint")
    return pages.join(F.broadcast(ops.page_ranges(wanted).select((F.col("page") + 1).alias("page_num"))), "page_num", "left_semi").select(*pages.columns)


def main(arguments: Iterable[str] | None = None, spark: SparkSession | None = None) -> None:
    a = argparse.ArgumentParser(prog="ravelin.engine")
    a.add_argument("command", choices=["process", "parse", "postprocess", "export", "info"])
    a.add_argument("source", help="a PDF (process, info), a folder of OCR texts (parse), or of page JSON written by the stage before")
    a.add_argument("target", nargs="?")
    a.add_argument("--settings", help="TOML file of defaults")
    a.add_argument("--missions", help="TOML file of missions")
    a.add_argument("--document", help="file name that chooses the mission")
    a.add_argument("--prompts", help="TOML file of prompts")
    a.add_argument("--pages", help="such as 1-50,60")
    a.add_argument("--ocr-url")
    a.add_argument("--input", default="input", help="folder of PDFs that are named without one")
    a.add_argument("--no-ocr", action="store_true", help="images only")
    given = a.parse_args(None if arguments is None else list(arguments))
    if given.command != "info" and not given.target:
        a.error("target is missing")
    spark = spark or SparkSession.builder.getOrCreate()
    settings = config.load(given.settings, given.missions, given.document)
    settings.ocr_url = given.ocr_url or settings.ocr_url
    engine = TranscriptEngine(spark, settings)
    if given.command in ("info", "process"):
        given.source = config.source_path(given.source, given.input)
    if given.command == "info":
        print("\n".join(f"{k}: {v}" for k, v in pdf.info(given.source).items()))
    elif given.command == "process":
        images = pdf.page_images(spark, given.source, ops.pages_of(given.pages, pdf.info(given.source)["page_count"]), settings.dpi)
        images.write.mode("overwrite").parquet(f"{given.target}_images")
        stored = spark.read.parquet(f"{given.target}_images")
        metrics.totals(stored).show()
        if not given.no_ocr:
            backend = ocr.HttpOcr(settings.ocr_url or "", settings.ocr_model, settings.ocr_timeout, settings.ocr_max_tokens)
            pages = engine.read(read_all(engine, stored, backend, given.target, config.prompts(given.prompts)))
            files.write_pages(pages, f"{given.target}_pages")
            done = engine.corrected_pages(files.stored_pages(spark, f"{given.target}_pages"))
            files.write_pages(done, f"{given.target}_corrected")
            engine.write_merged(files.stored_pages(spark, f"{given.target}_corrected"), given.target)
    elif given.command == "parse":
        files.write_pages(engine.read(selected(files.ocr_texts(spark, given.source), given.pages)), given.target)
    else:
        pages = selected(files.stored_pages(spark, given.source, given.pages), given.pages)
        if given.command == "postprocess":
            # A selection begins with the times that an earlier run listed for the pages before it.
            listed = timeindex.read(spark, f"{given.target}_times") if given.pages else None
            files.write_pages(engine.corrected_pages(pages, listed), given.target)
            engine.write_index(files.stored_pages(spark, given.target, given.pages), given.target, whole=not given.pages)
        else:
            engine.write_merged(pages, given.target)


if __name__ == "__main__":
    main()
