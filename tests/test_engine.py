import json

import pytest
from pyspark.sql import functions as F

from ravelin import engine
from ravelin.sources import files

TEXT = """Tape 1/2
Page 3
01 02 03 04 CDR (TRANQ) Houston, we are go.
01 02 O3 10 CC Roger,
copy that now.
01 02 03 08 LMP Looks fine from here. (OVER)
END OF TAPE
GOSS NET 1"""


def test_engine(spark):
    e = engine.TranscriptEngine(spark, engine.Settings(post_merge={"fine": "good"}))
    df = spark.createDataFrame([("A", 1, TEXT), ("A", 2, "01 02 04 00 CC Go ahead there."), ("B", 1, None), ("B", 2, "")], "document string, page_num int, text string")
    got = [(r.page_num, r.type, r.timestamp, r.speaker, r.location, r.text) for r in e.run(df).orderBy("document", "page_num", "block_idx").collect()]
    assert [g[1:] for g in got if g[0] == 1 and g[1] == "comm"] == [
        ("comm", "01 02 03 04", "CDR", "TRANQ", "Houston, we are go."),
        ("comm", "01 02 03 10", "CC", None, "Roger, copy that now."),
        ("comm", "01 02 03 48", "LMP", None, "Looks good from here."),  # short tags in capitals go before calls are looked for
    ]
    assert got[-1][2:] == ("01 02 04 00", "CC", None, "Go ahead there.")
    assert e.run(df.limit(0)).count() == 0


def test_commands(spark, tmp_path):
    d = tmp_path / "in" / "A" / "pages" / "Page_001" / "ocr"
    d.mkdir(parents=True)
    (d / "A_page_0001_ocr_raw.txt").write_text(TEXT)
    at = lambda name: str(tmp_path / name)
    engine.main(["parse", at("in"), at("parsed")], spark)
    engine.main(["postprocess", at("parsed"), at("done")], spark)
    engine.main(["export", at("done"), at("merged")], spark)
    page = files.stored_pages(spark, at("merged")).select("document", F.explode("blocks").alias("b")).where("b.type = 'comm'")
    assert page.count() == 3 and page.first().document == "A"


def test_unknown_passes_are_refused(spark):
    rows = lambda *names: spark.createDataFrame([("A", 1, name, "01 02 04 00 CC Go ahead there.") for name in names], "document string, page_num int, pass string, text string")
    e = engine.TranscriptEngine(spark)
    assert e.parse(rows("raw", "textcol")).where("type = 'comm'").count() == 1
    for name in ("other", None):
        with pytest.raises(ValueError):
            e.parse(rows("raw", name))


PAGE = """APOLLO 11 AIR-TO-GROUND VOICE TRANSCRIPTION
Tape 12 / 3
Page 9
01 02 03 04 CDR (TRANQ) Houston, we are go. 01 02 03 09 CC Roger, (over.)
01 02 03 20 CC Apollo 11, this is Houston at 01 02 04 11 LMP going on. HAWAII (RFV 4)
01 02 04 30 CMP -- stay
*** END OF TAPE ***
THREE ASTERISKS DENOTE CLIPPING OF WORDS AND PHRASES"""


def test_pages_have_headers_and_blocks(spark):
    e = engine.TranscriptEngine(spark, engine.Settings(mission_keywords=["HAWAII"], page_offset=-2))
    df = spark.createDataFrame([("A", 3, PAGE.replace("\n", "\r\n")), ("A", 4, "and so it went on, far.\n01 02 05 00 CC Go."), ("A", 5, "REST PERIOD - NO COMMUNICATIONS Page 5"), ("A", 6, None)], "document string, page_num int, text string")
    got = {r.page_num: r for r in e.read(df).collect()}
    assert {k: tuple(v.header) for k, v in got.items()} == {3: (1, "12/3", True, None, True), 4: (2, None, False, None, False), 5: (3, None, False, "rest_period", False), 6: (4, None, False, None, False)}
    assert [(b.type, b.meta_type) for b in got[3].blocks][-1] == ("meta", "end_of_tape") and len(got[6].blocks) == 0
    assert [(b.type, b.meta_type, b.text) for b in got[5].blocks] == [("meta", "rest_period", "REST PERIOD - NO COMMUNICATIONS")]
    assert (got[4].blocks[0].type, got[4].blocks[0].continuation_from_prev) == ("continuation", None)
    pages = e.corrected_pages(e.read(df))
    headers = {r.page_num: (r.header.page, r.header.tape) for r in pages.collect()}
    assert headers == {3: (1, "1/2"), 4: (2, "2/1"), 5: (3, "2/2"), 6: (4, "2/3")}
    said = [(b.type, b.timestamp, b.speaker, b.text) for r in pages.where("page_num = 3").collect() for b in r.blocks]
    assert ("comm", "01 02 03 09", "CC", "Roger, OVER.") in said
    assert ("comm", "01 02 04 11", "LMP", "Going on.") in said and ("annotation", None, None, "HAWAII (REV 4)") in said


def test_readings_are_merged_and_filled(spark):
    rows = [("A", 1, "raw", "01 02 03 04 CDR Houston, we are go.\n01 02 03 30 LMP"), ("A", 1, "raw_fallback", "01 02 03 04 CDR Houston, we are go for the landing now."), ("A", 1, "textcol", "LMP\n(TRANQ)\nPage 4\nWe see it all from here."), ("A", 2, "textcol", "Alone."), ("B", 1, "faint_fallback", "01 02 03 04 CC Go.")]
    df = spark.createDataFrame(rows, "document string, page_num int, pass string, text string")
    e = engine.TranscriptEngine(spark)
    got = [(r.document, r.timestamp, r.speaker, r.text) for r in e.parse(df).orderBy("document", "page_num", "block_idx").collect()]
    assert got == [("A", "01 02 03 04", "CDR", "Houston, we are go for the landing now."), ("A", "01 02 03 30", "LMP", "We see it all from here."), ("B", "01 02 03 04", "CC", "Go.")]
    only = engine.TranscriptEngine(spark, engine.Settings(readings=["raw"]))
    assert [r.text for r in only.parse(df).orderBy("block_idx").collect()] == ["Houston, we are go.", None]


def test_all_commands(spark, tmp_path, capsys):
    d = tmp_path / "in" / "A" / "pages"
    for n in (1, 2, 3):
        ocr = d / f"Page_{n:03}" / "ocr"
        ocr.mkdir(parents=True)
        (ocr / f"A_page_{n:04}_ocr_raw.txt").write_text(f"01 0{n} 03 04 CDR Houston, page {n} is här.\n01 0{n} 03 10 CC Roger.\nEND OF TAPE" if n != 2 else "REST PERIOD - NO COMMUNICATIONS")
    (tmp_path / "missions.toml").write_text('[mission.1]\nfile_name = "a.PDF"\npage_offset = 0\nmission_keywords = ["X"]\n[mission.1.post_merge.text_replacements]\nRoger = "Rodger"')
    at = lambda name: str(tmp_path / name)
    more = ["--missions", at("missions.toml"), "--document", "A"]
    engine.main(["parse", at("in"), at("parsed"), "--pages", "1-2,3", *more], spark)
    engine.main(["postprocess", at("parsed"), at("done"), *more], spark)
    engine.main(["export", at("done"), at("merged"), *more], spark)
    merged = json.loads(spark.read.text(at("merged_merged/json"), wholetext=True).first()[0])
    assert merged["document"] == "A" and merged["page_count"] == 3 and [p["header"]["tape"] for p in merged["pages"]] == ["1/2", "2/1", "2/2"]
    assert list(merged["pages"][0]["blocks"][0]) == ["type", "timestamp", "speaker", "text"] and merged["pages"][0]["blocks"][0]["text"] == "Houston, page 1 is här."
    assert merged["pages"][1]["blocks"] == [{"type": "meta", "meta_type": "rest_period", "text": "REST PERIOD - NO COMMUNICATIONS"}] and "source" in merged["pages"][0]
    text = spark.read.text(at("merged_merged/text"), wholetext=True).first()[0]
    assert text.startswith("==== PAGE 1 | TAPE 1/2 ====\n01 01 03 04  CDR    Houston, page 1 is här.\n01 01 03 10  CC     Rodger.\n") and text.endswith("\n")
    markdown = spark.read.text(at("merged_merged/markdown"), wholetext=True).first()[0]
    assert "## Page 2 · Tape 2/1\n\n_Rest period - No communications_\n" in markdown and "**END OF TAPE**" in markdown
    index = json.loads(spark.read.text(at("done_index"), wholetext=True).first()[0])
    assert index == {"1": ["01 01 03 04", "01 01 03 10"], "2": [], "3": ["01 03 03 04", "01 03 03 10"]}
    engine.main(["parse", at("in"), at("one"), "--pages", "3"], spark)
    assert [r.page_num for r in files.stored_pages(spark, at("one")).collect()] == [3]
    with pytest.raises(SystemExit):
        engine.main(["export", at("done")], spark)
