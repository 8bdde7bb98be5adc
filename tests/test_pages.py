from ravelin.operators import pages
from ravelin.plans import transcripts


def read(text, **k):
    return [(r["type"], r["timestamp"], r["speaker"], r["location"], r["text"]) for r in pages.PageReader(**k).read(text)[0]]


def test_lines():
    assert pages.with_clear_times("05:00:05:15 GO") == "05 00 05 15 GO"
    assert pages.with_clear_times("5 feet, 10 and 20 or 30") == "05 10 20 30"
    assert pages.with_clear_times("03 10 47 .1") == "03 10 47 01"  # the fourth group, before tenths are looked for
    assert pages.split_lines("04 12 33 01 CDR Roger. 04 12 33 15 CC Copy that.\n\n[META] x") == [("04 12 33 01 CDR Roger.", None), ("04 12 33 15 CC Copy that.", None), ("x", "meta")]
    assert pages.split_lines("(RF 1) go (RF 2)") == [("(RF 1) go", None), ("(RF 2)", None)]


def test_reader():
    assert read("Tape 1/2\nPage 3\n04 12 33 01 CDR (TRANQ) Roger.\nand go on.\n04 12 33 15 CC Copy that.") == [("comm", "04 12 33 01", "CDR", "TRANQ", "Roger. and go on."), ("comm", "04 12 33 15", "CC", "", "Copy that.")]
    assert read("04 12 33 01\nCC\n(EAGLE)\nGo ahead there.") == [("comm", "04 12 33 01", "CC", "EAGLE", "Go ahead there.")]
    assert read("04 12 33 CC yes\nEND OF TAPE") == [("comm", "04 12 33", "CC", "", "yes"), ("meta", "", "", "", "END OF TAPE")]
    assert read("04 12 33 +5 CDR go")[0][:3] == ("comm", "04 12 33 05", "CDR")  # any separator may stand before a fourth group
    assert read("TIG 12 04 05 06 07 is good")[0][:2] == ("comm", "12 04 05 06")  # cut before the time, as 07 may be a name
    listed = read("\n".join(f"04 12 33 0{i}" for i in range(5)) + "\nCC\none is said.\nCDR\ntwo is said.")
    assert [r[2] for r in listed] == ["CC", "CDR", "", "", ""] and listed[1][4] == "two is said."
    rows, footer = pages.PageReader().read("04 12 33 01 CC go\n***\nTHREE ASTERISKS DENOTE CLIPPING OF WORDS AND PHRASES")
    assert footer and len(rows) == 1
    assert read("") == read(None) == []


def test_verdict():
    assert pages.verdict("Roger we go", "nothing like that here") == "quote"
    assert pages.verdict("Roger we go", "Roger we go to the moon") == "better"
    assert pages.verdict("", "any") == "better" and pages.verdict("Roger we go now.", "Roger we go now") == "same"


def test_pass_merge(spark):
    ddl = "document long, page_num long, block_idx long, type string, timestamp string, speaker string, location string, text string"
    a = spark.createDataFrame([(1, 1, 0, "comm", "t1", None, None, "Roger we go"), (1, 1, 1, "comm", "t2", "CC", None, "Say again please")], ddl)
    b = spark.createDataFrame([(1, 1, 0, "comm", "t1", "CDR", "EAGLE", "Roger we go to the moon"), (1, 1, 1, "continuation", None, None, None, "and this was lost by the first"), (1, 1, 2, "comm", "t2", "CC", None, "Say again please")], ddl)
    got = [(r.block_idx, r.type, r.speaker, r.text) for r in pages.merged_passes(a, b).orderBy("block_idx").collect()]
    assert got == [(0, "comm", "CDR", "Roger we go to the moon"), (1, "continuation", None, "and this was lost by the first"), (2, "comm", "CC", "Say again please")]


def test_page_queries(spark):
    sf = "/root/testdata/sf0.001"
    n = transcripts.fixtures.blocks(spark, sf).where("timestamp_raw is not null").count()
    rows = transcripts.parse_pages(spark, sf)
    assert rows.where("type = 'comm'").count() >= n * 0.9 and rows.where("type = 'header'").count() == 0
    assert transcripts.pass_merge(spark, sf).where("text is null").count() == 0
