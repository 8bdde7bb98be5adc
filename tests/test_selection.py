"""Runs over some pages of a document, what they begin with and what they leave."""

import random

from pyspark.sql import functions as F

from ravelin import engine
from ravelin.operators import blocks as ops
from ravelin.operators import corrections, export
from ravelin.functions import texts
from ravelin.sources import files, timeindex


def stamp(s):
    return f"{s // 86400:02} {s // 3600 % 24:02} {s // 60 % 60:02} {s % 60:02}"


def test_times_of_a_selection_equal_those_of_a_whole_run(spark, tmp_path):
    rnd = random.Random(7)
    at, pages = 90_000, []
    for n in range(1, 61):
        blocks = []
        for _ in range(rnd.randrange(4) if n not in (49, 53) else 0):
            at += rnd.choice([20, 45, 50, -30, -3000, 5000])
            blocks.append({"type": "comm", "timestamp": stamp(at) if rnd.random() < 0.8 else None, "speaker": rnd.choice(["CDR", "CC"]), "text": f"Words of page {n} said at {at}."})
        pages.append({"document": "A", "page_num": n, "header": {"page": n}, "blocks": blocks})
    df = spark.createDataFrame(pages, f"document string, page_num long, {files.PAGE}")
    source, target, part = (str(tmp_path / n) for n in ("parsed", "whole", "part"))
    files.write_pages(df, source)
    engine.main(["postprocess", source, target], spark)
    engine.main(["postprocess", source, part, "--pages", "1-49"], spark)
    engine.main(["postprocess", source, part, "--pages", "50-60"], spark)
    times = lambda root: {r.page_num: r.timestamps for r in engine.page_times(files.stored_pages(spark, root)).collect()}
    whole = times(target)
    assert times(part) == whole and sum(map(len, whole.values())) > 50
    assert {r.page_num: r.timestamps for r in timeindex.read(spark, part + "_times").collect()} == whole
    assert spark.read.text(part + "_index", wholetext=True).first()[0] == spark.read.text(target + "_index", wholetext=True).first()[0]
    engine.main(["postprocess", source, target, "--pages", "50-52,60"], spark)
    assert times(target) == whole  # repeated over pages of a whole run, it gives the same and leaves the rest


def test_index_keeps_pages_that_are_not_replaced(spark, tmp_path):
    path = str(tmp_path / "times")
    rows = lambda *r: spark.createDataFrame(list(r), "document string, page_num long, timestamps array<string>")
    assert timeindex.read(spark, path).collect() == []
    timeindex.upsert(rows(("A", 1, ["a"]), ("A", 150, ["b"]), ("B", 1, [])), path)
    timeindex.upsert(rows(("A", 1, ["new"]), ("A", 2, ["c"])), path)
    assert sorted(map(tuple, timeindex.read(spark, path).collect())) == [("A", 1, ["new"]), ("A", 2, ["c"]), ("A", 150, ["b"]), ("B", 1, [])]
    timeindex.upsert(rows(("A", 2, ["c"])), path, whole=True)
    assert [tuple(r) for r in timeindex.read(spark, path).collect()] == [("A", 2, ["c"])]


def test_listed_pages_set_the_time_before(spark):
    blocks = spark.createDataFrame([(1, 5, 0, "comm", None), (1, 7, 0, "comm", None), (2, 1, 0, "comm", None)], "document long, page_num long, block_idx long, type string, timestamp string")
    listed = spark.createDataFrame([("1", 4, ["01 00 00 05", "01 00 00 09"]), ("1", 5, ["09 00 00 00"]), ("1", 6, []), ("2", 3, ["01 00 00 00"])], "document string, page_num long, timestamps array<string>")
    got = {(r.document, r.page_num): r.fixed for r in corrections.corrected_times(blocks, listed=listed).collect()}
    assert got == {(1, 5): "01 00 00 10", (1, 7): "01 00 00 11", (2, 1): None}


def test_pages_that_the_document_numbers_below_one_are_not_exported(spark, tmp_path):
    e = engine.TranscriptEngine(spark, engine.Settings(page_offset=-2))
    said = spark.createDataFrame([("A", n, f"01 02 0{n} 04 CDR This is page {n}.") for n in range(1, 5)], "document string, page_num int, text string")
    pages = e.corrected_pages(e.read(said))
    e.write_merged(pages, str(tmp_path / "out"))
    merged = spark.read.text(str(tmp_path / "out_merged/json"), wholetext=True).first()[0]
    assert merged.startswith('{"document":"A","page_count":2,') and "page 2" not in merged and '"page":1,' in merged
    assert [r.page_num for r in files.stored_pages(spark, str(tmp_path / "out")).orderBy("page_num").collect()] == [3, 4]
    assert sorted(r.page_num for r in e.run(said).collect()) == [3, 4]
    assert export.displayed(spark.createDataFrame([(1, (None,)), (2, (0,)), (3, (1,))], "page_num long, header struct<page:int>")).collect()[0].page_num == 3


def test_kinds_and_repeated_remarks(spark):
    said = ["-- BEGIN LUNAR REV 4", "BEGIN LUNAR REV 4", " --end lunar rev", "(unidentifiable)", "unidentifiable", "(Unindentifiable) go", "go"]
    df = spark.createDataFrame([(i, "comm", t, None if i % 2 else "CC", "EAGLE") for i, t in enumerate(said)] + [(9, "meta", "-- LUNAR REV", None, None)], "i long, type string, text string, speaker string, location string")
    got = [(r.type, r.speaker, r.location) for r in ops.reclassified(df).orderBy("i").collect()]
    gone = ("meta", None, None), ("annotation", None, None)
    assert got == [gone[0], ("comm", "SC", "EAGLE"), gone[0], gone[1], ("comm", "CC", "EAGLE"), gone[1], ("comm", "CC", "EAGLE"), gone[0]]
    rows = [(1, 0, "annotation", "Laughter"), (1, 1, "annotation", "laughter!"), (1, 2, "annotation", ""), (1, 3, "annotation", ""), (2, 0, "annotation", "Pause"), (3, 0, "annotation", "pause"), (3, 1, "comm", "pause"), (3, 2, "annotation", "pause")]
    df = spark.createDataFrame([(1, *r) for r in rows], "document long, page_num long, block_idx long, type string, text string")
    kept = ops.without_repeated_annotations(df, texts.comparable(F.col("text"))).select("page_num", "block_idx").orderBy("page_num", "block_idx").collect()
    assert [tuple(r) for r in kept] == [(1, 0), (1, 2), (1, 3), (2, 0), (3, 0), (3, 1), (3, 2)]
