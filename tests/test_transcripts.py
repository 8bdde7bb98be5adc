import json
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from ravelin.functions import speakers, texts, timecodes
from ravelin.operators import folds
from ravelin.plans import documents, parallel, registry, streams, transcripts  # noqa: F401
from ravelin.sources import files
from ravelin.streaming import monotonic

SF = "/root/testdata/sf0.001"


def values(spark, f, *inputs):
    df = spark.createDataFrame([(x,) for x in inputs], "x string")
    return [r[0] for r in df.select(f(F.col("x"))).collect()]


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    want, got = con.sql(registry.ORACLES[name]), registry.QUERIES[name](spark, SF)
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    plain = lambda rows, names: sorted(repr([r[names.index(c)] for c in columns]) for r in rows)
    assert plain(got.collect(), got.columns) == plain(want.fetchall(), want.columns)


def test_timecodes(spark):
    seconds = lambda d, h, m, s: d * 86400 + h * 3600 + m * 60 + s
    assert values(spark, timecodes.parsed_seconds, "04 12 11 :6", "94 01 02 03", "55 01 02 03", "23 01 02 03", "04 24 00 00", "04 00 60 00", "O4 I2 ll", None, "", "x") == [
        seconds(4, 12, 11, 6), seconds(4, 1, 2, 3), seconds(5, 1, 2, 3), seconds(3, 1, 2, 3), None, None, seconds(4, 12, 11, 0), None, None, None
    ]
    assert values(spark, timecodes.carried, "01 06 59 60", "01 06 59", "01 06 59 --", "01 23 59 60", None) == ["01 07 00 00", "01 06 59", "01 06 59 --", "02 00 00 00", None]
    df = spark.createDataFrame([(seconds(4, 12, 46, 15), seconds(4, 22, 45, 30)), (seconds(5, 1, 0, 0), seconds(4, 22, 45, 30))], "a bigint, b bigint")
    assert [r[0] for r in df.select(timecodes.hour_snapped(F.col("a"), F.col("b"))).collect()] == [seconds(4, 22, 46, 15), None]


def test_texts_and_speakers(spark):
    assert values(spark, texts.is_noise, "?", "--", "12", "1.", "OK", None, " ") == [True, True, True, True, False, True, True]
    assert values(spark, texts.radio_called, "go (OVER)", "(roger.)", "(other)") == ["go OVER", "ROGER.", "(other)"]
    assert values(spark, speakers.corrected_speaker, "CDF", "IMP", "CC?", "HOUSTON", "cdr", "nobody", None) == ["CDR", "LMP", "CC", "CC", "CDR", "", ""]
    assert values(spark, speakers.is_garbage_speaker, "CDR", "CDF", "12", "TR TR", "(TR) (TR)", "WHO?", None, "JACK") == [False, False, True, True, True, True, True, False]
    assert values(spark, speakers.exact_location, "Eagle", "LAUGHTER", "04 08", "EAGIE", None) == ["EAGLE", "", "", None, ""]
    assert values(spark, texts.station_variants, "AND THE NATION 4", "THE", "") == [["NATION 4"], [], []]


@pytest.mark.parametrize(
    ("read", "prev", "ended", "want"),
    [(None, (1, 1), False, ("1/2", False)), ("67/1", (67, 1), False, ("67/2", True)), ("6/5", (66, 4), False, ("66/5", True)), ("73/5", (72, 4), False, ("73/5", False)), ("32/1", (30, 9), True, ("32/1", False)), ("x", (3, 4), False, ("3/5", True)), ("11/1", (9, 0), False, ("11/1", False)), ("9/1", (7, 0), False, ("7/1", True))],
)
def test_tape_rule(read, prev, ended, want):
    x, y, corrected = folds.tape_step(*prev, ended, read)
    assert (f"{x}/{y}", corrected) == want


def test_tapes_from_the_first_page_of_the_document(spark):
    """Pages below 1 have no label; 624 pages, of which 84 end a tape, run from 1/2 to 85/7."""
    ends = {2 + 7 * i for i in range(83)} | {617}
    rows = [(1, n, n, None, n in ends) for n in range(1, 625)] + [(2, n, n - 2, None, False) for n in range(1, 5)]
    df = spark.createDataFrame(rows, "document long, page_num long, page long, ocr_tape string, end_of_tape boolean")
    got = {(r.document, r.page_num): r.tape for r in folds.tapes(df).collect()}
    assert (got[1, 1], got[1, 624]) == ("1/2", "85/7") and len(got) == 628
    assert [got[2, n] for n in range(1, 5)] == [None, None, "1/2", "1/3"]
    assert folds.tapes(df.limit(0)).collect() == []


def test_files(spark, tmp_path):
    pages = tmp_path / "doc" / "pages"
    for n, body in ((1, {"header": {"page": 1}, "blocks": [{"type": "comm", "text": "é"}]}), (2, None), (3, {"header": {"page": 0}, "blocks": []})):
        d = pages / f"Page_{n:03d}" / "ocr"
        d.mkdir(parents=True)
        (d.parent / "p.json").write_text(json.dumps(body) if body else "{broken")
        (d / f"doc_page_{n:04d}_ocr_raw.txt").write_text(f"text {n}\nmore")
    assert [(r.page_num, r.blocks[0].text) for r in files.page_files(spark, str(tmp_path)).collect()] == [(1, "é")]
    assert sorted((r.document, r.page_num, r["pass"], r.text) for r in files.ocr_texts(spark, str(tmp_path)).collect())[0] == ("doc", 1, "raw", "text 1\nmore")
    (tmp_path / "i.json").write_text('{"2": ["01 00 00 00", "01 00 00 05"]}')
    assert [tuple(r) for r in files.timestamp_index(spark, str(tmp_path / "i.json")).collect()] == [(2, 0, "01 00 00 00"), (2, 1, "01 00 00 05")]
    assert files.configuration("a = 1\nb = 2", "[mission.x]\nfile_name = 'F.pdf'\nb = 3", "f.PDF") == {"a": 1, "b": 3, "file_name": "F.pdf"}


def test_stream_equals_fold(spark, tmp_path):
    rows = registry.fixtures.blocks(spark, SF).where("type = 'comm'").select("document", "page_num", "block_idx", "s")
    rows.where("page_num <= 5").coalesce(1).write.parquet(f"{tmp_path}/in/a")
    stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    q = monotonic.monotonic_stream(stream).writeStream.format("memory").queryName("fixed").option("checkpointLocation", f"{tmp_path}/ck").start()
    q.processAllAvailable()
    rows.where("page_num > 5").coalesce(1).write.parquet(f"{tmp_path}/in/b")
    q.processAllAvailable()
    q.stop()
    got = {(r.document, r.page_num, r.block_idx): r.fixed for r in spark.table("fixed").collect()}
    fold = folds.monotonic(registry.fixtures.blocks(spark, SF)).select("document", "page_num", "block_idx", timecodes.canonical_seconds(F.col("fixed")).alias("f"))
    assert got == {(r.document, r.page_num, r.block_idx): r.f for r in fold.collect()}
