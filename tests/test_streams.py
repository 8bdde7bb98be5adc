"""The streams against the scans over the same rows."""

import random

import pytest

from ravelin.operators import corrections, folds
from ravelin.plans import streams
from ravelin.streaming import pages

PIECES = 3


@pytest.fixture(autouse=True)
def few(monkeypatch):
    monkeypatch.setattr(streams, "PIECES", PIECES)


def test_clock_for_any_cut_and_order(spark):
    rnd = random.Random(4)
    rows = []
    for doc in range(3):
        at = 90_000
        for page in range(1, 5):
            for i in range(rnd.randrange(6)):
                at += rnd.choice([5, 40, 40, -30, -4000, 50_000])
                t = rnd.choice([None, "", "??", *[f"{at // 86400:02} {at // 3600 % 24:02} {at // 60 % 60:02} {at % 60:02}"] * 6])
                rows.append((doc, page, i, rnd.choice(["comm", "comm", "comm", "meta"]), t, rnd.choice([None, "5"])))
    cuts = {d: sorted(rnd.randrange(0, 20) for _ in range(PIECES - 1)) for d in range(3)}
    place: dict[int, int] = {}
    dealt = []
    for row in rows:
        n = place[row[0]] = place.get(row[0], -1) + 1
        dealt.append((*row, sum(n >= c for c in cuts[row[0]])))
    rnd.shuffle(dealt)
    ddl = "document long, page_num long, block_idx long, type string, timestamp string, hint string"
    got = streams.fed(spark, spark.createDataFrame(dealt, ddl + ", piece int"), "clock", lambda s: pages.corrected_times_stream(s, hint="hint"))
    want = corrections.corrected_times(spark.createDataFrame(rows, ddl), hint="hint")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_rows_of_a_closed_page_are_late(spark):
    rows = [(1, 1, 0, "comm", "01 00 00 10", 0), (1, 2, 0, "comm", "01 00 00 20", 1), (1, 1, 1, "comm", "01 00 00 15", 2), (1, 3, 0, "comm", "01 00 00 05", 2)]
    df = spark.createDataFrame(rows, "document long, page_num long, block_idx long, type string, timestamp string, piece int")
    got = {(r.page_num, r.block_idx): (r.timestamp, r.fixed, r.correction) for r in streams.fed(spark, df, "clock", pages.corrected_times_stream).collect()}
    assert got == {(1, 0): ("01 00 00 10", "01 00 00 10", None), (2, 0): ("01 00 00 20", "01 00 00 20", None), (1, 1): ("01 00 00 15", None, "late"), (3, 0): ("01 00 00 05", "01 00 00 05", "out_of_order")}


def test_tapes_for_any_order_gaps_and_repeats(spark):
    rnd = random.Random(6)
    ddl = "document long, page_num long, page long, ocr_tape string, end_of_tape boolean"
    rows = [(d, n, n - 2, rnd.choice([None, "x", "1/2", "1/3", "2/1", "2/2"]), rnd.random() < 0.2) for d in range(2) for n in range(1, 9)]
    rows += [(2, n, n, None, n == 4) for n in (1, 2, 4, 5)]  # the third page is missing
    dealt = [(*r, rnd.randrange(PIECES)) for r in rows]
    dealt += [(3, 1, 1, None, False, 0), (3, 1, 1, "9/9", False, 0), (3, 0, 0, None, False, 1)]  # repeated, and below the first
    df = spark.createDataFrame(dealt, ddl + ", piece int")
    got = streams.fed(spark, df, "tapes", lambda s: pages.tapes_stream(s, patience=10_000)).collect()
    known = {(r.document, r.page_num): (r.tape, r.corrected) for r in got}
    want = {(r.document, r.page_num): (r.tape, r.corrected) for r in folds.tapes(spark.createDataFrame(rows, ddl)).collect()}
    assert {k: v for k, v in known.items() if k[0] < 3} == want
    assert len(got) == len(known) and known[3, 1] == ("1/2", False) and known[3, 0] == (None, None)
