"""Ranges of a document against the scans over all of it."""

import random

from pyspark.sql import functions as F

from ravelin.operators import folds, ranges
from ravelin.operators.folds import repaired, tape_step


def stamp(s):
    return f"{s // 86400:02} {s // 3600 % 24:02} {s // 60 % 60:02} {s % 60:02}"


def test_bound_of_a_range():
    rnd = random.Random(1)
    for _ in range(300):
        base = rnd.choice([0, 86400 * 2 + 5000, 86390])
        times = [base + rnd.choice([rnd.randrange(200), rnd.randrange(8000), rnd.randrange(90_000)]) for _ in range(rnd.randrange(1, 8))]
        bound = ranges.bound_of(times)
        for start in {*(bound + d for d in range(-3, 4)), *(rnd.randrange(base + 100_000) for _ in range(20))}:
            last, met = start, False
            for now in times:
                met, last = met or last < now, repaired(now, last)
            assert met == (start <= bound)


def test_function_of_a_run_of_pages():
    rnd = random.Random(2)
    for _ in range(1500):
        label = lambda: rnd.choice([None, "x", f"{rnd.randrange(1, 5)}/{rnd.randrange(4)}", f"{rnd.randrange(1, 5)}/{rnd.randrange(4)}", f"{rnd.randrange(9, 13)}/{rnd.randrange(3)}"])
        steps = [(rnd.random() < 0.25, label()) for _ in range(rnd.randrange(1, 12))]
        function = ranges.TapeFunction()
        for step in steps:
            function.step(*step)
        rows = sorted(function.rows(), key=lambda r: 2 if r["x"] is None else r["y"] is None)
        for start in ((x, y) for x in range(14) for y in range(5)):
            state, machine = start, ranges.TapeStarts()
            machine.state = start
            for step in steps:
                state = tape_step(*state, *step)[:2]
            for row in rows:
                machine.push({**row, "document": 1, "range": 0})
            assert machine.next == state


def test_rising_times_of_a_document_in_many_tasks(spark):
    rnd = random.Random(3)
    rows, at = [], 90_000
    for i in range(1800):
        at += rnd.choice([5, 30, 30, 40, -50, -4000])
        far = 86_400 * 40 if i in (700, 1200) else 0  # a time misread as far too late holds up all ranges behind it
        rows.append((1, i // 6, i % 6, rnd.choice(["comm", "comm", "meta"]), stamp(at + far) if rnd.random() < 0.95 else "?"))
    rows += [(d, p, b, "comm", stamp(90_000 + 60 * p - 700 * (b == 1))) for d in range(2, 12) for p in range(5) for b in range(4)]
    df = spark.createDataFrame(rows, "document long, page_num long, block_idx long, type string, timestamp_clean string")
    got = ranges.monotonic(df, ranges=8)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, folds.monotonic(df).collect()))
    dealt = ranges.in_ranges(df, ["page_num", "block_idx"], "dealt", 8).where("document = 1").groupBy("range").count().collect()
    assert len(dealt) >= 7 and max(r["count"] for r in dealt) < 0.3 * len(rows)
    assert ranges.monotonic(df.limit(0)).collect() == []


def test_tapes_of_a_document_in_many_tasks(spark):
    rnd = random.Random(4)
    rows, x, y = [], 1, 1
    for i in range(900):
        ends = rnd.random() < 0.1
        y += 1
        told = rnd.choice([None, f"{x}/{y}", f"{x}/{y}", f"{x + 1}/{y}", f"{rnd.randrange(99)}/{rnd.randrange(9)}", "x"])
        rows.append((1, i, i - 5, told, ends))
        x, y = (x + 1, 0) if ends else (x, y)
    rows += [(2, n, n, None, n == 4) for n in range(1, 60)] + [(3, n, n - 40, None, n % 3 == 0) for n in range(60)] + [(4, n, -n, "3/4", None) for n in range(9)]
    df = spark.createDataFrame(rows, "document long, page_num long, page long, ocr_tape string, end_of_tape boolean")
    assert sorted(map(str, map(tuple, ranges.tapes(df, 8).collect()))) == sorted(map(str, map(tuple, folds.tapes(df).collect())))
    assert ranges.tapes(df.where(F.lit(False))).collect() == []
