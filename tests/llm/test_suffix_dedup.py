"""The removal of repeats against a count of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ravelin.llm import suffix_dedup
from ravelin.llm.run_index import repeated_starts, runs_of
from ravelin.llm.suffix_dedup import covered, segments, without_repeats

LONG = 200


def counted(strings, least):
    seen = Counter(s[i : i + least] for s in strings for i in range(len(s) - least + 1))
    return [[seen[s[i : i + least]] > 1 for i in range(len(s) - least + 1)] for s in strings]


def brute(rows):
    raw = [(text or "").encode() for _, text, *_ in rows]
    out = []
    for (doc, *_), b, hit in zip(rows, raw, counted(raw, LONG), strict=True):
        gone = bytearray(len(b))
        for i, h in enumerate(hit):
            if h:
                gone[i : i + LONG] = b"\1" * LONG
        spans = sum(g and not before for g, before in zip(gone, b"\0" + gone, strict=False))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, start int, anchor string")
    return sorted((tuple(r) for r in without_repeats(df.repartition(3)).collect()), key=str)


def test_index_equals_counts_of_all_strings():
    rnd = random.Random(1)
    for _ in range(600):
        least, letters = rnd.randrange(1, 8), rnd.choice([b"a", b"ab", b"abc", b"\0a"])
        base = bytes(rnd.choice(letters) for _ in range(40))
        strings = [base[(i := rnd.randrange(30)) : i + least + rnd.randrange(12)] if rnd.random() < 0.5 else bytes(rnd.choice(letters) for _ in range(least + rnd.randrange(15))) for _ in range(rnd.randrange(1, 6))]
        if strings := [s for s in strings if len(s) >= least]:
            assert [h.tolist() for h in repeated_starts(strings, least)] == counted(strings, least)


def test_runs_and_covered_bytes():
    assert runs_of(np.array([True, True, False, True])) == [(0, 2), (3, 1)]
    assert covered([300, 0], [1, 5]) == [(0, 204), (300, 500)]
    assert covered([5, 0], [1, 1]) == [(0, 205)]
    assert covered(None, None) == []


def test_segments_hold_every_start_once_and_equal_strings_share_anchors():
    rnd = random.Random(2)
    text = bytes(rnd.choice(b"abcd ") for _ in range(900))
    data = np.frombuffer(text + b"xy" * 400 + text[300:] + b"z" * 150, np.uint8)
    ends = np.array([900, 1700, 2300, 2450])
    first, count, anchor, digest, _ = segments(data, ends)
    starts = [(i, a) for f, n, a in zip(first.tolist(), count.tolist(), anchor.tolist(), strict=True) for i in range(f, f + n)]
    assert [i for i, _ in starts] == [i for a, b in ((0, 900), (900, 1700), (1700, 2300), (2300, 2450)) for i in range(a, b - LONG + 1)]
    by_string = {}
    for i, a in starts:
        assert by_string.setdefault(data[i : i + LONG].tobytes(), a) == a
    for f, n, d, a in zip(first.tolist(), count.tolist(), digest.tolist(), anchor.tolist(), strict=True):
        assert by_string.setdefault((d, a), data[f : f + n + LONG - 1].tobytes()) == data[f : f + n + LONG - 1].tobytes()


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(13)
    word = lambda: "".join(rnd.choice("abcdefgé漢") for _ in range(rnd.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(90) for _ in range(4)]
    rows = [(i, f"{prose(rnd.randrange(60))} {rnd.choice(passages)} {prose(rnd.randrange(60))}", 1, "x") for i in range(40)]
    rows += [(100 + i, rows[i][1][rnd.randrange(50) :], 1, "x") for i in range(10)]
    rows += [(7, rows[3][1], 1, "x"), (7, rows[3][1], 1, "x"), (None, prose(70), 1, ""), (None, None, 1, ""), (200, "", 1, ""), (201, "short", 1, ""), (202, "short", 1, "")]
    rows += [(300, "a" * 199, 1, ""), (301, "a" * 200, 1, ""), (302, "b" * 250, 1, ""), (303, "line again\n" * 300, 1, ""), (304, "xyz" * 66 + "xy", 1, ""), (305, passages[0][:LONG], 1, ""), (306, "é" * 100, 1, ""), (307, "é" * 99 + "è", 1, "")]
    return rows


def test_removal_equals_counts_of_all_strings(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_anchors_without_a_bounded_index_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MOST", 150)
    assert run(spark, rows) == brute(rows)


def test_very_long_texts_are_read_in_blocks(spark):
    rnd = random.Random(5)
    long = "".join(rnd.choice("abcdefgh \n") for _ in range(1_300_000))
    rows = [(1, long + long[1_048_400:1_048_900], 0, ""), (2, long[1_048_300:1_048_800] + "x", 0, ""), (3, long[:LONG], 0, "")]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_texts_are_read_for_pieces_once_though_anchors_are_large(spark, rows, monkeypatch):
    """Pieces of the anchors without a bounded index were taken from the texts by a second join, which shuffled all texts again."""
    calls, real = [], suffix_dedup.map_arrow
    monkeypatch.setattr(suffix_dedup, "map_arrow", lambda df, work, ddl: calls.append(work.__name__) or real(df, work, ddl))
    monkeypatch.setattr(suffix_dedup, "MOST", 150)
    assert run(spark, rows) == brute(rows)
    assert calls.count("_pieces") == 1


@pytest.mark.parametrize("most", [150, 200_000])
@pytest.mark.parametrize("hot", [2, 20, 5000])
def test_frequent_anchors_give_the_same_where_they_lie(spark, rows, monkeypatch, hot, most):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    assert run(spark, rows) == brute(rows)


def test_texts_move_compressed(spark, rows):
    """The joins by document shuffled the texts themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string, start int, anchor string")
    plan = without_repeats(df)._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    at = plan.splitlines().index(join)
    below = next(line for line in plan.splitlines()[at + 1 :] if "MapInArrow" in line or "Relation" in line or "LogicalRDD" in line)
    assert "packed" in below
