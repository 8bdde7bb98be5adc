"""The similarity join against all pairs."""

import random
from difflib import SequenceMatcher

from ravelin.operators import similar


def all_pairs(asked, words, keep, short, other):
    out = []
    for low in asked:
        near = sorted(((SequenceMatcher(None, w, low).ratio(), w) for w in words), reverse=True)
        near = [(r, w) for r, w in near if r >= (short if len(low) <= 3 else other)][:keep]
        out += [(low, w, r, SequenceMatcher(None, low, w).ratio()) for r, w in near]
    return sorted(out)


def vocabulary(seed, n):
    rnd = random.Random(seed)
    parts = ["er", "in", "tion", "the", "ou", "x", "zz", "a", "é", "st", "nd", "-", "漢"]
    return {"".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 6))) for _ in range(n)}


def test_nearest_words_equal_all_pairs(spark):
    asked = {*vocabulary(1, 60), "a", "ab", "abc", "q", "stationstationstationstationstation", "erinerinerinerinerinerin" * 3}
    words = {*vocabulary(2, 300), "b", "abd", "acb", "xaxbxc", "stationstationstationstationstatiom", "erinerinerinerinerinerni" * 3}
    for keep in (3, 20):
        got = similar.nearest_words(spark.createDataFrame([(w,) for w in asked], "low string"), spark.createDataFrame([(w,) for w in words], "word string"), keep, 0.5, 0.6)
        assert sorted(map(tuple, got.select("low", "candidate", "ratio", "likeness").collect())) == all_pairs(asked, words, keep, 0.5, 0.6)


def test_pairs_are_met_once_and_are_few(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("etaoinshrdlcumwfgypbvk") for _ in range(rnd.randrange(6, 12)))
    asked, words = {word() for _ in range(100)}, {word() for _ in range(2000)}
    left, known, sizes = similar.indexed(spark.createDataFrame([(w,) for w in asked], "low string"), spark.createDataFrame([(w,) for w in words], "word string"))
    from pyspark.sql import functions as F

    pairs = similar.candidate_pairs(left, known, sizes, lambda n: F.lit(0.8)).collect()
    assert len(pairs) == len({(r.low, r.word) for r in pairs}) and len(pairs) < 0.02 * len(asked) * len(words)
    share = lambda a, b: sum(min(a.count(c), b.count(c)) for c in set(a))
    assert {(r.low, r.word): r.shared for r in pairs} == {(a, b): share(a, b) for a in asked for b in words if 2 * share(a, b) >= 0.8 * (len(a) + len(b)) - 1e-9}


def test_no_words(spark):
    none, some = spark.createDataFrame([], "low string"), spark.createDataFrame([("abc",)], "word string")
    assert similar.nearest_words(none, some, 5, 0.5, 0.6).collect() == []
    assert similar.nearest_words(some.withColumnRenamed("word", "low"), none.withColumnRenamed("low", "word"), 5, 0.5, 0.6).collect() == []
