"""Cases of the reviewer's fourth round."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from ravelin.operators import similar, spelling

PARTS = ["th", "er", "an", "on", "tion", "ou", "he", "nd", "st", "in", "re", "é", "'", "漢"]


def made(rng, least=2, most=6):
    return "".join(rng.choice(PARTS) for _ in range(rng.randint(least, most)))


def nearest_of_all(low, known, keep, least):
    pairs = sorted(((SequenceMatcher(None, w, low).ratio(), w) for w in known), reverse=True)
    return [x for x in pairs if x[0] >= least][:keep]


def test_nearest_words_need_no_sequence_matcher(monkeypatch):
    """Every word whose letters were not too few went to the sequence matcher, and to tables of subsequences by itself."""
    rng = random.Random(4)
    asked, known = {made(rng) for _ in range(25)}, sorted({made(rng) for _ in range(6000)})
    expected = {low: nearest_of_all(low, known, 20, 0.6) for low in asked}
    rng.shuffle(known)
    monkeypatch.setattr(similar, "SequenceMatcher", None)
    near = similar.Nearest([*asked], 20, lambda w: 0.6)
    for k in (0, 1, 500, 2000):
        near.meet(similar.KnownWords(known[k : {0: 1, 1: 500, 500: 2000}.get(k)]))
    assert {low: sorted(best, reverse=True) for low, best in near.best.items()} == expected


def test_few_words_are_met_one_by_one(monkeypatch):
    """Runs of words with much the same letters are told apart as one: few words of a large block are looked at, and few go on to subsequences."""
    rng = random.Random(6)
    asked, known = {made(rng, 4, 6) for _ in range(30)}, [*{made(rng, 3, 6) for _ in range(60000)}]
    near = similar.Nearest([*asked], 20, lambda w: 0.6)
    near.meet(similar.KnownWords(known[:4096]))
    near.meet(similar.KnownWords(known[4096:16384]))
    met, told, count, real = [], [], np.bitwise_count, similar.KnownWords.subsequences
    block = similar.KnownWords(known[16384:])
    monkeypatch.setattr(similar.np, "bitwise_count", lambda x: met.append(x.size) or count(x))
    monkeypatch.setattr(similar.KnownWords, "subsequences", lambda self, asked, whose, at: told.append(len(at)) or real(self, asked, whose, at))
    near.meet(block)
    pairs = len(asked) * len(block.words)
    assert sum(told) < 0.06 * pairs and sum(met) < 0.5 * pairs


@pytest.mark.parametrize("parts", ["abc", "ae", "nt漢é"])
def test_ratio_is_the_sequence_matchers(parts):
    rng = random.Random(5)
    words = ["", *("".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(150)), "ab" * 31, "ba" * 40, "a" * 300, "ab" * 150]
    for a in words:
        for b in words:
            assert not (a or b) or similar.ratio(a, b) == SequenceMatcher(None, a, b).ratio()


def test_letters_beyond_the_bits_and_long_words():
    """Words with more repeats and kinds of letters than there are bits, words of one length only, long words on both sides."""
    rng = random.Random(8)
    wide = lambda n: "".join(chr(rng.choice([97, 98, 0x4E00 + rng.randrange(90), 0x3B1 + rng.randrange(20), 0x1F600 + rng.randrange(9)])) for _ in range(n))
    known = [wide(rng.randint(1, 12)) for _ in range(700)] + ["a" * k for k in (1, 9, 40, 63, 64, 90)] + [wide(k) for k in (62, 63, 64, 65, 200)] + ["ab" * 100]
    known += [w[:-1] + "z" for w in known if len(w) > 60]
    known = [*dict.fromkeys(known)]
    asked = [*dict.fromkeys([wide(rng.randint(1, 12)) for _ in range(60)] + ["a" * k for k in (2, 10, 32, 33, 63, 66)] + [w[1:] for w in known if len(w) > 60])]
    for blocks in ([known], [known[:5], known[5:300], known[300:]]):
        near = similar.Nearest(asked, 7, lambda w: 0.3)
        for block in blocks:
            near.meet(similar.KnownWords(block))
        assert {low: sorted(best, reverse=True) for low, best in near.best.items()} == {low: nearest_of_all(low, known, 7, 0.3) for low in asked}


def test_words_are_counted_once(spark):
    """The counts of all words were made anew for the unknown words, for the known ones and for the last join."""
    made_ = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made_.add(batch.num_rows)
            yield batch

    words = spark.createDataFrame([("roger", 3), ("rover", 2), ("going", 1)], "word string, n long").mapInArrow(counted, "word string, n long")
    pairs = spelling.word_pairs(spark.createDataFrame([("rogr goin",)], "text string"))
    got = spelling.table_suggestions(pairs, words, spark.createDataFrame([], "bigram string, n long")).select("word", F.col("suggestion")).collect()
    assert {tuple(r) for r in got} == {("rogr", "roger"), ("goin", "going")}
    assert made_.value == 3


def test_bigrams_that_are_not_asked_for_are_left_out(spark):
    """All bigrams of all texts were added up for the few that come with a candidate."""
    rng = random.Random(9)
    words = [made(rng).replace("é", "e").replace("漢", "k").replace("'", "") for _ in range(120)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=60)).title() if i % 7 else None) for i in range(150)], "doc_id long, text string")
    every = {r.bigram: r.n for r in spelling.bigram_counts(docs).collect()}
    asked = [tuple(b.split(" ")) for b in rng.sample(sorted(every), 60)] + [("o'neil", "the"), ("zz", "yy"), (words[0], words[0])]
    got = {r.bigram: r.n for r in spelling.bigram_counts(docs, spark.createDataFrame(asked * 2, "first string, second string")).collect()}
    assert got.items() <= every.items() and len(got) < 0.1 * len(every)
    assert {" ".join(b) for b in asked} & every.keys() <= got.keys()
    assert spelling.bigram_counts(docs, spark.createDataFrame([], "first string, second string")).count() == 0
