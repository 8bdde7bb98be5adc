"""Spelling by a lexicon: nearest known words, ranked by likeness, length, frequency and the word before.

Texts never meet the lexicon: their distinct (word, word before) pairs do, so the work grows with the
vocabulary of the corpus. A lexicon that is a configuration file is held as one ``Speller``, and the pairs of
one word meet in one task, which looks it up once. Unknown words meet a lexicon that is a table by groups and blocks
(``similar.nearest_words``); counts of words and bigrams are joined.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ravelin.operators import similar, terms
from ravelin.operators.scans import Machine, Row, ordered_scan
from ravelin.shipping import ship
from ravelin.sources.stored import written

#: Candidates, least ratios for short and other words, weights of a candidate's score.
CANDIDATES, SHORT_RATIO, LEAST_RATIO, LIKENESS, LENGTH, BIGRAM = 20, 0.5, 0.6, 10_000, 500, 100
#: Contractions that are right as they are.
CONTRACTIONS = set(
    """i'm i'll i've i'd you're you'll you've you'd he's he'll he'd she's she'll she'd it's it'll we're we'll we've we'd they're they'll they've they'd
    that's there's here's don't can't won't shouldn't wouldn't couldn't wasn't weren't isn't aren't haven't hasn't hadn't""".split()
)


def letter_counts(word: str) -> np.ndarray:
    """Counts of a to z, and of all other characters by two bits of their code."""
    codes = [ord(c) - 97 if "a" <= c <= "z" else 26 + (ord(c) & 3) for c in word]
    return np.bincount(codes, minlength=30).astype(np.int16)


class Speller:
    def __init__(self, frequency: dict[str, int], bigrams: dict[str, int], vocabulary: set[str] | None = None) -> None:
        self.frequency, self.bigrams = frequency, bigrams
        self.known = vocabulary if vocabulary is not None else set(frequency)
        self.words = sorted(self.known)
        self.sizes = np.array([len(w) for w in self.words], np.int16)
        self.letters = np.array([letter_counts(w) for w in self.words], np.int16).reshape(-1, 30)

    def nearest(self, word: str) -> list[tuple[float, str]]:
        """Ratio and word of the nearest known words, best first.

        No ratio exceeds what the shared letters allow; words are tried in order of that bound until
        it is below the least ratio that still counts, so the result is the same as of trying all.
        """
        least = SHORT_RATIO if len(word) <= 3 else LEAST_RATIO
        bound = 2 * np.minimum(self.letters, letter_counts(word)).sum(1) / (self.sizes + len(word))
        near = np.flatnonzero(bound >= least)
        match, best = SequenceMatcher(), []
        match.set_seq2(word)
        for i in near[np.argsort(-bound[near], kind="stable")]:
            if len(best) == CANDIDATES and bound[i] < best[0][0]:
                break
            match.set_seq1(self.words[i])
            if (r := match.ratio()) >= least:
                (heapq.heappush if len(best) < CANDIDATES else heapq.heappushpop)(best, (r, self.words[i]))
        return sorted(best, reverse=True)

    def candidates(self, word: str) -> list[str]:
        return [w for _, w in self.nearest(word)]

    def score(self, word: str, candidate: str, before: str | None) -> float:
        likeness = SequenceMatcher(None, word, candidate).ratio()
        context = self.bigrams.get(f"{before.lower()} {candidate}", 0) if before else 0
        return LIKENESS * likeness - LENGTH * abs(len(word) - len(candidate)) + self.frequency.get(candidate, 0) + BIGRAM * context

    def fitting(self, word: str, short: bool = False, known_short: bool = False) -> list[str]:
        """Candidates of a word that may be wrong; short words are not made shorter.

        ``short`` lets words of one or two letters be wrong, ``known_short`` also known ones.
        """
        low = word.lower()
        known = (low in self.known or low.isdigit()) and not (known_short and len(word) < 3)
        if known or low in CONTRACTIONS or (len(word) < 3 and not short):
            return []
        return [c for c in self.candidates(low) if (len(low) > 3 or len(c) >= len(low)) and not (known_short and len(low) < 3 and c == low)]

    @staticmethod
    def cased(word: str, found: str) -> str:
        return found.title() if word.istitle() else found.upper() if word.isupper() else found

    def suggest(self, word: str, before: str | None = None, fit: list[str] | None = None) -> str | None:
        """A known word in the case of ``word``; None where it is right, too short, or like no known word."""
        low, fit = word.lower(), self.fitting(word) if fit is None else fit
        if not fit:
            return None
        return self.cased(word, max(fit, key=lambda c: self.score(low, c, before)))


#: Fixed value: the least count of a mission's words.
KEYWORD_COUNT = 100


def lexicon_speller(top: dict[str, int], vocabulary: Iterable[str], bigrams: dict[str, int], keywords: Iterable[str] = ()) -> Speller:
    """A speller of a lexicon's three sections; words of the mission's keywords are known, and count at least ``KEYWORD_COUNT``."""
    words = {w.lower() for k in keywords for w in k.split()}
    counts = {**top, **{w: max(top.get(w, 0), KEYWORD_COUNT) for w in words}}
    vocabulary = set(vocabulary)
    return Speller(counts, bigrams, (vocabulary | set(top) if vocabulary else set()) | words)


def word_pairs(texts: DataFrame) -> DataFrame:
    """(word, before, n): distinct words of ``text`` with the word before them (null at the start) and their count."""
    words = texts.select(F.regexp_extract_all("text", F.lit("([A-Za-z']+)"), F.lit(1)).alias("w")).where(F.size("w") > 0)
    pairs = F.transform("w", lambda x, i: F.struct(x.alias("word"), F.when(i > 0, F.get("w", i - 1)).alias("before")))
    return words.select(F.explode(pairs).alias("p")).groupBy("p.word", "p.before").agg(F.count("*").alias("n"))


class OneWord(Machine):
    """The pairs of one word: its candidates are found once."""

    def __init__(self, speller: Speller) -> None:
        self.speller, self.fit = speller, None

    def push(self, row: Row) -> list[Row]:
        if self.fit is None:
            self.fit = self.speller.fitting(row["word"])
        found = self.speller.suggest(row["word"], row["before"], self.fit)
        return [{**row, "suggestion": found}] if found else []


def suggestions(pairs: DataFrame, speller: Speller) -> DataFrame:
    """(word, before, n, suggestion) of the pairs that have one."""
    spark = pairs.sparkSession
    ship(spark)
    shared, tasks = spark.sparkContext.broadcast(speller), int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ordered_scan(pairs.select("word", "before", "n"), ["word"], ["before"], lambda: OneWord(shared.value), "word string, before string, n long, suggestion string", tasks)


def in_case_of(word: Column, found: Column) -> Column:
    """``found`` in the case of ``word``, both of letters and apostrophes."""
    title = F.array_join(F.transform(F.split(found, "'"), lambda x: F.initcap(x)), "'")
    return F.when(word.rlike("^'*[A-Z][a-z]*('+[A-Z][a-z]*)*'*$"), title).when(word.rlike("[A-Z]") & ~word.rlike("[a-z]"), F.upper(found)).otherwise(found)


def table_suggestions(pairs: DataFrame, words: DataFrame, bigrams: DataFrame | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``suggestions`` of a ``Speller`` of all (word, n) and (bigram, n), which no task and no driver holds whole.

    ``bigrams`` may be a function that counts those which are asked for (first, second).
    """
    words = written(words.select("word", "n"), "words")
    rows = written(pairs.select("word", "before", "n", F.lower("word").alias("low")), "pairs")
    asked = rows.where((F.length("low") >= 3) & ~F.col("low").isin(sorted(CONTRACTIONS))).select("low").distinct()
    asked = asked.join(words.select(F.col("word").alias("low")), "low", "left_anti")
    counts = words.select(F.col("word").alias("candidate"), F.col("n").alias("frequency"))
    near = similar.nearest_words(asked, words, CANDIDATES, SHORT_RATIO, LEAST_RATIO).where((F.length("low") > 3) | (F.length("candidate") >= F.length("low")))
    if callable(bigrams):
        bigrams = bigrams(rows.where("before IS NOT NULL").join(near, "low").select(F.lower("before").alias("first"), F.col("candidate").alias("second")))
    each = rows.join(near.join(counts, "candidate"), "low").withColumn("bigram", F.concat_ws(" ", F.lower("before"), "candidate"))
    context = bigrams.select("bigram", F.col("n").alias("context"))
    each = each.join(context, "bigram", "left").withColumn("context", F.when(F.col("before").isNull(), 0).otherwise(F.coalesce("context", F.lit(0))))
    score = LIKENESS * F.col("likeness") - LENGTH * F.abs(F.length("low") - F.length("candidate")) + F.col("frequency") + BIGRAM * F.col("context")
    best = each.groupBy("word", "before").agg(F.max("n").alias("n"), F.max(F.struct(score.alias("score"), "ratio", "candidate")).alias("best"))
    return best.select("word", "before", "n", in_case_of(F.col("word"), F.col("best.candidate")).alias("suggestion"))


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, n, n_docs) of all texts."""
    return terms.term_counts(documents, bigrams=False).withColumnRenamed("term", "word")


def word_totals(documents: DataFrame) -> DataFrame:
    """(word, n) of all texts; each task sends a word once, whatever documents it is in."""
    return documents.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def bigram_counts(documents: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """(bigram, n) of all texts; of the ``asked`` ones (first, second) and some others, if these are given."""
    return terms.term_counts(documents, words=False, asked=asked).select(F.col("term").alias("bigram"), "n")


def with_keywords(counts: DataFrame, keywords: list[str]) -> DataFrame:
    """(word, n) of ``counts`` with all words of the keywords, which count at least ``KEYWORD_COUNT``."""
    words = sorted({w.lower() for k in keywords for w in k.split()})
    floor = counts.sparkSession.createDataFrame([(w, KEYWORD_COUNT) for w in words], "word string, n bigint")
    return counts.select("word", "n").union(floor).groupBy("word").agg(F.max("n").alias("n"))
