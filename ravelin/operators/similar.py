"""Similarity joins of words: the nearest known words of each asked one by gestalt ratio, and words that share letters.

The nearest words are sought by groups of asked words, each of which meets all known words block by block, a small block first: what
is kept of it is the least that later words have to reach. Pairs are told apart by bounds that are worked out for many at once: lengths,
shared letters of runs of words that have much the same, of the words, and the longest common subsequence. The real ratios are worked
out in order of the last bound, until it falls below the last ratio kept. What a task holds is its group with the candidates kept, and
one block.

Words that share letters go through an index of rare letters. A ratio of r needs so many shared letters: twice their number is at
least r times both lengths. Letters of a word, the second of a kind apart from the first, are put in one order for all words,
rarest first. Words with t letters in common then share their first two common letters within the first ``length - t + 2`` of each,
so an index by both lengths and pairs of those letters finds all of them (by single ones where t is 1, or words are so long that
pairs would be many). A pair of words is taken at the first two of its common letters only, and if it has t of them: each is met once.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ravelin.operators.scans import Row, _arrow
from ravelin.shipping import ship
from ravelin.sources.stored import written

#: Letters that have a place in the order by frequency (others are rarest), and both lengths from which single letters are indexed.
ALPHABET, LONG = 64, 48
#: Letters of a word that has bits for them, known words in a row, in the first block and in the largest, and the most and fewest asked words in a group.
BITS, ROW, FIRST, BLOCK, GROUP, MEET = 63, 4096, 4096, 262144, 16384, 64
#: Known words in a run, pairs that are told apart by subsequences at once, and groups for each core.
RUN, PAIRS, SHARE = 16, 16384, 3
NEAR = "low string, candidate string, ratio double, likeness double"


def letters(word: Column, order: dict[str, int]) -> Column:
    """A word's letters as numbers in the common order, the k-th of a kind told from the others."""
    known = F.create_map(*(F.lit(x) for pair in order.items() for x in pair)) if order else F.lit(None).cast("map<string,int>")
    each = F.transform(F.split(word, ""), lambda c: F.coalesce(F.try_element_at(known, c) if order else F.lit(None).cast("int"), -1 - F.ascii(c)))
    return _numbered(F.array_sort(each))


def _numbered(sorted_: Column) -> Column:
    return F.transform(sorted_, lambda x, i: x.cast("long") * 4096 + (i + 1 - F.array_position(sorted_, x)))


def rarest_first(words: DataFrame) -> dict[str, int]:
    """The most frequent ``ALPHABET`` letters, rarer ones first."""
    counted = words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count().orderBy(F.desc("count"), "c").limit(ALPHABET).collect()
    return {r["c"]: len(counted) - i for i, r in enumerate(counted)}


def needed(ratio: Column, a: Column, b: Column) -> Column:
    """Shared letters without which no ratio is reached."""
    return F.greatest(F.ceil(ratio * (a + b) / 2 - F.lit(1e-9)).cast("int"), F.lit(1))


def _keys(words: DataFrame, lengths: list[int], own: str, ratio_of) -> DataFrame:
    """``words`` (word, letters, n) once for each of the other side's ``lengths`` and each key it has for words so long."""
    n, other = F.col("n"), F.col("other")
    asked = other if own == "known" else n
    t = needed(ratio_of(asked), n, other)
    fits = words.withColumn("other", F.explode(F.array(*(F.lit(x) for x in lengths)))).where(t <= F.least(n, other))
    single = (t == 1) | (n + other > LONG)
    size = F.least(n, n - t + F.when(single, 1).otherwise(2))
    head = F.slice("letters", 1, F.col("size"))
    # With one place more than pairs have; a sequence must not run backwards.
    pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(F.col("size") - 1, F.lit(1))), lambda i: F.transform(F.slice("letters", i + 1, F.greatest(F.col("size") - i, F.lit(0))), lambda y: F.xxhash64(F.element_at("letters", i), y))))
    keys = F.when(single, F.transform(head, lambda x: F.xxhash64(x))).otherwise(pairs)
    return fits.withColumn("size", size).withColumn("key", F.explode(keys)).withColumn("single", single).drop("size")


def candidate_pairs(asked: DataFrame, known: DataFrame, lengths: tuple[list[int], list[int]], ratio_of) -> DataFrame:
    """(low, word, shared, bound): pairs of words with as many shared letters as the ratio needs, each once.

    Both sides have word, letters and n; ``lengths`` are those of both, asked first.
    """
    left = _keys(asked, lengths[1], "asked", ratio_of).select(F.col("word").alias("low"), F.col("letters").alias("left"), F.col("n").alias("a"), F.col("other").alias("b"), "key", "single")
    right = _keys(known, lengths[0], "known", ratio_of).select("word", F.col("letters").alias("right"), F.col("n").alias("b"), F.col("other").alias("a"), "key")
    met = left.join(right, ["a", "b", "key"]).withColumn("common", F.array_intersect("left", "right"))
    first = F.when(F.col("single"), F.xxhash64(F.get("common", F.lit(0)))).otherwise(F.xxhash64(F.get("common", F.lit(0)), F.get("common", F.lit(1))))
    enough = F.size("common") >= needed(ratio_of(F.col("a")), F.col("a"), F.col("b"))
    return met.where(enough & (first == F.col("key"))).select("low", "word", F.size("common").alias("shared"), (2 * F.size("common") / (F.col("a") + F.col("b"))).alias("bound"))


class KnownWords:
    """A block of known words as arrays, by length and letters.

    A word has a bit for each of its letters, the second of a kind apart from the first, as far as the 64 that most words of the block
    have go; the number of others is its ``over``. ``RUN`` words of one length and much the same bits are a run, which has the bits
    of them all. Places without a word fill up the last run of a length.
    """

    def __init__(self, words: list[str]) -> None:
        self.words = words = sorted(words, key=len)
        self.sizes = sizes = np.array([len(w) for w in words], np.int64)
        short = int(np.searchsorted(sizes, BITS, side="right"))
        codes = np.frombuffer("".join(words[:short]).encode("utf-32-le", "surrogatepass"), np.uint32)
        used = np.bincount(codes)
        held = np.flatnonzero(used)
        self.letter, self.absent = {chr(c): i for i, c in enumerate(held)}, len(held)
        numbers = np.zeros(len(used), np.uint8 if len(held) < 256 else np.int32)
        numbers[held] = np.arange(len(held))
        self.places = np.full((short, int(sizes[short - 1]) if short else 0), self.absent, numbers.dtype)
        self.places[np.arange(self.places.shape[1]) < sizes[:short, None]] = numbers[codes]
        bits = self._bits([chr(c) for c in held[np.argsort(-used[held], kind="stable")][:ALPHABET]])
        order = np.lexsort((bits, sizes))
        self.lengths, first, n = np.unique(sizes, return_index=True, return_counts=True)
        runs = -(-n // RUN)
        #: By length its first run; by run its length; by place its word, or -1.
        self.runs = np.append(0, np.cumsum(runs))
        self.length = np.repeat(np.arange(len(n)), runs)
        at = np.repeat(self.runs[:-1] * RUN - first, n) + np.arange(len(words))
        total = int(self.runs[-1]) * RUN
        self.rows, placed, over = np.full(total, -1), np.zeros(total, np.uint64), np.zeros(total, np.int64)
        self.rows[at], placed[at], over[at] = order, bits[order], sizes[order] - np.bitwise_count(bits[order])
        self.bits, self.over = placed.reshape(-1, RUN), over.reshape(-1, RUN)
        self.any, self.most = np.bitwise_or.reduce(self.bits, axis=1), self.over.max(axis=1, initial=0)

    def _bits(self, common: list[str]) -> np.ndarray:
        """The words' bits; those that about half of the words have are the highest, so that words in their order have much the same."""
        n, counts, has = len(self.words), self._counts(common), []
        for i, count in enumerate(counts):
            has += [(np.count_nonzero(count >= k), -k, i) for k in range(1, 1 + int(count.max(initial=0)))]
        bits = np.zeros(n, np.uint64)
        self.bit: dict[str, list[int]] = {c: [] for c in common}
        halves = sorted(sorted(has, reverse=True)[:64], key=lambda x: abs(x[0] - n / 2), reverse=True)
        place = {(i, -k): b for b, (_, k, i) in enumerate(halves)}
        for (i, k), b in sorted(place.items()):
            bits |= (counts[i] >= k).astype(np.uint64) << np.uint64(b)
            self.bit[common[i]].append(1 << b)
        return bits

    def _counts(self, common: list[str]) -> np.ndarray:
        """How often each word has each of the common letters."""
        short, columns = len(self.places), np.ascontiguousarray(self.places.T)
        counts = np.zeros((len(common), len(self.words)), np.uint8)
        for count, letter in zip(counts, common, strict=True):
            for column in columns:
                count[:short] += column == self.letter[letter]
        for i, word in enumerate(self.words[short:], short):
            held = Counter(word)
            counts[:, i] = [min(held[c], 255) for c in common]
        return counts

    def alike(self, low: str, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Words that share as many letters with ``low`` as the ratio ``least`` needs, and how many they share at most."""
        n = len(low)
        need = np.ceil(least * (self.lengths + n) / 2 - 1e-9).astype(np.int64)
        fit = np.flatnonzero(need <= np.minimum(self.lengths, n))
        if not len(fit):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = self.runs[fit[0]], self.runs[fit[-1] + 1]
        own = sum(x for c, k in Counter(low).items() for x in self.bit.get(c, ())[:k])
        over, own = n - own.bit_count(), np.uint64(own)

        def shared(bits: np.ndarray, rest: np.ndarray) -> np.ndarray:
            met = np.bitwise_count(bits & own)
            return met + np.minimum(rest, over) if over else met

        # Without letters beyond the bits no more than 64 are shared.
        need = (need if over else np.minimum(need, 255).astype(np.uint8)).take(self.length[a:b])
        run = np.flatnonzero(shared(self.any[a:b], self.most[a:b]) >= need)
        need, run = need[run], run + a
        met = shared(self.bits.take(run, axis=0), self.over.take(run, axis=0) if over else self.over)
        hit = np.flatnonzero(met >= need[:, None])
        return self.rows.take(run[hit // RUN] * RUN + hit % RUN), met.ravel()[hit].astype(np.int64)

    def subsequences(self, asked: list[str], whose: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Lengths of the longest common subsequences of the words ``at`` and the asked word of each; one bit stands for each of its letters, ``BITS`` at most."""
        kind = np.uint32 if max(map(len, asked)) <= 32 else np.uint64
        table = np.zeros((len(asked), self.absent + 1), kind)
        for row, low in zip(table, asked, strict=True):
            for i, c in enumerate(low):
                if c in self.letter:
                    row[self.letter[c]] |= kind(1 << i)
        table, base = table.ravel(), whose * (self.absent + 1)
        columns = np.ascontiguousarray(self.places.take(at, axis=0)[:, : int(self.sizes[at].max())].T)
        apart, number, met = np.full(len(at), np.iinfo(kind).max, kind), np.empty(len(at), np.intp), np.empty(len(at), kind)
        for column in columns:
            np.add(base, column, out=number)
            np.take(table, number, out=met, mode="clip")
            met &= apart
            apart = (apart + met) | (apart - met)
        return np.bitwise_count(~apart & np.array([(1 << len(low)) - 1 for low in asked], kind)[whose]).astype(np.int64)


def matched(a: str, b: str) -> int:
    """Letters in the blocks that the sequence matcher finds: the longest common one, first in ``a`` and then in ``b``, and those before and behind it."""
    if not a or not b:
        return 0
    size = at = 0
    for i in range(len(a)):
        while i + size < len(a) and a[i : i + size + 1] in b:
            size, at = size + 1, i
    if not size:
        return 0
    j = b.index(a[at : at + size])
    return size + matched(a[:at], b[:j]) + matched(a[at + size :], b[j + size :])


def ratio(a: str, b: str) -> float:
    """The sequence matcher's ratio, without its tables; of long words it is asked itself, as it leaves out their frequent letters."""
    if max(len(a), len(b)) > BITS:
        return SequenceMatcher(None, a, b).ratio()
    return 2.0 * matched(a, b) / (len(a) + len(b))


class Nearest:
    """The best candidates of a group of asked words, over one block of known words after another."""

    def __init__(self, asked: list[str], keep: int, least: Callable[[str], float]) -> None:
        self.keep, self.best, self.floor = keep, {low: [] for low in sorted(asked, key=len)}, {low: least(low) for low in asked}

    def least(self, low: str) -> float:
        """What a ratio has to reach to be kept."""
        best = self.best[low]
        return max(self.floor[low], best[0][0]) if len(best) == self.keep else self.floor[low]

    def meet(self, known: KnownWords) -> None:
        """Words alike by their letters are told apart for many asked words at once."""
        met, pairs = [], 0
        for low in self.best:
            at, shared = known.alike(low, self.least(low))
            if len(at):
                met.append((low, at, shared))
                pairs += len(at)
            if pairs >= PAIRS:
                self._tell(known, met)
                met, pairs = [], 0
        if met:
            self._tell(known, met)

    def _tell(self, known: KnownWords, met: list[tuple[str, np.ndarray, np.ndarray]]) -> None:
        """The ratios by a falling bound, until it is below the last ratio kept.

        The blocks that a ratio adds up are in order in both words, so it counts no more letters than their longest common subsequence has.
        """
        asked, n = [low for low, _, _ in met], np.array([len(low) for low, _, _ in met])
        sizes = np.array([len(at) for _, at, _ in met])
        whose, at, most = np.repeat(np.arange(len(met)), sizes), np.concatenate([x for _, x, _ in met]), np.concatenate([x for _, _, x in met])
        short = np.flatnonzero((n[whose] <= BITS) & (known.sizes[at] <= BITS))
        if len(short):
            most[short] = known.subsequences([low[:BITS] for low in asked], whose[short], at[short])
        bound = 2.0 * most / (known.sizes[at] + n[whose])
        for low, end, size in zip(asked, np.cumsum(sizes), sizes, strict=True):
            best, here, words = self.best[low], bound[end - size : end], at[end - size : end]
            near = np.flatnonzero(here >= self.least(low))
            for i in near[np.argsort(-here[near], kind="stable")]:
                if len(best) == self.keep and here[i] < best[0][0]:
                    break
                word = known.words[words[i]]
                if (r := ratio(word, low)) >= self.floor[low]:
                    (heapq.heappush if len(best) < self.keep else heapq.heappushpop)(best, (r, word))

    def rows(self, low: str) -> list[Row]:
        return [{"low": low, "candidate": c, "ratio": r, "likeness": ratio(low, c)} for r, c in sorted(self.best[low], reverse=True)]


def _sizes(words: DataFrame) -> list[int]:
    return sorted(r[0] for r in words.select("n").distinct().collect())


def indexed(asked: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame, tuple[list[int], list[int]]]:
    """Distinct asked (low) and known (word) words as ``candidate_pairs`` takes them, and the lengths of both."""
    order = rarest_first(words)
    shaped = lambda df, c: df.where(F.length(c) > 0).select(F.col(c).alias("word")).distinct().select("word", letters(F.col("word"), order).alias("letters"), F.length("word").alias("n"))
    left, known = written(shaped(asked, "low"), "asked-words"), written(shaped(words, "word"), "known-words")
    return left, known, (_sizes(left), _sizes(known))


def _rows(words: DataFrame, rows: int) -> DataFrame:
    """(row, words): the one column of ``words`` in about so many rows."""
    column = words.columns[0]
    return words.groupBy(F.pmod(F.xxhash64(column), F.lit(rows)).cast("int").alias("row")).agg(F.collect_list(column).alias("words"))


def nearest_words(asked: DataFrame, words: DataFrame, keep: int, short: float, other: float) -> DataFrame:
    """(low, candidate, ratio, likeness): for each distinct ``low`` the ``keep`` nearest of ``words`` (word), by ratio and then word.

    Ratios count from ``other`` on, for words of three letters and fewer from ``short`` on. ``likeness`` is the ratio the
    other way round. There are as many groups of asked words as keep all cores busy, since each group reads all known words.
    """
    spark = words.sparkSession
    ship(spark)
    schema = _arrow(spark, NEAR)
    left = written(asked.select("low").where(F.length("low") > 0).distinct(), "asked-words")
    right = written(words.select("word").where(F.length("word") > 0).distinct(), "known-words")
    n = left.count()
    n = max(1, math.ceil(n / GROUP), min(math.ceil(n / MEET), SHARE * spark.sparkContext.defaultParallelism))
    groups = _rows(left, n).select(F.col("row").alias("group"), F.lit(0).alias("rank"), "words")
    known = _rows(right, max(1, math.ceil(right.count() / ROW)))
    every = known.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("group"), F.lit(1).alias("rank"), "words")
    least = lambda w: short if len(w) <= 3 else other

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, held, size = None, None, [], FIRST
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["group"] != at:
                    yield from out(now, held)
                    now, at, held, size = Nearest(row["words"] if row["rank"] == 0 else [], keep, least), row["group"], [], FIRST
                if row["rank"]:
                    held += row["words"]
                if len(held) >= size:
                    now.meet(KnownWords(held))
                    held, size = [], min(4 * size, BLOCK)
        yield from out(now, held)

    def out(now: Nearest | None, held: list[str]) -> Iterator[pa.RecordBatch]:
        if now and held:
            now.meet(KnownWords(held))
        asked = list(now.best) if now else []
        for i in range(0, len(asked), MEET):
            if rows := [row for low in asked[i : i + MEET] for row in now.rows(low)]:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return written(groups.unionByName(every).repartitionById(n, "group").sortWithinPartitions("group", "rank").mapInArrow(run, NEAR), "near-words")
