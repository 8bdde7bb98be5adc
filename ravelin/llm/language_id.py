"""Language identification by word-first backoff.

A known word scores its log frequency in each language; an unknown one falls back to the
character n-grams of ``^word$``, at every place the longest one that was seen, from
``MAX_GRAM`` letters down to one. A text's score is the sum over its words, as a posterior.

The model is fitted on a bounded sample of labelled rows, ``SAMPLE_ROWS`` shared evenly by the languages
and at most ``SAMPLE_PER_LANGUAGE`` of one (one at least), those of least id hash, repeated rows once.
Words seen fewer than ``LEAST_WORD`` times in it, and n-grams fewer than ``LEAST_GRAM``, are left to the
back-off. Only counts above zero are kept, so what is broadcast is bounded by the sample and not by its
product with the number of languages; a worker holds ``CELLS`` scores of words it has seen. Every
row of the table is scored on its whole text.

Defined cases: null text or text without a letter gives ``und`` with score 0, as does a table
without labelled rows; equal totals go to the language first in the alphabet; equal rows are
scored each, rows that share an id each by their own text; a very long text is scored whole; a null
doc_id stays null and counts as not held out; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ravelin.llm.common import crc_mod, free_name, map_arrow, worker_cache

SAMPLE_ROWS, SAMPLE_PER_LANGUAGE = 40_000, 2500
LEAST_WORD, LEAST_GRAM = 3, 2
#: A language's rows are dealt to so many tasks before its sample is taken.
SALTS = 64
MAX_GRAM = 4
SMOOTHING = 0.5
#: Scores (words times languages) that a worker keeps of words it has met, and of each table if it is no larger.
CELLS = 1_600_000
#: Letters; what else it matches is neutral to the score.
find_words = re.compile(r"[^\W\d_]+").findall


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Table:
    """Counts of features by language, as one sparse row per feature, and the languages' totals."""

    index: dict[str, int]
    first: np.ndarray
    language: np.ndarray
    count: np.ndarray
    totals: np.ndarray

    @classmethod
    def of(cls, languages: list[str], rows: list[tuple[str, str, int]]) -> Table:
        """``rows`` are (language, feature, count)."""
        place = {l: i for i, l in enumerate(languages)}
        held = sorted((feature, place[lang], n) for lang, feature, n in rows)
        names = list(dict.fromkeys(f for f, _, _ in held))
        index = {f: i for i, f in enumerate(names)}
        language = np.array([l for _, l, _ in held], np.int32)
        count = np.array([n for *_, n in held], np.float64)
        first = np.searchsorted(np.array([index[f] for f, _, _ in held], np.int64), np.arange(len(names) + 1))
        totals = np.bincount(language, weights=count, minlength=len(languages)) + SMOOTHING * len(names)
        return cls(index, first, language, count, totals)

    def dense(self, cells: int) -> np.ndarray | None:
        """``logs`` of all features as one array, if it has at most that many cells."""
        n = len(self.totals)
        if len(self.index) * n > cells:
            return None
        found = np.full((len(self.index), n), SMOOTHING)
        found[np.repeat(np.arange(len(self.index)), np.diff(self.first)), self.language] += self.count
        found = np.log(found / self.totals)
        return (found - found.mean(1, keepdims=True)).astype(np.float32)

    def logs(self, feature: str) -> np.ndarray | None:
        """Smoothed log frequencies in each language, centred over them; None if it was not seen."""
        if (i := self.index.get(feature)) is None:
            return None
        found = np.full(len(self.totals), SMOOTHING)
        some = slice(self.first[i], self.first[i + 1])
        found[self.language[some]] += self.count[some]
        found = np.log(found / self.totals)
        return found - found.mean()


@dataclass
class Model:
    languages: list[str]
    words: Table
    grams: Table


def count_features(batches):
    """Map side: counts of (kind 0 word or n of n-gram, language, feature) over one task's rows."""
    words: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
            words[lang].update(find_words((text.as_py() or "").lower()))
    for lang, counts in words.items():
        found: list[Counter] = [counts, *(Counter() for _ in range(MAX_GRAM))]
        for word, c in counts.items():
            if any(map(str.isalpha, word)):
                for n in range(1, MAX_GRAM + 1):
                    for g in grams(word, n):
                        found[n][g] += c
        for kind, c in enumerate(found):
            if c:
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(c), pa.int32()), pa.array([lang] * len(c)), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["kind", "lang", "feature", "n"])


def sample_of(rows: DataFrame, most: int) -> DataFrame:
    """(doc_id, lang, text) of a bounded number of rows, those of least id hash in each language."""
    keyed = rows.select("doc_id", "lang", F.xxhash64("text").alias("h"))
    order = [F.xxhash64("doc_id"), "doc_id", "h"]
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("doc_id", "h", F.lit(1)), F.lit(SALTS)))
    dealt = salted.withColumn("k", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("k") <= -(-4 * most // SALTS))
    ranked = dealt.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("k") <= most)
    chosen = ranked.select("doc_id", "lang", "h").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("lang") == F.col("l")) & (F.xxhash64("text") == F.col("h"))
    named = chosen.select(F.col("doc_id").alias("i"), F.col("lang").alias("l"), "h")
    return rows.select("doc_id", "lang", "text").join(F.broadcast(named), same, "left_semi").dropDuplicates(["doc_id", "lang", "text"])


def fit(documents: DataFrame, trained_on: Column, per_language: int = SAMPLE_PER_LANGUAGE, in_all: int = SAMPLE_ROWS) -> Model:
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & trained_on)
    n_languages = rows.select("lang").distinct().count()
    sample = sample_of(rows, max(1, min(per_language, in_all // max(1, n_languages))))
    counted = map_arrow(sample.select("lang", "text"), count_features, "kind int, lang string, feature string, n long").groupBy("kind", "lang", "feature").agg(F.sum("n").alias("n"))
    kept = counted.where(F.col("n") >= F.when(F.col("kind") == 0, LEAST_WORD).otherwise(LEAST_GRAM)).toArrow()
    languages = sorted({*kept["lang"].to_pylist()})
    by_kind: dict[bool, list] = {True: [], False: []}
    for kind, lang, feature, n in zip(*(kept[c].to_pylist() for c in ("kind", "lang", "feature", "n")), strict=True):
        by_kind[kind == 0].append((lang, feature, n))
    return Model(languages, Table.of(languages, by_kind[True]), Table.of(languages, by_kind[False]))


class Scorer:
    """A model with a bounded table of the scores of words that it has met."""

    def __init__(self, model: Model) -> None:
        self.model = model
        n = max(1, len(model.languages))
        self.known: dict[str, int] = {}
        self.rows = np.zeros((max(1, CELLS // n), n), np.float32)
        self.gram, self.whole = (self.looked_up(t) for t in (model.grams, model.words))

    @staticmethod
    def looked_up(table: Table) -> Callable[[str], np.ndarray | None]:
        """``table.logs``, worked out for all features at once where these are few enough."""
        rows, place = table.dense(CELLS), table.index.get
        return table.logs if rows is None else lambda feature: None if (i := place(feature)) is None else rows[i]

    def backed_off(self, word: str) -> np.ndarray:
        marked, total, gram = f"^{word}$", np.zeros(len(self.model.languages), np.float32), self.gram
        for i in range(len(marked)):
            for n in range(min(MAX_GRAM, len(marked) - i), 0, -1):
                if (logs := gram(marked[i : i + n])) is not None:
                    total += logs
                    break
        return total / MAX_GRAM

    def word(self, word: str) -> np.ndarray:
        """Scores of a word by language; none without a letter."""
        if (logs := self.whole(word)) is not None:
            return logs
        return self.backed_off(word) if any(map(str.isalpha, word)) else np.zeros(len(self.model.languages))

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = find_words(text.lower()) if text else []
        if not self.model.languages or not any(any(map(str.isalpha, w)) for w in words):
            return "und", 0.0
        known = self.known
        at = [known.get(w, -1) for w in words]
        total = np.zeros(len(self.model.languages), np.float64)
        if -1 in at:
            for i, w in enumerate(words):
                if at[i] < 0 and (k := known.get(w, -1)) >= 0:
                    at[i] = k
                elif at[i] < 0:
                    row = self.word(w).astype(np.float32)
                    if len(known) < len(self.rows) and len(w) <= 40:
                        known[w] = at[i] = len(known)
                        self.rows[at[i]] = row
                    else:
                        total += row
            at = [i for i in at if i >= 0]
        total += self.rows[at].sum(0, dtype=np.float64) if at else 0
        odds = np.exp(total - total.max())
        best = int(total.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


def add_predictions(documents: DataFrame, model: Model, keep: list[str], pred: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """``keep`` columns of ``documents``, then the predicted language and its posterior under the given names."""
    shared, key, at = documents.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex, len(keep)

    def run(batches):
        scorers = worker_cache("language_id")
        if key not in scorers:
            scorers.clear()
            scorers[key] = Scorer(shared.value)
        score = scorers[key]
        for batch in batches:
            found = [score(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=[*keep, pred, score_name])

    kept = documents.select(*keep, F.col("text").alias(free_name(documents, "scored")))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:at])
    return map_arrow(kept, run, f"{types}, `{pred}` string, `{score_name}` double")


def identify(documents: DataFrame, held_out_divisor: int = 5) -> DataFrame:
    """Predictions for every row, learned from the rows that are not held out."""
    held = crc_mod("doc_id", held_out_divisor) == 0
    docs = documents.select(F.col("doc_id").cast("long"), "text", "lang")
    model = fit(docs, ~held)
    return add_predictions(docs.select("doc_id", "text", held.alias("held_out")), model, ["doc_id", "held_out"])


def accepted(documents: DataFrame, least_score: float = 0.5) -> DataFrame:
    """Rows whose language is known with a posterior of ``least_score``; all their columns."""
    model = fit(documents.select(F.col("doc_id").cast("long"), "text", "lang"), F.lit(True))
    names, pred, score = documents.columns, free_name(documents, "lang_pred"), free_name(documents, "lang_score")
    return add_predictions(documents, model, names, pred, score).where((F.col(pred) != "und") & (F.col(score) >= least_score)).select(*names)
