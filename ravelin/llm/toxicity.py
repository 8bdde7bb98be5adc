"""Toxicity after noisy-channel deobfuscation.

The channel: a writer may swap letters for look-alikes, repeat them, mask vowels, or put
separators between them. Each suspicious token, or run of single characters, becomes a lattice
of letters, deletions and word boundaries, and Viterbi decoding under a character trigram model
finds the text that was most likely meant. The trigram model counts all words of the whole
input (its alphabet of 28 symbols bounds what is broadcast). The restored words are scored with
a lexicon of weighted words and beginnings of words, learned from a bounded sample of labelled rows: the
logistic curve of their summed weights (of a word, its weightiest feature counts), or the lower confidence
bound of one feature's own rate of toxic texts, if higher. Beginnings, ``PREFIXES`` letters long and written
with a star, stand for words that are inflected or joined in many ways. A doubled letter may be meant, so a
plain word with one is decoded only if some feature would fit it without.

``SAMPLE_LABELS`` bounds that sample: the labelled rows of least id hash that are not held out, each
text of an id once. In the lexicon, near copies count once: support is counted in distinct word sketches.

Defined cases: null or empty text scores as a text without lexicon words, as does every text
where nothing can be learned (score: the rate of toxic labels, 0 without labels); a very long text is
scored whole; equal rows are scored each, rows that share an id each by their own text; equally likely
readings go to the first in the lattice; a null doc_id stays null and counts as not held out; other
columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ravelin.llm.common import crc_mod, discard, free_name, map_arrow, materialize, worker_cache

SAMPLE_LABELS = 12_000
LEAST_SUPPORT = 4
#: Words of least hash that a text is recognised by as a near copy of another.
SKETCH_WORDS = 4
LEAST_RATE = 0.6
#: Letters of the beginnings of longer words that are features too.
PREFIXES = range(5, 9)
THRESHOLD = 0.7
CACHE_TOKENS = 300_000
WORDS_PER_COUNT = 400_000
#: Cost of reading a doubled letter as one.
DOUBLED = 2.0

#: Look-alikes and the letters that they may stand for.
LOOK_ALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t", "|": "il", "€": "e", "£": "l", "*": "aeiou", "#": "aeiou"}
SEPARATORS = " .-_*~,'`/\\"

find_words = re.compile(r"[^\W\d_]+").findall
_plain = re.compile(r"[^\W\d_]+").fullmatch
_tripled = re.compile(r"([^\W\d_])\1\1").search
_letter = re.compile(r"[^\W\d_]").search
_edges = re.compile(r"^(?:(\W)\1\1+|!(?!\w)|[^\w@$+|€£!])+|(?:([^\w])\2\2+|[^\w@$+|€£])+$")
_spaced = re.compile(r"(?<![^\W_])(?:[^\W_@$!][ .\-_*~]{1,3}|[@$!][ .\-_*~]{1,3}){2,}(?:[^\W_]|[@$!](?!\w))(?![^\W_])")
_runs = re.compile(r"([^\W\d_])\1+")


def collapsed(word: str) -> str:
    return _runs.sub(r"\1", word)


def features(word: str) -> list[str]:
    """The word and its beginnings."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]


def symbol(c: str) -> int:
    """0 is the word boundary, 1 to 26 are a to z, 27 any other letter."""
    return ord(c) - 96 if "a" <= c <= "z" else 27


def trigram_counts(batches):
    """Map side: character trigrams of all words of one task's rows."""
    total = np.zeros(28**3, np.int64)
    words: Counter = Counter()

    def flush():
        for word, n in words.items():
            a = b = 0
            for c in [*map(symbol, word), 0]:
                total[(a * 28 + b) * 28 + c] += n
                a, b = b, c
        words.clear()

    for batch in batches:
        for text in batch["text"]:
            words.update(find_words((text.as_py() or "").lower()))
            if len(words) > WORDS_PER_COUNT:
                flush()
    flush()
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["gram", "n"])


def character_model(documents: DataFrame) -> list[float]:
    """Log probabilities of a symbol after two others, interpolated over shorter contexts."""
    counted = map_arrow(documents.select("text"), trigram_counts, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    three = np.zeros((28, 28, 28))
    for r in counted:
        three.reshape(-1)[r["gram"]] = r["n"]
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + 28)
    p2 = (two + 10 * p1) / (two.sum(1, keepdims=True) + 10)
    p3 = (three + 10 * p2) / (three.sum(2, keepdims=True) + 10)
    return np.log(p3).reshape(-1).tolist()


def mixed(logs: list[float], words: Iterable[str], share: float = 0.3) -> list[float]:
    """The model mixed with the trigrams of the features ``words``, as a writer who hides a word meant one of them."""
    three = np.zeros((28, 28, 28))
    for word in words:
        a = b = 0
        for c in [*map(symbol, word.rstrip("*")), *([] if word.endswith("*") else [0])]:
            three[a, b, c] += 1
            a, b = b, c
    total = three.sum(2, keepdims=True)
    own = np.divide(three, total, out=np.zeros_like(three), where=total > 0)
    return np.log((1 - share) * np.exp(np.array(logs).reshape(28, 28, 28)) + share * own).reshape(-1).tolist()


def lattice(noisy: str) -> list[list[tuple[tuple[int, ...], str, float]]]:
    """For each place: (symbols, written letters, cost of the channel); 0 is a boundary."""
    places, i = [], 0
    while i < len(noisy):
        c, n = noisy[i], 1
        while i + n < len(noisy) and noisy[i + n] == c:
            n += 1
        if c.isalpha():
            one = ((symbol(c),), c, (0.0, DOUBLED, 0.5)[min(n, 3) - 1])
            places.append([one] if n == 1 else [one, ((symbol(c),) * 2, c * 2, 0.0 if n == 2 else 0.7)])
        else:
            options = [((symbol(x),), x, 0.4) for x in LOOK_ALIKES.get(c, "")]
            if n > 1:
                options += [((symbol(x),) * 2, x * 2, 0.6) for x in LOOK_ALIKES.get(c, "")]
            if c in SEPARATORS:
                single = (i < 2 or not noisy[i - 2].isalnum()) and (i + n + 1 >= len(noisy) or not noisy[i + n + 1].isalnum())
                options += [((), "", 0.3), ((0,), " ", 3.0 if single else 0.6)]
            elif not options or i == 0 or i + n == len(noisy):
                options.append(((0,), " ", 2.5))
            places.append(options)
        i += n
    return places


def decode(noisy: str, logs: list[float]) -> str:
    """The likeliest text; states are the last two symbols."""
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for options in lattice(noisy):
        ahead: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in best.items():
            for symbols, written, channel in options:
                x, y, now = a, b, cost + channel
                for s in symbols:
                    if s or y:
                        now -= logs[(x * 28 + y) * 28 + s]
                    x, y = (y, s) if s else (0, 0)
                if (x, y) not in ahead or now < ahead[x, y][0]:
                    ahead[x, y] = (now, (path, written))
        best = ahead
    _, path = min(((cost - (logs[(a * 28 + b) * 28] if b else 0.0), path) for (a, b), (cost, path) in best.items()), key=lambda x: x[0])
    written = []
    while path:
        path, x = path
        written.append(x)
    return "".join(reversed(written))


class Restorer:
    """Restored words of tokens; a worker keeps a bounded number of tokens it has seen."""

    def __init__(self, logs: list[float]) -> None:
        self.logs = logs
        self.seen: dict[str, tuple[str, ...]] = {}

    def token(self, token: str) -> tuple[str, ...]:
        core = _edges.sub("", token)
        if _plain(core) and not _tripled(core):
            return (core,)
        if not _letter(core):
            return ()
        plain = find_words(core)
        if not _tripled(core) and all(not c.isdigit() and c not in LOOK_ALIKES and c not in SEPARATORS for c in core if not c.isalpha()):
            return tuple(plain)
        return tuple(dict.fromkeys([*plain, *decode(core, self.logs).split()]))

    def words(self, text: str | None) -> set[str]:
        """Distinct restored words of a whole text, besides those that it plainly has."""
        if not text:
            return set()
        text, seen, out = text.lower(), self.seen, set()
        for t in set(text.split()):
            if (found := seen.get(t)) is None:
                found = self.token(t)
                if len(seen) < CACHE_TOKENS and len(t) <= 40:
                    seen[t] = found
            out.update(found)
        for m in _spaced.finditer(text):
            out.update(decode(m[0], self.logs).split())
        return out


@dataclass
class Model:
    logs: list[float]
    weights: dict[str, float]
    rates: dict[str, float]
    slope: float
    offset: float


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by damped Newton steps with a weak prior."""
    slope, offset = 1.0, -2.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([np.dot(p - y, x) + 0.01 * (slope - 1), np.sum(p - y)])
        h = np.array([[np.dot(w, x * x) + 0.01, np.dot(w, x)], [np.dot(w, x), w.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        slope, offset = max(0.05, slope - step[0]), offset - step[1]
    return float(slope), float(offset)


def feature_rows(rows: DataFrame, wanted: set[str] | None = None) -> DataFrame:
    """(feature, sketch) of the restored words of ``rows``, of the ``wanted`` features only if given."""

    def run(batches):
        for batch in batches:
            found = [(f, s) for words, s in zip(batch["words"].to_pylist(), batch["sketch"].to_pylist(), strict=True) for f in {f for w in words for f in features(w)} if wanted is None or f in wanted]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found], pa.string()), pa.array([s for _, s in found], pa.int64())], names=["feature", "sketch"])

    return map_arrow(rows.select("words", "sketch"), run, "feature string, sketch long")


def labelled_words(documents: DataFrame, labels: DataFrame, trained_on: Column, logs: list[float], sample: int) -> DataFrame:
    """(toxic, sketch, words) of at most ``sample`` labelled rows; written."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & trained_on)
    chosen = known.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)

    def restored(batches):
        words = Restorer(logs).words
        for batch in batches:
            found = [sorted(words(t.as_py())) for t in batch["text"]]
            sketch = [zlib.crc32(b"".join(x.to_bytes(4) for x in heapq.nsmallest(SKETCH_WORDS, (zlib.crc32(w.encode()) for w in f)))) for f in found]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["h"], batch["toxic"], pa.array(sketch, pa.int64()), pa.array(found, pa.list_(pa.string()))], names=["doc_id", "h", "toxic", "sketch", "words"])

    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", F.xxhash64("text").alias("h"), "toxic", "text")
    held = map_arrow(rows, restored, "doc_id long, h long, toxic int, sketch long, words array<string>").dropDuplicates(["doc_id", "h", "toxic"])
    held = materialize(held, "toxicity-sample")
    if held.count() > sample:  # several texts of one id
        fewer = materialize(held.orderBy(F.xxhash64("doc_id"), "doc_id", "h", "toxic").limit(sample), "toxicity-sample")
        discard(held)
        held = fewer
    return held


def fit(documents: DataFrame, labels: DataFrame, trained_on: Column, sample: int = SAMPLE_LABELS) -> Model:
    """Learn from at most ``sample`` labelled rows where ``trained_on`` holds."""
    logs = character_model(documents)
    rows = labelled_words(documents, labels, trained_on, logs, sample)
    of = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count_distinct("sketch").alias("n")).collect()}
    bad, good = of.get(1, 0), of.get(0, 0)
    support = lambda kind, wanted=None: feature_rows(rows.where(F.col("toxic") == kind), wanted).groupBy("feature").agg(F.count_distinct("sketch").alias("n"))
    in_bad = {r["feature"]: r["n"] for r in support(1).where(F.col("n") >= LEAST_SUPPORT).collect()}  # bounded by the sample
    in_good = {r["feature"]: r["n"] for r in support(0, set(in_bad)).collect()} if in_bad else {}
    weights, rates = {}, {}
    for f, k in in_bad.items():
        m = k + in_good.get(f, 0)
        rate = (k + 2) / (m + 4) - 1.64 * math.sqrt((k + 2) / (m + 4) * (m - k + 2) / (m + 4) / (m + 4))
        if 2 * k > m and rate >= LEAST_RATE:
            rates[f] = rate
            weights[f] = math.log((k + 0.5) / (m - k + 0.5)) - math.log((bad + 1) / (good + 1))

    def summed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array([total_weight(words, weights) for words in batch["words"].to_pylist()], pa.float64())], names=["toxic", "x"])

    logs = mixed(logs, weights)
    seen = map_arrow(rows.select("toxic", "words"), summed, "toxic int, x double").collect()  # at most ``sample``
    discard(rows)
    x = np.array([r["x"] for r in seen])
    y = np.array([float(r["toxic"] == 1) for r in seen])
    if not len(y) or not weights:
        rate = float(y.mean()) if len(y) else 0.0
        return Model(logs, {}, {}, 1.0, math.log(rate / (1 - rate)) if 0 < rate < 1 else (-40.0 if rate == 0 else 40.0))
    return Model(logs, weights, rates, *calibrate(x, y))


def weightiest(word: str, weights: dict[str, float]) -> str | None:
    """The feature of the word with the largest weight, the longest of equals."""
    return max((f for f in features(word) if f in weights), key=lambda f: (weights[f], len(f)), default=None)


def total_weight(words: Iterable[str], weights: dict[str, float]) -> float:
    found = {weightiest(w, weights) for w in words} - {None}
    return sum(weights[f] for f in sorted(found))


class Scorer:
    def __init__(self, model: Model) -> None:
        self.restore, self.model, self.hits = Restorer(model.logs), model, {}
        # a feature of a word has its first letters, as many as the shortest beginnings have
        first = PREFIXES[0]
        self.begun = {f.rstrip("*")[:first] for f in model.weights}
        self.without_doubles = {collapsed(f) for f in model.weights}
        self.begun_without = {f.rstrip("*")[:first] for f in self.without_doubles}

    def feature(self, word: str) -> str | None:
        return weightiest(word, self.model.weights) if word[: PREFIXES[0]] in self.begun else None

    def token(self, token: str) -> tuple[str, ...]:
        """The features that count of a token."""
        words = self.restore.token(token)
        found = [f for w in words if (f := self.feature(w))]
        if not found and words and _runs.search(token):
            single = (collapsed(w) for w in words)
            if any(f in self.without_doubles for w in single if w[: PREFIXES[0]] in self.begun_without for f in features(w)):
                found = [f for w in decode(_edges.sub("", token), self.model.logs).split() if (f := self.feature(w))]
        return tuple(dict.fromkeys(found))

    def __call__(self, text: str | None) -> float:
        found: set[str] = set()
        weights, hits = self.model.weights, self.hits
        if text:
            text = text.lower()
            for t in set(text.split()):
                if (h := hits.get(t)) is None:
                    h = self.token(t)
                    if len(hits) < CACHE_TOKENS and len(t) <= 40:
                        hits[t] = h
                if h:
                    found.update(h)
            for m in _spaced.finditer(text):
                found.update(f for w in decode(m[0], self.model.logs).split() if (f := self.feature(w)))
        z = self.model.slope * sum(weights[f] for f in sorted(found)) + self.model.offset
        return max([1 / (1 + math.exp(-max(-40.0, min(40.0, z)))), *(self.model.rates[f] for f in found)])


def add_scores(documents: DataFrame, model: Model, keep: list[str], score_name: str = "score") -> DataFrame:
    """``keep`` columns of ``documents``, then the score from 0 to 1 under the given name."""
    shared, key, at = documents.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex, len(keep)

    def run(batches):
        scorers = worker_cache("toxicity")
        if key not in scorers:
            scorers.clear()
            scorers[key] = Scorer(shared.value)
        score = scorers[key]
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array([score(t.as_py()) for t in batch.column(at)], pa.float64())], names=[*keep, score_name])

    kept = documents.select(*keep, F.col("text").alias(free_name(documents, "scored")))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:at])
    return map_arrow(kept, run, f"{types}, `{score_name}` double")


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, held_out: int = 1, divisor: int = 3) -> DataFrame:
    """Scores for every row, learned from labels of the rows that are not held out."""
    held = crc_mod("doc_id", divisor) == held_out
    docs = documents.select(F.col("doc_id").cast("long"), "text")
    model = fit(docs, labels, ~held)
    scored = add_scores(docs.withColumn("held_out", held), model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows that score below ``threshold``; all their columns. Learns from labels of these rows."""
    model = fit(documents.select(F.col("doc_id").cast("long"), "text"), labels, F.lit(True))
    names, score = documents.columns, free_name(documents, "toxicity")
    return add_scores(documents, model, names, score).where(F.col(score) < threshold).select(*names)
