"""Best-fit packing of token pieces into sequences by exact-complement hashing.

The planner sees only how many pieces there are of each length (at most ``capacity``
numbers), so its work and memory do not depend on the corpus. It indexes which sums one,
two and three available lengths reach, uses up combinations that fill a sequence exactly
under the counts that are left, and then packs the residual best-fit first. Every pattern
it forms is a multiset of lengths with a multiplicity; pieces get a place from their rank
within their length, which is a count per written partition plus a position in it, so no
length, however common, meets in one task.

Defined cases: a null or empty text is the single end id; a text with ``n`` ids and
``n % capacity = r > 0`` beyond one sequence has a first piece of ``r``; an empty table
gives no rows; equal rows are packed each; a null doc_id stays null; other columns of the
input are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ravelin.llm.common import map_arrow, materialize
from ravelin.llm.tokens import encoder, vocabulary_path

CAPACITY = 2048


class _Stock:
    """Available lengths with the index of sums that one or two of them reach."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.left = [0] * (capacity + 1)
        for length, n in counts.items():
            self.left[length] = n
        self.capacity = capacity
        self.reindex()

    def reindex(self) -> None:
        self.has = np.array([n > 0 for n in self.left])
        bits = sum(1 << i for i, n in enumerate(self.left) if n > 0)
        two = 0
        for i in np.flatnonzero(self.has):
            two |= bits << int(i)
        self.two, self.stale = two, 0

    def take(self, lengths: list[int], times: int) -> None:
        for x in lengths:
            self.left[x] -= times
            if self.left[x] == 0:
                self.has[x] = False
                self.stale += 1
        if self.stale > 32:
            self.reindex()

    def possible(self, lengths: tuple[int, ...]) -> int:
        return min(self.left[x] // k for x, k in Counter(lengths).items())

    def pair(self, gap: int, most: int, also: tuple[int, ...] = ()) -> tuple[int, ...] | None:
        """Two lengths summing to ``gap``, the larger as large as can be and at most ``most``."""
        if gap < 2 or not self.two >> gap & 1:
            return None
        low = (gap + 1) // 2
        window = self.has[low : min(gap - 1, most) + 1]
        other = self.has[gap - low - len(window) + 1 : gap - low + 1][::-1]
        for i in np.flatnonzero(window & other)[::-1]:
            found = (*also, low + int(i), gap - low - int(i))
            if self.possible(found):
                return found
        return None

    def exact(self, gap: int, also: tuple[int, ...] = ()) -> tuple[int, ...] | None:
        """One, two or three lengths that fill ``gap``, besides those in ``also``; with them."""
        if self.left[gap] and self.possible((*also, gap)):
            return (*also, gap)
        if found := self.pair(gap, gap - 1, also):
            return found
        for a in np.flatnonzero(self.has[: max(gap - 1, 0)])[::-1]:
            if 3 * a < gap:
                break
            if found := self.pair(gap - int(a), int(a), (*also, int(a))):
                return found
        return None


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns as (how many sequences, [(length, copies in each)])."""
    stock, plan = _Stock(counts, capacity), []

    def emit(times: int, lengths: tuple[int, ...]) -> None:
        plan.append((times, sorted(Counter(lengths).items(), reverse=True)))

    for length in range(capacity, 0, -1):
        while stock.left[length]:
            if length == capacity:
                found = (length,)
            elif not (found := stock.exact(capacity - length, (length,))):
                break
            times = stock.possible(found)
            emit(times, found)
            stock.take(list(found), times)

    for length in range(capacity, 0, -1):
        if not (n := stock.left[length]):
            continue
        stock.take([length], n)
        full, rest = divmod(n, capacity // length)
        open_ = [(times, {length: copies}, capacity - length * copies) for times, copies in ((full, capacity // length), (1, rest)) if times and copies]
        while open_:
            times, inside, gap = open_.pop()
            found = stock.exact(gap) if gap else None
            if found:
                each = min(times, stock.possible(found))
                stock.take(list(found), each)
                plan.append((each, sorted((Counter(inside) + Counter(found)).items(), reverse=True)))
            else:
                fits = np.flatnonzero(stock.has[: gap + 1])
                if not len(fits):
                    plan.append((times, sorted(inside.items(), reverse=True)))
                    continue
                best = int(fits[-1])
                each = min(times, stock.left[best])
                copies = max(1, min(gap // best, stock.left[best] // each))
                stock.take([best], each * copies)
                open_.append((each, {**inside, best: inside.get(best, 0) + copies}, gap - best * copies))
            if times > each:
                open_.append((times - each, inside, gap))
    return plan


def placement(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """Intervals of ranks within a length, ordered by (length, first rank)."""
    cursor: Counter = Counter()
    rows, first = [], 0
    for times, items in plan:
        offset = 0
        for length, copies in items:
            rows.append((length, cursor[length], first, copies, offset))
            cursor[length] += times * copies
            offset += length * copies
        first += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "sequence", "copies", "offset"), columns, strict=True))


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bucket int, local long"


def token_pieces(documents: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece; ``bucket`` is the task that wrote it, ``local`` its rank there in its length."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("bucket", pa.int32()), ("local", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode, bucket, seen = encoder(tokenizer_path, "byte").encode, TaskContext.get().partitionId(), Counter()
        for batch in batches:
            out = [[] for _ in schema]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = encode(text.as_py()) + end
                n, start, piece = len(ids) // 4, 0, 0
                while start < n:
                    length = n if n <= capacity else (n - start) % capacity or capacity
                    row = (doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), bucket, seen[length])
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    seen[length] += 1
                    start, piece = start + length, piece + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return map_arrow(documents.select(F.col("doc_id").cast("long"), "text"), run, PIECES)


def pack(documents: DataFrame, tokenizer_path: str | None = None, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; see the module's text."""
    path = tokenizer_path or vocabulary_path("byte_bpe_50k.json")
    pieces = materialize(token_pieces(documents, path, end_id, capacity), "pieces")
    per_bucket = pieces.groupBy("bucket", "length").agg(F.count("*").alias("n"))
    lengths = per_bucket.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    at = placement(plan_sequences({r["length"]: r["n"] for r in lengths}, capacity))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = per_bucket.select("bucket", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(base, ["bucket", "length"]).withColumn("rank", F.col("before") + F.col("local"))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
    spread = int(at["rank"].max()) + 1 if len(at["rank"]) else 1

    def place(batches):
        keys = at["length"].astype(object) * spread + at["rank"] if spread > 2**51 else at["length"] * spread + at["rank"]
        for batch in batches:
            length, rank = (batch[c].to_numpy() for c in ("length", "rank"))
            i = np.searchsorted(keys, length * spread + np.minimum(rank, spread - 1), "right") - 1
            step = rank - at["rank"][i]
            sequence = at["sequence"][i] + step // at["copies"][i]
            offset = at["offset"][i] + step % at["copies"][i] * length
            yield pa.RecordBatch.from_arrays([*(batch[f.name] for f in list(schema)[:5]), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], schema=schema)

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return map_arrow(ranked.select(*columns, "rank"), place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
