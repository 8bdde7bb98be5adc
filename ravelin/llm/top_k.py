"""Exact top-k inner products by block-at-a-time pruning.

Vectors become whole numbers, floor(scale * x). Rows lie in document-range blocks of ``BLOCK_ROWS``,
each with its forward index (the vectors, densely) and its largest and smallest value per term
(dimension). For a query, a block's bound is the sum over terms of the larger of the query's weight
times the one or the other. Blocks are taken in descending order of the bound and scored until the
bound is below the k-th score so far; sums are exact, in 64-bit floats below 2^53 and in
Python integers beyond.

Ranges of about ``GROUP_ROWS`` rows are the unit of work, with summed term maxima of their own. Each
query is first scored in its own range, which gives it a k-th score to beat. Its bounds of all other
ranges are then looked up in the ranges' summaries, ``SUMMARY_ROWS`` of them at a time, and it is sent
to those ranges only whose bound reaches that score, ``QUERY_ROWS`` queries together. The k best of
each query's ranges are merged. A query whose bounds say nothing meets every range, block by block.

Scores are signed 64-bit numbers: a sum beyond their range counts, and ranks, as the nearest of them.

Defined cases: null vectors and vectors with null or non-finite parts, also of parts that are no longer
finite when scaled, take no part; shorter vectors, also empty ones, count as padded with zeros; rows
with a null id take no part; rows that repeat a vec_id are candidates of their own, a query leaves out
only its own row; fewer than k candidates give all; ties go to the smaller vec_id; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ravelin.llm.common import map_arrow, materialize

BLOCK_ROWS = 256
GROUP_ROWS = 16_384
QUERY_ROWS = 1024
#: Ranges whose queries go to another range together; so often, at most, a range's blocks are dealt again.
ASKED_RANGES = 64
#: Summaries of ranges that the queries meet at a time.
SUMMARY_ROWS = 256
LEAST, MOST = -(2**63), 2**63 - 1

PACKED = "part int, block int, n int, ids binary, size int, data binary, high binary, low binary"


def pack_blocks(vectors: DataFrame, parts: int, scale: float) -> DataFrame:
    """Blocks of vec_id ranges; values are whole numbers kept as 64-bit floats."""
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("size", pa.int32()), ("data", pa.binary()), ("high", pa.binary()), ("low", pa.binary())])

    def run(batches):
        part, block = TaskContext.get().partitionId(), 0

        def packed(rows):
            size = max(len(v) for _, v in rows)
            data = np.zeros((len(rows), size))
            for r, (_, v) in enumerate(rows):
                data[r, : len(v)] = np.floor(scale * np.asarray(v, np.float64))
            values = (part, block, len(rows), np.array([i for i, _ in rows], np.int64).tobytes(), size, data.tobytes(), data.max(0).tobytes(), data.min(0).tobytes())
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        held = []
        for batch in batches:
            held += zip(batch["vec_id"].to_pylist(), batch["embedding"].to_pylist(), strict=True)
            while len(held) >= BLOCK_ROWS:
                yield packed(held[:BLOCK_ROWS])
                held, block = held[BLOCK_ROWS:], block + 1
        if held:
            yield packed(held)

    tied = vectors.withColumn("_tie", F.monotonically_increasing_id())
    return map_arrow(tied.repartitionByRange(parts, "vec_id", "_tie").sortWithinPartitions("vec_id", "_tie").drop("_tie"), run, PACKED)


def padded(raw: np.ndarray, size: int) -> np.ndarray:
    return np.pad(raw, ((0, 0), (0, size - raw.shape[1]))) if raw.shape[1] < size else raw


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def whole(a: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in a.reshape(-1)], object).reshape(a.shape)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T as signed 64-bit whole numbers would hold it, its range as the limits."""
    found = a @ b.T
    return np.clip(found, LEAST, MOST) if found.dtype == object else found


def upper_bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Summed term maxima: no row between ``low`` and ``high`` scores more; as many rows as queries."""
    zero = 0 if queries.dtype == object else 0.0
    found = np.maximum(queries, zero) @ high.T + np.minimum(queries, zero) @ low.T
    return np.clip(found, LEAST, MOST) if found.dtype == object else found


def is_wide(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> bool:
    """Whether sums may go beyond what 64-bit floats hold exactly."""
    return np.abs(queries).max(initial=1) * max(np.abs(high).max(initial=1), np.abs(low).max(initial=1)) * max(1, queries.shape[1]) >= 2.0**53


def search(queries: np.ndarray, rows: np.ndarray, blocks: list[tuple], k: int, kth: np.ndarray | None = None) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(query place, ids, scores) of the k best of the blocks for each query, of those that reach ``kth``.

    ``rows`` are the queries' own rows as part, block, place; blocks are (part, block, ids, data,
    high, low).
    """
    high, low = np.stack([b[4] for b in blocks]), np.stack([b[5] for b in blocks])
    if is_wide(queries, high, low):
        queries, high, low = map(whole, (queries, high, low))
        blocks = [(*b[:3], whole(b[3]), *b[4:]) for b in blocks]
    bounds = upper_bounds(queries, high, low)
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth = np.full(len(queries), -np.inf, object if queries.dtype == object else float) if kth is None else kth.astype(queries.dtype)
    ids_of: list[list] = [[np.zeros(0, np.int64)] for _ in queries]
    scores_of: list[list] = [[np.zeros(0, queries.dtype)] for _ in queries]
    for step in range(len(blocks)):
        now = order[:, step]
        live = np.flatnonzero(bounds[np.arange(len(queries)), now] >= kth)
        if not len(live):
            break
        for b in np.unique(now[live]):
            asked = live[now[live] == b]
            part, block, ids, data = blocks[b][:4]
            found = products(queries[asked], data)
            for q, scores in zip(asked, found, strict=True):
                keep = scores >= kth[q]
                if rows[q, 0] == part and rows[q, 1] == block:
                    keep[rows[q, 2]] = False
                if not keep.any():
                    continue
                i, s = np.concatenate([*ids_of[q], ids[keep]]), np.concatenate([*scores_of[q], scores[keep]])
                top = best_of(i, s, k)
                ids_of[q], scores_of[q] = [i[top]], [s[top]]
                if len(top) == k:
                    kth[q] = max(kth[q], s[top[-1]])
    return [(q, ids_of[q][0], scores_of[q][0]) for q in range(len(queries))]


ASKED = "q long, asking int, n int, ids binary, rows binary, size int, data binary, least binary"
FOUND = "query_row long, query_id long, vec_id long, score long"


@dataclass
class Asked:
    """Up to ``QUERY_ROWS`` queries of one range; ``rows`` are part, block, place and number."""

    ids: np.ndarray
    rows: np.ndarray
    data: np.ndarray

    @classmethod
    def of(cls, n: int, ids: bytes, rows: bytes, size: int, data: bytes) -> Asked:
        return cls(np.frombuffer(ids, np.int64), np.frombuffer(rows, np.int64).reshape(n, 4), np.frombuffer(data).reshape(n, size))

    def at(self, keep: np.ndarray) -> Asked:
        return Asked(self.ids[keep], self.rows[keep], self.data[keep])

    def packed(self) -> tuple:
        return len(self.ids), self.ids.tobytes(), self.rows.tobytes(), self.data.shape[1], np.ascontiguousarray(self.data).tobytes()


def unpacked_blocks(frame: pd.DataFrame, size: int) -> list[tuple]:
    held = []
    for part, block, n, ids, width, data, high, low in frame[["part", "block", "n", "ids", "size", "data", "high", "low"]].itertuples(index=False, name=None):
        held.append((part, block, np.frombuffer(ids, np.int64), padded(np.frombuffer(data).reshape(n, width), size), *(padded(np.frombuffer(x)[None], size)[0] for x in (high, low))))
    return held


def best_of_range(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best of one range's blocks (``right``) for the queries (``left``) that are sent to it."""
    out: dict[str, list] = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
    if len(left) and len(right):
        size = int(max(left["size"].max(), right["size"].max()))
        held = unpacked_blocks(right, size)
        for n, ids, rows, width, data, least in left[["n", "ids", "rows", "size", "data", "least"]].itertuples(index=False, name=None):
            asked = Asked.of(n, ids, rows, width, data)
            kth = None if least is None else np.array([int(x) if x > LEAST else -np.inf for x in np.frombuffer(least, np.int64)], object)
            for i, found, scores in search(padded(asked.data, size), asked.rows, held, k, kth):
                out["query_row"] += [int(asked.rows[i, 3])] * len(found)
                out["query_id"] += [int(asked.ids[i])] * len(found)
                out["vec_id"] += found.tolist()
                out["score"] += [int(x) for x in scores]
    return pd.DataFrame(out)


def query_chunks(blocks: DataFrame, divisor: int) -> DataFrame:
    """The queries of each part of the blocks, ``QUERY_ROWS`` together."""
    schema = pa.schema([("q", pa.int64()), ("asking", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary()), ("size", pa.int32()), ("data", pa.binary()), ("least", pa.binary())])

    def run(batches):
        held: list[tuple] = []
        task, number = TaskContext.get().partitionId(), 0

        def packed():
            nonlocal number
            size = max(len(v) for *_, v in held)
            first = (task << 40) + number
            asked = Asked(np.array([i for i, *_ in held], np.int64), np.array([(*r, first + j) for j, (_, _, r, _) in enumerate(held)], np.int64), np.stack([np.pad(v, (0, size - len(v))) for *_, v in held]))
            number += len(held)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((first, held[0][1], *asked.packed(), None), schema, strict=True)], schema=schema)

        for batch in batches:
            for r in batch.to_pylist():
                if held and held[0][1] != r["range"]:
                    yield packed()
                    held.clear()
                ids, data = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["data"]).reshape(r["n"], r["size"])
                for i in np.flatnonzero(ids % divisor == 0):
                    held.append((ids[i], r["range"], (r["part"], r["block"], i), data[i]))
                    if len(held) == QUERY_ROWS:
                        yield packed()
                        held.clear()
        if held:
            yield packed()

    return map_arrow(blocks.select("range", "part", "block", "n", "ids", "size", "data"), run, ASKED)


def range_summaries(blocks: DataFrame) -> DataFrame:
    """(range, high, low): term maxima and minima of each range."""

    def summed(frame: pd.DataFrame) -> pd.DataFrame:
        size = max(len(x) // 8 for x in frame["high"])
        most, least = (np.stack([np.pad(v := np.frombuffer(x), (0, size - len(v))) for x in frame[c]]) for c in ("high", "low"))
        return pd.DataFrame({"range": [int(frame["range"].iloc[0])], "high": [most.max(0).tobytes()], "low": [least.min(0).tobytes()]})

    return blocks.select("range", "high", "low").groupBy("range").applyInPandas(summed, "range int, high binary, low binary")


def sent_on(asked: DataFrame, seeds: DataFrame, summaries: DataFrame, ranges: int, k: int) -> DataFrame:
    """Queries with the ranges besides their own whose bound reaches the k-th score they have; ASKED and range."""
    schema = pa.schema([("q", pa.int64()), ("asking", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary()), ("size", pa.int32()), ("data", pa.binary()), ("least", pa.binary()), ("range", pa.int32())])
    kth = seeds.groupBy("query_row").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") >= k).drop("n")
    numbered = asked.select("q", F.explode(F.sequence(F.col("q"), F.col("q") + F.col("n") - 1)).alias("query_row"))
    beaten = numbered.join(kth, "query_row").groupBy("q").agg(F.collect_list(F.struct((F.col("query_row") - F.col("q")).alias("place"), "least")).alias("kth"))  # at most QUERY_ROWS
    tops = summaries.groupBy(F.floor(F.col("range") / SUMMARY_ROWS).cast("int").alias("chunk")).agg(F.collect_list(F.struct("range", "high", "low")).alias("tops"))  # at most SUMMARY_ROWS
    every = F.explode(F.sequence(F.lit(0), F.lit(-(-ranges // SUMMARY_ROWS) - 1)))
    met = asked.drop("least").join(beaten, "q", "left").withColumn("chunk", every).join(tops, "chunk").drop("chunk")

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                mine = Asked.of(r["n"], r["ids"], r["rows"], r["size"], r["data"])
                least = np.full(r["n"], LEAST, np.int64)
                for x in r["kth"] or []:
                    least[x["place"]] = x["least"]
                size = max([r["size"], *(len(t["high"]) // 8 for t in r["tops"])])
                high, low = (np.stack([padded(np.frombuffer(t[c])[None], size)[0] for t in r["tops"]]) for c in ("high", "low"))
                queries = padded(mine.data, size)
                if is_wide(queries, high, low):
                    queries, high, low = map(whole, (queries, high, low))
                bounds = upper_bounds(queries, high, low)
                for j, t in enumerate(r["tops"]):
                    keep = np.flatnonzero(bounds[:, j] >= least)
                    if t["range"] != r["asking"] and len(keep):
                        values = (r["q"], r["asking"], *mine.at(keep).packed(), least[keep].tobytes(), t["range"])
                        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    return map_arrow(met, run, ASKED + ", range int")


def exact_top_k(embeddings: DataFrame, k: int = 20, query_divisor: int = 20, scale: float = 64.0) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose vec_id is divisible by ``query_divisor``."""
    vectors = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < F.lit(float("inf"))))
    )
    ranges = max(1, -(-vectors.count() // GROUP_ROWS))
    packed = materialize(pack_blocks(vectors, ranges, scale), "blocks")
    parts = (packed.agg(F.max("part")).first()[0] or 0) + 1
    blocks = packed.withColumn("range", F.floor(F.col("part") * ranges / parts).cast("int"))
    asked = materialize(query_chunks(blocks, query_divisor), "queries")
    best = lambda left, right: best_of_range(left, right, k)
    own = asked.withColumn("range", F.col("asking")).groupBy("range").cogroup(blocks.groupBy("range")).applyInPandas(best, FOUND)
    if ranges > 1:
        own = materialize(own, "own")
        sent = materialize(sent_on(asked, own, range_summaries(blocks), ranges, k).withColumn("together", F.floor(F.col("asking") / ASKED_RANGES).cast("int")), "sent")
        pairs = sent.select(F.col("range").alias("to"), F.col("together").alias("of")).distinct()
        wanted = blocks.join(pairs, F.col("range") == F.col("to"))
        more = sent.groupBy("range", "together").cogroup(wanted.groupBy("to", "of")).applyInPandas(best, FOUND)
        own = own.union(more)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
