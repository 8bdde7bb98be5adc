"""Exact removal of long byte strings that occur more than once, by run-length compressed suffix indexes.

One suffix array of the whole corpus would move every suffix through a shuffle. Instead all strings of ``LONG`` bytes are
dealt out so that equal ones meet, as far as they can be equal at all:

1. *Anchors.* The anchor of a string of ``LONG`` bytes is that of its ``GRAM``-byte grams with the least hash; equal
   strings have equal anchors. Neighbouring starts with one anchor make a *segment*, with the bytes that its strings
   cover. Segments whose anchor occurs once in the corpus hold nothing that repeats, and most go here: of a segment this
   step moves its anchor, a digest and its place, no text.
2. *Equal segments* are counted by anchor and digest. All starts of a segment that occurs twice are repeated; one of
   each goes on, with its bytes.
3. *Index.* The different segments of an anchor get one run-length compressed index (``run_index``), from which matching
   statistics of ``LONG`` bytes or more are streamed; many anchors share an index of bounded size.
4. An anchor with more than ``MOST`` starts in different segments, as a passage in very many documents has at its edges,
   has no bounded index. Its segments are dealt by digest, in the same pass over the texts, and cut at the finest: each
   string is its own segment, which is one row and one digest, and the equal ones are counted. Nothing is capped.
5. Starts go back to their documents, where the covered bytes are removed.

Marks are shuffled once, by anchor, and texts twice, compressed: to give the bytes of steps 3 and 4, and to lose theirs.

Documents are told apart by doc_id and a hash of the text. Matches never cross documents, but for those strings of
128-bit digests (64 of the anchor and 64 of the segment) that fall together by chance, each decision is exact.

Cases: a null text is empty; texts under ``LONG`` bytes keep all of them; very long texts are read in blocks; rows that
share doc_id or text or both count as documents of their own, as does one without doc_id. An empty table stays empty.
Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ravelin.llm.common import discard, map_arrow, materialize
from ravelin.llm.run_index import repeated_starts, runs_of

#: Bytes of a match; bytes of a gram (a power of two); starts in an anchor's or in a shared index; bytes read at a time; the
#: share of all marks, as 1 in so many, from which an anchor's are not dealt by anchor.
LONG = 200
GRAM = 32
MOST = 200_000
SHARED = 50_000
BLOCK = 1 << 17
LARGEST = 1 << 20
HOT = 1000

#: Odd multipliers of the hashes (any odd numbers do).
MIX, STEP, BASE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
PLACE = np.uint64((1 << 21) - 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each place."""
    h = (data.astype(np.uint64) + np.uint64(1)) * MIX
    h ^= h >> np.uint64(29)
    size = 1
    while size < gram:
        h = h[:-size] * STEP + h[size:]
        h ^= h >> np.uint64(31)
        h *= MIX
        h ^= h >> np.uint64(29)
        size *= 2
    return h


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbouring values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def segments(data: np.ndarray, ends: np.ndarray, long: int = LONG, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Segments of texts that lie one behind the other and end at ``ends``: first start, number of starts, anchor, digest,
    and whether the anchor occurs more than once in it."""
    none = np.zeros(0, np.int64)
    if len(data) < long:
        return none, none, none, none, none.astype(bool)
    hashes = gram_hashes(data, gram)
    place = np.arange(len(hashes), dtype=np.uint64)
    least = least_of(hashes & ~PLACE | place, long - gram + 1) & PLACE
    anchor = hashes[least]
    inside = np.ones(len(anchor) + 1, bool)
    inside[-1] = False
    for end in ends.tolist():
        inside[max(0, end - long + 1) : end] = False
    new = inside[:-1].copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-2]
    first = np.flatnonzero(new)
    stop = np.minimum(np.append(first[1:], len(anchor)), _next_false(inside, first))
    # A text that repeats itself can keep one anchor for long; its segments end after as many starts as others have at most.
    width = long - gram + 1
    parts = -(-(stop - first) // width)
    cut = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first, stop = np.repeat(first, parts) + cut * width, np.repeat(stop, parts)
    count = np.minimum(stop - first, width)
    powers, inverses = _powers(len(hashes))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * powers)))
    digest = (sums[first + count + long - gram] - sums[first]) * inverses[first]
    return first, count, anchor[first].view(np.int64), digest.view(np.int64), least[first] != least[first + count - 1]


def _next_false(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    stops = np.flatnonzero(~flags)
    return stops[np.searchsorted(stops, at)]


_tables: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2**64, kept by the worker for blocks of the usual size."""
    if not _tables or len(_tables[0]) < n:
        size = max(n, 2 * BLOCK)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        _tables[:] = [np.cumprod(np.full(size, b, np.uint64)) for b in (BASE, inverse)]
    return _tables[0][:n], _tables[1][:n]


def texts_of(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, one behind the other, and where each begins and the last ends."""
    column = batch[name].cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _blocks(offsets: np.ndarray, long: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, text ends) of runs of whole texts, about ``BLOCK`` bytes; a longer text is cut at multiples of ``LARGEST``
    bytes from its own beginning, with the bytes of the last strings twice."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, side="right")) - 1)
        begin, end = int(offsets[i]), int(offsets[j])
        if end - begin <= LARGEST:
            yield begin, end, offsets[i + 1 : j + 1] - begin
        else:
            for at in range(begin, end, LARGEST):
                stop = min(at + LARGEST + long - 1, end)
                yield at, stop, np.array([stop - at])
        i = j


MARKS = "anchor bigint, digest bigint, doc bigint, text_hash bigint, start int, n int, again boolean"


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts_of(batch)
        ids = [batch[c].to_numpy(zero_copy_only=False) for c in ("doc", "text_hash")]
        for begin, end, ends in _blocks(offsets, LONG):
            first, count, anchor, digest, again = segments(data[begin:end], ends)
            row = np.searchsorted(offsets, first + begin, side="right") - 1
            columns = [anchor, digest, ids[0][row], ids[1][row], (first + begin - offsets[row]).astype(np.int32), count.astype(np.int32), again]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "digest", "doc", "text_hash", "start", "n", "again"])


PACKED = "doc bigint, text_hash bigint, packed binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstandard frames, which take less of a shuffle; the columns before them stay."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data, offsets = texts_of(batch)
        frames = [press.compress(data[a:b].tobytes()) for a, b in pairwise(offsets.tolist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(frames, pa.binary())], [*batch.schema.names[:-1], "packed"])


PIECES = "anchor bigint, digest bigint, doc bigint, text_hash bigint, start int, seen bigint, large boolean, bytes binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted segments of each text."""
    names, types = ["anchor", "digest", "doc", "text_hash", "start", "seen", "large", "bytes"], [*[pa.int64()] * 4, pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for doc, text_hash, packed, wanted in zip(*(batch[c].to_pylist() for c in ("doc", "text_hash", "packed", "wanted")), strict=True):
            raw = unpress.decompress(packed)
            for w in wanted:
                row = (w["anchor"], w["digest"], doc, text_hash, w["start"], w["seen"], w["large"], raw[w["start"] : w["start"] + w["n"] + LONG - 1])
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)


JUDGED = "doc bigint, text_hash bigint, start int, n int, string binary"


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by anchor and digest to the repeated starts of those seen once, and to every string of the large
    anchors' as a digest; a piece that comes twice is one."""

    def rows(found: list) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(types)], ["doc", "text_hash", "start", "n", "string"])

    def indexed(held: list) -> pa.RecordBatch:
        found = []
        if held:
            for (doc, text_hash, start, seen, raw), hit in zip(held, repeated_starts([h[-1] for h in held], LONG), strict=True):
                if seen == 1:
                    found += [(doc, text_hash, start + a, n, None) for a, n in runs_of(hit)]
        return rows(found)

    held, size, last = [], 0, None
    for batch in batches:
        for anchor, digest, doc, text_hash, start, seen, large, raw in zip(*(batch[c].to_pylist() for c in ("anchor", "digest", "doc", "text_hash", "start", "seen", "large", "bytes")), strict=True):
            if (anchor, digest) == last:
                continue
            if last is not None and anchor != last[0] and size >= SHARED:
                yield indexed(held)
                held, size = [], 0
            last = anchor, digest
            if large:
                yield rows([(doc, text_hash, start + i, 1, hashlib.blake2b(raw[i : i + LONG], digest_size=16).digest()) for i in range(len(raw) - LONG + 1)])
            else:
                held.append((doc, text_hash, start, seen, raw))
                size += len(raw) - LONG + 1
    yield indexed(held)


PLACE_OF = ("doc", "text_hash", "start", "n")


def _kinds(marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments that occur twice (a row each), and one of each of those that an index is for, with seen and large.

    Marks are dealt by anchor once, and windows tell all; those of anchors with a share of ``HOT``, which are ``HOT`` at most,
    lie as they are, and are summed up in part before they move.
    """
    frequent = marks.stat.freqItems(["anchor"], 1 / HOT).first()[0] if not marks.isEmpty() else []
    is_hot = F.col("anchor").isin(list(frequent))
    needs_index = F.expr("least = 1 AND (different > 1 OR alone > 0)")

    of_anchor, of_kind = Window.partitionBy("anchor"), Window.partitionBy("anchor", "digest")
    cold = marks.where(~is_hot).withColumn("times", F.sum(F.when(F.col("again"), 2).otherwise(1)).over(of_anchor)).where("times > 1")
    cold = cold.withColumn("rank", F.row_number().over(of_kind.orderBy("doc", "text_hash", "start"))).withColumn("seen", F.count("*").over(of_kind))
    cold = cold.withColumns({
        "different": F.sum(F.when(F.col("rank") == 1, 1)).over(of_anchor),
        "starts": F.sum(F.when(F.col("rank") == 1, F.col("n"))).over(of_anchor),
        "alone": F.sum(F.when((F.col("seen") == 1) & F.col("again"), 1).otherwise(0)).over(of_anchor),
        "least": F.min("seen").over(of_anchor),
    })
    cold = cold.select("anchor", "digest", *PLACE_OF, "seen", (F.col("starts") > MOST).alias("large"), ((F.col("rank") == 1) & needs_index).alias("wanted"))
    cold = materialize(cold.where("seen > 1 OR wanted"), "segments")

    hot = materialize(marks.where(is_hot), "marks-hot")
    kinds = hot.groupBy("anchor", "digest").agg(F.count("*").alias("seen"), F.max("again").alias("again"), F.min(F.struct(*PLACE_OF)).alias("at"))
    kinds = materialize(kinds.select("anchor", "digest", "seen", "again", "at.*"), "segments-hot")
    groups = kinds.groupBy("anchor").agg(F.count("*").alias("different"), F.sum("n").alias("starts"), F.sum(F.when((F.col("seen") == 1) & F.col("again"), 1).otherwise(0)).alias("alone"), F.min("seen").alias("least"))
    groups = groups.where(needs_index).select("anchor", (F.col("starts") > MOST).alias("large"))

    twice = cold.where("seen > 1").select(*PLACE_OF).unionByName(hot.join(kinds.where("seen > 1").select("anchor", "digest"), ["anchor", "digest"], "left_semi").select(*PLACE_OF))
    once = cold.where("wanted").drop("wanted").unionByName(kinds.drop("again").join(F.broadcast(groups), "anchor"))
    return twice, once


def repeats(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, start, n): runs of starts of strings of ``LONG`` bytes that start elsewhere, too.

    ``docs`` has doc, text_hash and text; rows alike in doc and text_hash share their runs.
    """
    long = docs.where(F.octet_length("text") >= LONG).select("doc", "text_hash", "text")
    marks = materialize(map_arrow(long, _marks, MARKS), "marks")
    twice, once = _kinds(marks)
    discard(marks)

    wanted = once.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("anchor", "digest", "start", "n", "seen", "large")).alias("wanted"))
    pieces = map_arrow(map_arrow(long, _packed, PACKED).join(wanted, ["doc", "text_hash"]), _pieces, PIECES)
    dealt = pieces.repartition("anchor", F.when(F.col("large"), F.col("digest"))).sortWithinPartitions("anchor", "digest")
    judged = materialize(map_arrow(dealt, _judged, JUDGED), "judged")

    strings = judged.where("string IS NOT NULL")
    found = twice.unionByName(judged.where("string IS NULL").select(*PLACE_OF))
    if not strings.isEmpty():
        often = strings.groupBy("string").agg(F.count("*").alias("seen")).where("seen > 1").select("string")
        found = found.unionByName(strings.join(often, "string").select(*PLACE_OF))
    return found


KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        for doc, packed, starts, counts in zip(*(batch[c].to_pylist() for c in ("doc_id", "packed", "starts", "counts")), strict=True):
            raw = memoryview(unpress.decompress(packed))
            gone = spans = 0
            hashed, at = hashlib.sha256(), 0
            for a, b in covered(starts, counts):
                hashed.update(raw[at:a])
                gone, spans, at = gone + b - a, spans + 1, b
            hashed.update(raw[at:])
            out.append((doc, len(raw), gone, spans, hashed.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate([*[pa.int64()] * 4, pa.string()])], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def covered(starts: list[int] | None, counts: list[int] | None) -> list[tuple[int, int]]:
    """Runs of starts to the maximal runs (from, to) of bytes that their strings cover."""
    out: list[tuple[int, int]] = []
    for a, n in sorted(zip(starts or [], counts or [], strict=True)):
        b = a + n + LONG - 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without_repeats(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 of what is left."""
    docs = documents.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    spans = repeats(docs.select("doc", "text_hash", "text")).groupBy("doc", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    spans = materialize(spans.select("doc", "text_hash", F.col("runs.start").alias("starts"), F.col("runs.n").alias("counts")), "repeats")
    packed = map_arrow(docs.select(F.col("doc_id").cast("long"), "doc", "text_hash", "text"), _packed, f"doc_id bigint, {PACKED}")
    return map_arrow(packed.join(spans, ["doc", "text_hash"], "left").select("doc_id", "packed", "starts", "counts"), _kept, KEPT)
