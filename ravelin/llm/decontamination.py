"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are normalised: lower case, runs of anything but letters and digits become one blank, UTF-8.
An item of m bytes has an edit budget of ``share`` * m. A text region within k edits of the item
keeps at least ``m - q + 1 - k q`` of its q-grams, all on diagonals at most k apart. Shared q-grams
are counted in cells of k + 1 diagonals; two neighbouring cells are a band, the bands overlap, and
every such region lies in one band whole. Bands that reach the count are aligned, banded, with
free text ends; those within the budget are leaks.

q is 8, so that a q-gram is one 64-bit number and the index is exact. Two kinds of q-grams would make
the count a square, and are thinned without losing a region. Of those that more than ``HOT_ITEMS`` items
of a block have, an item does without as many as leave half of its count, which is lowered by that
number. Of places of one q-gram in one item that fall within one cell's width, one is kept; as that
may shift a shared q-gram by a cell, such items are counted and aligned over wider bands.

Items are taken from their table ``PASS_BYTES`` of normalised text at a time, which is what the driver
holds and a pass over the texts is sent; a task indexes ``BLOCK_BYTES`` of them at a time.

Items of under ``EXACT_BYTES`` match where they stand verbatim between word boundaries, and those of
under q bytes where they are a whole text.

Defined cases: null or empty texts and items (also those without a letter or digit) match nothing; very
long texts are looked at whole; equal items or rows are reported each; a null doc_id stays null; empty
tables give no rows; of several regions with one item in a text the one with fewest edits is reported,
ties to the first; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.llm.common import free_name, map_arrow

Q = 8
SHARE = 0.1
EXACT_BYTES = 24
#: Bytes of items in one pass over the texts, and in one index of it.
PASS_BYTES, BLOCK_BYTES = 32 << 20, 4 << 20
#: Bytes of texts that a task looks at together, and holds for a pass of several indexes.
TEXT_BYTES, HELD_BYTES = 1 << 20, 16 << 20
#: Items of an index that make a q-gram hot; pairs of places that are counted together; cells that a shared
#: q-gram of thinned places may be away.
HOT_ITEMS, PAIRS, AWAY = 256, 1 << 22, 2

_split = re.compile(r"[\W_]+").sub


def normalised(text: str | None) -> bytes:
    return _split(" ", text.lower()).strip().encode() if text else b""


def budget(m: int, share: float = SHARE) -> int:
    """Edits allowed in an item of m bytes; fewer where the lemma would ask for no q-gram."""
    return 0 if m < EXACT_BYTES else max(0, min(int(share * m), (m - Q) // Q))


def edit_end(item: bytes, text: bytes, most: int, lo: int, hi: int) -> tuple[int, int] | None:
    """Least edits of ``item`` against a part of ``text``, and that part's end, if at most ``most``.

    Only cells on diagonals (text place - item place) lo - most to hi + most are filled.
    """
    big = len(item) + len(text) + 1
    low, width = lo - most, hi - lo + 2 * most + 1
    t = np.full(width + len(item) + 1, -1, np.int16)
    a = max(0, low)
    part = np.frombuffer(text, np.uint8)[a : max(a, low + len(t))]
    t[a - low : a - low + len(part)] = part
    place = low + np.arange(width)
    row = np.where((place >= 0) & (place <= len(text)), 0, big).astype(np.int64)
    steps = np.arange(width)
    for i, c in enumerate(item, 1):
        # cell j of row i is text place i + low + j; its diagonal neighbour has the same j
        ahead = row + (t[i - 1 : i - 1 + width] != c)
        ahead[:-1] = np.minimum(ahead[:-1], row[1:] + 1)
        ahead[(place + i < 0) | (place + i > len(text))] = big
        row = np.minimum.accumulate(ahead - steps) + steps
        if row.min() > most:
            return None
    j = int(row.argmin())
    return (int(row[j]), low + j + len(item)) if row[j] <= most else None


@dataclass
class Index:
    ids: list
    items: list[bytes]
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray
    least: np.ndarray
    width: np.ndarray
    thinned: np.ndarray


def grams_of(raw: bytes) -> np.ndarray:
    n = len(raw) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return np.ndarray((n,), np.dtype("<u8"), np.frombuffer(raw, np.uint8), strides=(1,)).copy()


def _slot(g: np.ndarray) -> np.ndarray:
    return (g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)


def build_index(rows: list[tuple[object, bytes]], share: float = SHARE) -> Index:
    each = [grams_of(x) for _, x in rows]
    k = np.array([budget(len(x), share) for _, x in rows], np.int64)
    m = np.array([len(x) for _, x in rows], np.int64)
    least, width = m - Q + 1 - k * Q, k + 1
    g = np.concatenate(each) if each else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(each)), [len(x) for x in each])
    place = np.concatenate([np.arange(len(x)) for x in each]) if each else np.zeros(0, np.int64)
    order = np.lexsort((place, item, g))
    g, item, place = g[order], item[order], place[order]

    def begins(*columns: np.ndarray) -> np.ndarray:
        """Where the sorted rows begin a new combination of the columns."""
        new = np.ones(len(columns[0]), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        return new

    if len(g):
        gram = np.cumsum(begins(g)) - 1
        n_items = np.bincount(gram, weights=begins(g, item))[gram]
        hot = np.flatnonzero(n_items > HOT_ITEMS)
        hot = hot[np.lexsort((-n_items[hot], item[hot]))]
        rank = np.arange(len(hot)) - np.searchsorted(item[hot], item[hot])
        gone = hot[rank < (least // 2)[item[hot]]]
        least = least - np.bincount(item[gone], minlength=len(least))
        keep = np.ones(len(g), bool)
        keep[gone] = False
        g, item, place = g[keep], item[keep], place[keep]
    one = begins(g, item, place // width[item]) if len(g) else np.zeros(0, bool)
    thinned = np.bincount(item[~one], minlength=len(rows)) > 0 if len(g) else np.zeros(len(rows), bool)
    g, item, place = g[one], item[one], place[one]
    grams, first = np.unique(g, return_index=True)
    seen = np.zeros(1 << 24, bool)
    seen[_slot(grams)] = True
    return Index([i for i, _ in rows], [x for _, x in rows], grams, np.append(first, len(g)), item, place, seen, least, width, thinned)


def cell_counts(at: np.ndarray, i: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Sorted cells (item above, diagonal cell below bit 40) and shared q-grams in each, of hits ``i`` at ``at``."""
    n = index.first[i + 1] - index.first[i]
    ends = np.cumsum(n)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    begin = 0
    while begin < len(i):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        some = slice(begin, end)
        where = np.repeat(index.first[i[some]] - ends[some] + n[some] + done, n[some]) + np.arange(int(ends[end - 1] - done))
        item = index.item[where]
        diagonal = np.repeat(at[some], n[some]) - index.place[where]
        parts.append(np.unique(item * (1 << 40) + (diagonal + (1 << 30)) // index.width[item], return_counts=True))
        begin = end
    if len(parts) < 2:
        return parts[0] if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    cells, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return cells, np.bincount(back, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def between_words(text: bytes, begin: int, end: int) -> bool:
    return (begin == 0 or text[begin - 1] == 32) and (end == len(text) or text[end] == 32)


def find(texts: list[bytes], index: Index) -> list[tuple[int, int, int, int, int, int]]:
    """(text, item, begin, end, edits, shared q-grams) of the best region of each text and item."""
    best: dict[tuple[int, int], tuple] = {}
    for k, x in enumerate(index.items):
        if 0 < len(x) < Q:
            best.update({(d, k): ((0, 0, len(x)), 0) for d, t in enumerate(texts) if t == x})
    joined = b"\0".join(texts)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    g = grams_of(joined)
    at = np.flatnonzero(index.seen[_slot(g)])
    g = g[at]
    i = np.minimum(np.searchsorted(index.grams, g), max(len(index.grams) - 1, 0))
    hit = index.grams[i] == g if len(index.grams) else np.zeros(len(g), bool)
    cells, counts = cell_counts(at[hit], i[hit], index)
    held = np.append(0, np.cumsum(counts))
    item = cells >> 40
    back, ahead = np.where(index.thinned[item], AWAY + 1, 0), np.where(index.thinned[item], AWAY + 1, 1)
    shared_here = held[np.searchsorted(cells, cells + ahead, "right")] - held[np.searchsorted(cells, cells - back, "left")]
    for j in np.flatnonzero(shared_here >= index.least[item]):
        k, shared = int(item[j]), int(shared_here[j])
        w, x = int(index.width[k]), index.items[k]
        lo = (int(cells[j]) & (1 << 40) - 1) * w - (1 << 30)
        hi = lo + 2 * w - 1
        if index.thinned[k]:
            lo, hi = lo - AWAY * w, hi + AWAY * w
        for d in range(int(np.searchsorted(starts, max(lo, 0), "right")) - 1, len(texts)):
            base = int(starts[d])
            if base > hi + len(x):
                break
            text = texts[d]
            low, high = max(lo - base, -len(x)), min(hi - base, len(text))
            if high < low or ((d, k) in best and best[d, k][0][0] == 0):
                continue
            exact = text.find(x, max(0, low), max(0, high) + len(x))
            if len(x) < EXACT_BYTES:
                while exact >= 0 and not between_words(text, exact, exact + len(x)):
                    exact = text.find(x, exact + 1, max(0, high) + len(x))
                if exact < 0:
                    continue
            if exact >= 0:
                found = (0, exact, exact + len(x))
            elif (end := edit_end(x, text, w - 1, low, high)) is None:
                continue
            else:
                behind = edit_end(x[::-1], text[: end[1]][::-1], end[0], 0, 0)
                found = (end[0], end[1] - (behind[1] if behind else len(x)), end[1])
            if (d, k) not in best or found < best[d, k][0]:
                best[d, k] = (found, shared)
    return [(d, k, b, e, edits, shared) for (d, k), ((edits, b, e), shared) in sorted(best.items())]


def item_passes(benchmark: DataFrame, id_column: str) -> Iterator[list[list[tuple[object, bytes]]]]:
    """The items in passes of blocks, both of bounded size; one pass is held at a time."""
    blocks: list[list] = [[]]
    size = whole = 0
    for r in benchmark.select(id_column, "text").where(F.col("text").isNotNull()).toLocalIterator():
        if not (x := normalised(r["text"])):
            continue
        if whole + len(x) > PASS_BYTES and whole:
            yield blocks
            blocks, size, whole = [[]], 0, 0
        if size + len(x) > BLOCK_BYTES and size:
            blocks.append([])
            size = 0
        blocks[-1].append((r[id_column], x))
        size, whole = size + len(x), whole + len(x)
    if whole:
        yield blocks


SCHEMA = "doc_id long, item_id long, begin long, end long, edits int, budget int, shared_qgrams int"


def leaks(documents: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per document and item with a region within the budget; places are normalised bytes."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("budget", pa.int32()), ("shared_qgrams", pa.int32())])
    docs = documents.select(F.col("doc_id").cast("long"), "text")
    spark, found = documents.sparkSession, None
    for blocks in item_passes(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), "item_id"):
        shared = spark.sparkContext.broadcast([sorted(b, key=lambda r: (r[0] is None, r[0], r[1])) for b in blocks])  # at most PASS_BYTES

        def run(batches, shared=shared):
            blocks = shared.value
            only = build_index(blocks[0], share) if len(blocks) == 1 else None

            def looked(ids: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
                cuts, size = [0], 0
                for i, t in enumerate(texts, 1):
                    size += len(t)
                    if size >= TEXT_BYTES or i == len(texts):
                        cuts.append(i)
                        size = 0
                for block in blocks:
                    index = only or build_index(block, share)
                    for a, b in pairwise(cuts):
                        rows = find(texts[a:b], index)
                        columns = list(zip(*[(ids[a + d], index.ids[k], begin, end, edits, int(index.width[k]) - 1, n) for d, k, begin, end, edits, n in rows], strict=True)) or [()] * len(schema)
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

            ids, texts, size, most = [], [], 0, TEXT_BYTES if only else HELD_BYTES
            for batch in batches:
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                    ids.append(doc_id)
                    texts.append(normalised(text.as_py()))
                    size += len(texts[-1])
                    if size >= most:
                        yield from looked(ids, texts)
                        ids, texts, size = [], [], 0
            if ids:
                yield from looked(ids, texts)

        part = map_arrow(docs, run, SCHEMA)
        found = part if found is None else found.union(part)
    return found if found is not None else spark.createDataFrame([], SCHEMA)


def uncontaminated(documents: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """Documents without a leak; all their columns. Each row is judged by its id and text, also where the id is null."""
    row = free_name(documents, "_row")
    named = documents.withColumn(row, F.xxhash64(F.col("doc_id").cast("string"), "text"))
    hit = leaks(named.select(F.col(row).alias("doc_id"), "text"), benchmark, share).select(F.col("doc_id").alias(row)).distinct()
    return named.join(hit, row, "left_anti").drop(row)
