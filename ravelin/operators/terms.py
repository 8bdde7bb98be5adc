"""Words and bigrams of texts with their counts.

A task counts a block of texts at a time: its words become numbers, bigrams pairs of numbers, and a term of the block is one row,
whatever texts it is in. Rows of a term are then added up by Spark. A document is a row as long as its doc_id occurs once; words of
the others are told apart by doc_id, and rows without one are no document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ravelin.shipping import ship

#: Bytes of the texts that are counted at once; a longer text is counted by itself.
BLOCK = 1 << 22
#: Characters beyond ASCII whose small letter is one of a to z in SQL.
SMALL = {"\u0130": "i", "\u212a": "k"}
COUNTED = "term string, n long, n_docs long"
#: Bits of the table that tells most bigrams that nobody asks for from those that are asked for, and bits in a row of it.
TABLE, TABLE_ROW = 1 << 25, 1 << 15


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.regexp_extract_all(F.lower(F.translate(text, "".join(SMALL), "".join(SMALL.values()))), F.lit("[a-z]+"), F.lit(0))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, one behind the other, and where each begins and the last ends."""
    column = texts.cast(pa.large_string()).fill_null("")
    for odd, small in SMALL.items():
        column = pc.replace_substring(column, odd, small)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _numbered(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of the texts; the number of each word as it comes, and the row of its text."""
    small = data | 0x20
    letter = (small >= ord("a")) & (small <= ord("z"))
    before = np.concatenate(([False], letter[:-1]))[: len(letter)]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    first = np.flatnonzero(letter & ~before)
    joined = small[letter]
    bounds = np.append(np.cumsum(letter, dtype=np.int64)[first] - 1, len(joined))
    words = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds.tobytes()), pa.py_buffer(joined.tobytes())).dictionary_encode()
    return words.dictionary, words.indices.to_numpy().astype(np.int64), np.searchsorted(offsets, first, side="right") - 1


def asked_bits(asked: DataFrame) -> np.ndarray:
    """The table of the bigrams of ``asked`` (first, second), as large for few as for many."""
    place = F.pmod(F.crc32(F.col("first").cast("binary")) * 31 + F.crc32(F.col("second").cast("binary")), F.lit(TABLE))
    rows = asked.select(F.floor(place / TABLE_ROW).alias("row"), (place % TABLE_ROW).alias("bit")).groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits"))
    table = np.zeros((TABLE // TABLE_ROW, TABLE_ROW // 8), np.uint8)
    for row, bits in rows.collect():
        table[row] = np.frombuffer(bits, np.uint8)
    return table.ravel()


def _asked(table: np.ndarray, known: pa.Array, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether bigrams of the words' numbers may be asked for."""
    marks = np.array([zlib.crc32(w.encode()) for w in known.to_pylist()], np.int64)
    place = (marks[first] * 31 + marks[second]) % TABLE
    return (table[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def block_counts(data: np.ndarray, offsets: np.ndarray, alone: np.ndarray, words: bool, bigrams: bool, table: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """(term, n, n_docs) of the texts of one block; a word's n_docs are its rows that are ``alone``, a bigram's null. With a ``table`` bigrams that it does not have are left out."""
    known, number, row = _numbered(data, offsets)
    size = max(1, len(known))
    if words:
        counted = alone[row]
        met = np.sort(row[counted] * size + number[counted])
        docs = np.bincount(met[np.diff(met, prepend=-1) > 0] % size, minlength=len(known))
        yield _batch(known, np.bincount(number, minlength=len(known)), pa.array(docs, pa.int64()))
    if bigrams:
        met = row[:-1] == row[1:]
        first, second = number[:-1][met], number[1:][met]
        if table is not None and len(first):
            met = _asked(table, known, first, second)
            first, second = first[met], second[met]
        pairs, n = np.unique(first * size + second, return_counts=True)
        yield _batch(pc.binary_join_element_wise(known.take(pa.array(pairs // size)), known.take(pa.array(pairs % size)), pa.scalar(" ", known.type)), n, pa.nulls(len(n), pa.int64()))


def _batch(terms: pa.Array, n: np.ndarray, docs: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([terms.cast(pa.string()), pa.array(n, pa.int64()), docs], ["term", "n", "n_docs"])


def _blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows (from, to) of at most ``BLOCK`` bytes, or of one text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, side="right")) - 1)
        yield i, j
        i = j


def term_counts(documents: DataFrame, words: bool = True, bigrams: bool = True, asked: DataFrame | None = None) -> DataFrame:
    """(term, n, n_docs) of the words and bigrams of all texts; a bigram's words have a blank between them, and its n_docs are null.

    ``documents`` has doc_id, where words are counted, and text. If there are ``asked`` bigrams (first, second), these are counted and only some of the others.
    """
    spark = documents.sparkSession
    ship(spark)
    table = None if asked is None else spark.sparkContext.broadcast(asked_bits(asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _bytes_of(batch["text"])
            alone = batch["alone"].to_numpy(zero_copy_only=False)
            for i, j in _blocks(offsets):
                yield from block_counts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], alone[i:j], words, bigrams, None if table is None else table.value)

    if not words:
        rows, apart = documents.select("text", F.lit(False).alias("alone")), None
    else:
        rows, apart = _documents(documents)
    counted = rows.mapInArrow(run, COUNTED)
    if apart is not None:
        counted = counted.unionByName(apart)
    return counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _documents(documents: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(text, alone), and (term, n, n_docs) of the documents of several rows, n being 0, if there are any."""
    several = documents.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    if several.isEmpty():
        return documents.select("text", F.col("doc_id").isNotNull().alias("alone")), None
    told = documents.select("doc_id", "text").join(several, "doc_id", "left")
    met = told.where("rows IS NOT NULL").select("doc_id", F.explode(F.array_distinct(words_of(F.col("text")))).alias("term")).distinct()
    apart = met.groupBy("term").agg(F.lit(0).cast("long").alias("n"), F.count("*").alias("n_docs"))
    return told.select("text", (F.col("doc_id").isNotNull() & F.col("rows").isNull()).alias("alone")), apart
