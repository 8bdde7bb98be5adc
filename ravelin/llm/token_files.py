"""Token-id shards: every document compressed alone with one shared zstandard dictionary.

A shard is one binary value:

    magic ``RVTK1`` + 3 zero bytes | 32 bytes SHA-256 of the dictionary | u32 documents |
    per document: i64 doc_id, u8 null flag, u64 end of its frame, u32 ids | frames

The end offsets make the index: any document of a shard is found by binary search and
decompressed alone. A frame holds the ids as little-endian integers, two bytes wide when all of
the vocabulary fits, else four. Shards are written as rows of a Parquet table by Spark's own
committer, in range partitions of ascending doc_id, so they can lie in any store and a lost
executor costs its unfinished part; their number follows the size of the input. The dictionary is kept
beside them in a table of one row, with its hash and the width, so that ``open_token_files`` needs the
folder alone; a reader refuses a dictionary or a shard whose hash differs.

The dictionary is trained on a bounded sample, ``DICTIONARY_DOCS`` documents of least id hash,
their first ``DICTIONARY_IDS`` ids; it only affects sizes, never ids.

Defined cases: a null or empty text is the end id alone; a very long text is one frame; rows with equal doc_id stay next to
each other, ordered by text hash; null doc_ids come first; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ravelin.llm.common import map_arrow, shared_dir
from ravelin.llm.tokens import encoder, vocabulary_path

MAGIC = b"RVTK1\0\0\0"
ENTRY = struct.Struct("<qBQI")
DICTIONARY_DOCS = 2000
DICTIONARY_IDS = 2048
DICTIONARY_BYTES = 64 * 1024
SHARD_BYTES = 4 * 1024 * 1024
#: Bytes of input, as the optimizer knows its size, for one range partition; partitions of an input of unknown size, at most.
PART_BYTES, MOST_PARTS = 32 * 1024 * 1024, 100_000
LEVEL = 3


def train_dictionary(samples: list[bytes], most: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; with too few samples to train one, their raw joined bytes."""
    try:
        return zstandard.train_dictionary(min(most, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:most]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if len(raw) >= 8 else None


def build_shard(entries: list[tuple[int | None, int, bytes]], dictionary_hash: bytes) -> bytes:
    """Entries are (doc_id, number of ids, frame)."""
    index, end = [], 0
    for doc_id, n, frame in entries:
        end += len(frame)
        index.append(ENTRY.pack(doc_id or 0, doc_id is None, end, n))
    return b"".join([MAGIC, dictionary_hash, struct.pack("<I", len(entries)), *index, *(frame for *_, frame in entries)])


class ShardReader:
    """Random access to one shard."""

    def __init__(self, blob: bytes, dictionary: bytes, width: int) -> None:
        if blob[:8] != MAGIC or blob[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError("not a shard of this dictionary")
        self.blob, self.width = blob, width
        (self.n,) = struct.unpack_from("<I", blob, 40)
        self.data = 44 + self.n * ENTRY.size
        found = _dictionary(dictionary)
        self.plain = zstandard.ZstdDecompressor(**({"dict_data": found} if found else {}))

    def entry(self, i: int) -> tuple[int | None, int, int, int]:
        doc_id, null, end, n = ENTRY.unpack_from(self.blob, 44 + i * ENTRY.size)
        begin = ENTRY.unpack_from(self.blob, 44 + (i - 1) * ENTRY.size)[2] if i else 0
        return None if null else doc_id, self.data + begin, self.data + end, n

    def ids(self, i: int) -> tuple[int | None, np.ndarray]:
        doc_id, begin, end, n = self.entry(i)
        raw = self.plain.decompress(self.blob[begin:end], max_output_size=n * self.width)
        return doc_id, np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def find(self, doc_id: int) -> list[np.ndarray]:
        """Ids of all documents with this id, by binary search in the index."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            x = self.entry(mid)[0]
            low, high = (mid + 1, high) if x is None or x < doc_id else (low, mid)
        found = []
        while low < self.n and self.entry(low)[0] == doc_id:
            found.append(self.ids(low)[1])
            low += 1
        return found


class TokenFiles:
    """A written set of shards: ``shards`` (part, shard, n_docs, n_tokens, blob) and its dictionary."""

    def __init__(self, shards: DataFrame, dictionary: bytes, width: int) -> None:
        self.shards, self.dictionary, self.width = shards, dictionary, width

    def document(self, doc_id: int) -> list[np.ndarray]:
        """Ids of all documents with this id; only shards whose range of ids holds it are opened."""
        held = self.shards.where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).select("part", "shard", "blob").orderBy("part", "shard")
        return [ids for r in held.toLocalIterator() for ids in ShardReader(bytes(r["blob"]), self.dictionary, self.width).find(doc_id)]

    def read(self) -> DataFrame:
        """Documents from the shards: doc_id, start, n_tokens, ids_crc32.

        Starts are prefix sums in three levels: in a shard, over the shards of a part, over parts.
        """
        dictionary, width = self.dictionary, self.width
        per_part = self.shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range partition
        part_base = per_part.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_base"))
        within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        bases = self.shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("shard_base")).join(part_base, "part")
        local = map_arrow(self.shards.select("part", "shard", "blob"), _reader(dictionary, width), "part int, shard int, doc_id long, place long, n_tokens long, ids_crc32 long")
        return local.join(bases, ["part", "shard"]).select("doc_id", (F.col("part_base") + F.col("shard_base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def _reader(dictionary: bytes, width: int):
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("doc_id", pa.int64()), ("place", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for part, shard, blob in zip(batch["part"].to_pylist(), batch["shard"].to_pylist(), batch["blob"], strict=True):
                reader, rows, place = ShardReader(blob.as_py(), dictionary, width), [], 0
                for i in range(reader.n):
                    doc_id, ids = reader.ids(i)
                    rows.append((part, shard, doc_id, place, len(ids), zlib.crc32(ids.tobytes())))
                    place += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _encode(path: str, kind: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()
    encode = encoder(path, kind).encode
    return lambda text: np.frombuffer(encode(text) + end, "<u4")


def n_parts(documents: DataFrame) -> int:
    """Range partitions for the size that the optimizer has for the input; those of the session at least."""
    size = int(str(documents._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-size // PART_BYTES), MOST_PARTS))


def open_token_files(spark: SparkSession, path: str) -> TokenFiles:
    """The files below ``path``, with the dictionary that was stored there."""
    r = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(bytes(r["dictionary"])).digest() != bytes(r["hash"]):
        raise ValueError("the stored dictionary is damaged")
    return TokenFiles(spark.read.parquet(f"{path}/shards"), bytes(r["dictionary"]), r["width"])


def write_token_files(documents: DataFrame, tokenizer_path: str | None = None, kind: str = "word", end_id: int = 2, path: str | None = None) -> TokenFiles:
    """Encode ``documents`` (doc_id, text) and write their shards below ``path``; see the module's text."""
    from tokenizers import Tokenizer

    spark: SparkSession = documents.sparkSession
    vocabulary = tokenizer_path or vocabulary_path("word_bpe_49k.json")
    path = path or f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    width = 2 if max(Tokenizer.from_file(vocabulary).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    dtype = f"<u{width}"
    parts = n_parts(documents)
    docs = documents.select(F.col("doc_id").cast("long"), "text")

    def sample(batches):
        ids_of = _encode(vocabulary, kind, end_id)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([ids_of(t.as_py())[:DICTIONARY_IDS].astype(dtype).tobytes() for t in batch["text"]], pa.binary())], names=["ids"])

    chosen = docs.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(DICTIONARY_DOCS)
    raw = train_dictionary([bytes(r["ids"]) for r in map_arrow(chosen.select("text"), sample, "ids binary").collect()])
    digest = hashlib.sha256(raw).digest()
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("blob", pa.binary())])

    def shards(batches):
        ids_of, part, shard, held, size = _encode(vocabulary, kind, end_id), TaskContext.get().partitionId(), 0, [], 0
        found = _dictionary(raw)
        squeeze = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **({"dict_data": found} if found else {}))

        def flush():
            named = [i for i, *_ in held if i is not None] or [None]
            values = (part, shard, len(held), sum(n for _, n, _ in held), named[0], named[-1], build_shard(held, digest))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = ids_of(text.as_py())
                held.append((doc_id, len(ids), squeeze.compress(ids.astype(dtype).tobytes())))
                size += len(held[-1][2])
                if size >= SHARD_BYTES:
                    yield flush()
                    shard, held, size = shard + 1, [], 0
        if held:
            yield flush()

    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = docs.repartitionByRange(parts, *key).sortWithinPartitions(*key)
    map_arrow(ordered, shards, "part int, shard int, n_docs int, n_tokens long, first_id long, last_id long, blob binary").write.parquet(f"{path}/shards")
    spark.createDataFrame([(bytearray(digest), bytearray(raw), width)], "hash binary, dictionary binary, width int").coalesce(1).write.parquet(f"{path}/dictionary")
    return open_token_files(spark, path)
