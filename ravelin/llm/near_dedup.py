"""Near-duplicates: universal-hash minima, banding, signature verification, components.

1. One pass over the texts makes, per row, the set of word shingles (64-bit hashes), its
   fingerprint, the minima of ``bands * rows`` universal hash functions as band keys, and a
   one-byte signature of each minimum. Rows with equal sets form a class; only its least doc_id
   goes on, so exact copies never meet again.
2. Every band bucket links its members to its head, the member with the most neighbours in all its
   buckets (a star, never all pairs). A link is verified on the signatures with a margin of five
   standard errors, then confirmed on full sets.
3. Components by large-star and small-star. Members of a bucket that are not yet connected to its
   head are compared with ``OTHERS`` of its members, and those still apart with the members of
   other components in the bucket, so that no link between different texts is lost; links within a
   component change nothing.

``bands`` and ``rows`` are such that a pair at the threshold shares no band with probability under
1e-6. Numerator and denominator of the threshold are whole numbers, so the confirmation is exact on
sets of 64-bit shingle hashes; two shingles of one pair that differ and have one hash would count as equal.

Defined cases: null text and text without words have an empty set, link with nothing and are kept;
fewer words than a shingle are one shingle of the whole sequence; rows sharing a doc_id count as one
document of that id where their sets are equal, and one row each otherwise; a null doc_id links
with nothing, has component null and is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.llm.common import discard, free_name, map_arrow, materialize, worker_cache
from ravelin.llm.components import connected_components

CACHE_WORDS = 150_000
#: Ids of documents to confirm that are broadcast at most; more are joined by a shuffle of the texts.
BROADCAST_NODES = 1_000_000
#: Strays, and members, of a bucket that meet in one task.
UNIT_ROWS = 2048
#: Classes of copies with more than this share of all rows are named by a broadcast of at most its inverse rows.
HOT_SHARE = 0.001
#: Members of a bucket, besides its head, that those not linked to the head are compared with first.
OTHERS = 4
_U = np.uint64


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    similar: tuple[int, int] = (80, 100)
    bands: int = 42
    rows: int = 6

    @property
    def least(self) -> float:
        return self.similar[0] / self.similar[1]

    @property
    def margin(self) -> float:
        """Least share of equal one-byte signatures that a pair at the threshold has, all but surely."""
        n, p = self.bands * self.rows, self.least + (1 - self.least) / 256
        return p - 5 * math.sqrt(p * (1 - p) / n)


def _odd(seed: int, n: int) -> np.ndarray:
    """Fixed odd 64-bit multipliers."""
    return np.array([xxhash.xxh3_64_intdigest(b"%d/%d" % (seed, i)) | 1 for i in range(n)], _U)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    return x ^ (x >> _U(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    known = worker_cache("near_dedup")
    found = list(map(known.get, words))
    if None in found:
        for i, h in enumerate(found):
            if h is None:
                found[i] = h = xxhash.xxh3_64_intdigest(words[i])
                if len(known) < CACHE_WORDS and len(words[i]) <= 40:
                    known[words[i]] = h
    return np.array(found, _U)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; words are split at ASCII white space."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, _U)
    h = word_hashes(words)
    n = min(k, len(h))
    out = np.zeros(len(h) - n + 1, _U)
    for i, a in enumerate(_odd(n, n)):
        out = _mix(out + h[i : len(h) - n + 1 + i] * a)
    return np.unique(out)


class Signer:
    """Band keys and one-byte signatures of a set, by multiply-shift universal hashing."""

    def __init__(self, s: Settings) -> None:
        n = s.bands * s.rows
        self.s, self.a, self.b, self.c = s, _odd(101, n)[:, None], _odd(102, n)[:, None], _odd(103, n)

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, bytes]:
        least = np.full(len(self.a), np.iinfo(_U).max)
        for i in range(0, len(hashes), 512):
            np.minimum(least, (self.a * hashes[None, i : i + 512] + self.b).min(1), out=least)
        one = _mix(least * self.c)
        keys = _mix(one.reshape(self.s.bands, self.s.rows).sum(1, dtype=_U) + np.arange(self.s.bands, dtype=_U))
        return keys.view(np.int64), (one >> _U(56)).astype(np.uint8).tobytes()


def sketches(documents: DataFrame, s: Settings) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fingerprint", pa.binary()), ("keys", pa.list_(pa.int64())), ("signature", pa.binary())])

    def run(batches):
        sign = Signer(s)
        for batch in batches:
            out = [[] for _ in schema]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                hashes = shingle_set(text.as_py(), s.shingle)
                keys, signature = sign(hashes) if len(hashes) and doc_id is not None else (None, None)
                for column, value in zip(out, (doc_id, len(hashes), xxhash.xxh3_128_digest(hashes.tobytes()), keys, signature), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return map_arrow(documents.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, n_shingles long, fingerprint binary, keys array<long>, signature binary")


def signature_verified(pairs: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """Pairs (u, v) whose signatures agree in at least the margin."""
    least = math.floor(s.margin * s.bands * s.rows)

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("su", "sv"))
            yield batch.select(["u", "v"]).filter(pa.array((a == b).sum(1) >= least))

    of = classes.select(F.col("node"), "signature")
    both = pairs.join(of.select(F.col("node").alias("u"), F.col("signature").alias("su")), "u").join(of.select(F.col("node").alias("v"), F.col("signature").alias("sv")), "v")
    return map_arrow(both.select("u", "v", "su", "sv"), run, "u long, v long")


def full_sets(nodes: DataFrame, documents: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """(node, hashes) of the named nodes, from their texts; written."""

    def sets(batches):
        for batch in batches:
            found = [shingle_set(t.as_py(), s.shingle) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([xxhash.xxh3_128_digest(h.tobytes()) for h in found], pa.binary()), pa.array([h.tobytes() for h in found], pa.binary())], names=["doc_id", "fingerprint", "hashes"])

    nodes = materialize(nodes.distinct(), "nodes")
    if nodes.count() <= BROADCAST_NODES:
        nodes = F.broadcast(nodes)
    rows = documents.select(F.col("doc_id").cast("long"), "text").join(nodes, F.col("doc_id") == F.col("node"), "left_semi")
    held = map_arrow(rows, sets, "doc_id long, fingerprint binary, hashes binary").dropDuplicates(["doc_id", "fingerprint"])
    return materialize(held.join(classes.select("node", "fingerprint"), [F.col("doc_id") == F.col("node"), classes["fingerprint"] == held["fingerprint"]], "left_semi").select(F.col("doc_id").alias("node"), "hashes"), "sets")


def unit_links(nodes: list[int], components: list[int], sets: list[np.ndarray], strays: np.ndarray, s: Settings) -> list[tuple[int, int]]:
    """Links of strays (places in ``nodes``) to nodes of other components: one for each two components
    that it connects, none within a component. All intersections of a stray are counted at once."""
    top, bottom = s.similar
    sizes = np.array([len(x) for x in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    begin = np.cumsum(sizes) - sizes
    mark = np.zeros(ids.max() + 1, np.int64)
    names, label = np.unique(np.array(components, np.int64), return_inverse=True)
    links = []
    for i in strays:
        mine = ids[begin[i] : begin[i] + sizes[i]]
        mark[mine] = 1
        shared = np.add.reduceat(mark[ids], begin)
        mark[mine] = 0
        near = np.flatnonzero((bottom * shared >= top * (sizes + sizes[i] - shared)) & (label != label[i]))
        for j in near:
            if label[j] != label[i]:
                links.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
                label[label == label[j]] = label[i]
    return links


def links_of_strays(apart: DataFrame, documents: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """Exact links between nodes of different components that share a bucket with a stray.

    ``apart`` are (key, node, component, apart). Of buckets with the same members one is looked at.
    Large ones are cut into units of about ``UNIT_ROWS`` strays and as many members, each pair of
    which meets in one unit; a unit gives links, not pairs.
    """
    one, two = (F.bit_xor(F.xxhash64("node", F.lit(i))) for i in (1, 2))
    open_ = apart.groupBy("key").agg(F.count("*").alias("n"), one.alias("one"), two.alias("two"), F.max("apart").alias("open")).where("open")
    chosen = open_.groupBy("n", "one", "two").agg(F.min("key").alias("key"))
    rows = apart.join(chosen.select("key", F.ceil(F.col("n") / UNIT_ROWS).cast("int").alias("k")), "key").withColumn("c", F.expr("cast(pmod(xxhash64(node, key), k) as int)"))
    each = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    members = rows.select("key", each.alias("sc"), F.col("c").alias("mc"), "node", "component", F.lit(False).alias("stray"))
    strays = rows.where("apart").select("key", F.col("c").alias("sc"), each.alias("mc"), "node", "component", F.lit(True).alias("stray"))
    units = materialize(members.union(strays), "units")
    held = full_sets(units.select("node"), documents, classes, s)

    def run(batches):
        def looked(unit):
            nodes, components, sets, strays = zip(*((r[3], r[4], np.frombuffer(r[6], _U), r[5]) for r in unit), strict=True)
            found = unit_links(list(nodes), list(components), list(sets), np.flatnonzero(strays), s)
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

        unit: list[tuple] = []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if unit and unit[0][:3] != r[:3]:
                    yield looked(unit)
                    unit = []
                unit.append(r)
        if unit:
            yield looked(unit)

    dealt = units.join(held, "node").select("key", "sc", "mc", "node", "component", "stray", "hashes").repartition("key", "sc", "mc").sortWithinPartitions("key", "sc", "mc")
    links = materialize(map_arrow(dealt, run, "u long, v long").distinct(), "links")
    discard(held)
    discard(units)
    return links


def confirmed(pairs: DataFrame, documents: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """Pairs (u, v) whose full sets reach the threshold."""
    top, bottom = s.similar

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch["hu"], batch["hv"], strict=True):
                a, b = np.frombuffer(a.as_buffer(), _U), np.frombuffer(b.as_buffer(), _U)
                if bottom * min(len(a), len(b)) < top * max(len(a), len(b)):
                    keep.append(False)
                    continue
                both = np.sort(np.concatenate([a, b]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(bottom * shared >= top * (len(both) - shared))
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    held = full_sets(pairs.select(F.col("u").alias("node")).union(pairs.select("v")), documents, classes, s)
    both = pairs.join(held.select(F.col("node").alias("u"), F.col("hashes").alias("hu")), "u").join(held.select(F.col("node").alias("v"), F.col("hashes").alias("hv")), "v")
    links = materialize(map_arrow(both.select("u", "v", "hu", "hv"), run, "u long, v long"), "links")
    discard(held)
    return links


def verified(pairs: DataFrame, documents: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """Links (u, v) among ``pairs`` of two nodes, first by signatures, then on full sets."""
    u, v = pairs.columns
    once = pairs.where(F.col(u) != F.col(v)).select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).distinct()
    candidates = materialize(signature_verified(once, classes, s), "candidates")
    links = confirmed(candidates, documents, classes, s)
    discard(candidates)
    return links


def judged(documents: DataFrame, s: Settings) -> DataFrame:
    """``near_duplicates`` with the fingerprint of each row's set."""
    rows = materialize(sketches(documents, s), "sketches")
    numbered = rows.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    least = materialize(numbered.groupBy("fingerprint").agg(F.min("doc_id").alias("node"), F.count("*").alias("n")), "least")
    heads = numbered.join(least, [numbered["fingerprint"] == least["fingerprint"], numbered["doc_id"] == least["node"]], "left_semi").dropDuplicates(["fingerprint"])
    classes = materialize(heads.select(F.col("doc_id").alias("node"), "fingerprint", "keys", "signature"), "classes")

    buckets = classes.select("node", F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    crowds = materialize(buckets.join(shared, "key"), "crowds")
    central = crowds.join(crowds.groupBy("node").agg(F.sum("n").alias("near")), "node")
    head = F.max_by("node", F.struct("near", -F.col("node"))).alias("head")
    others = [F.max_by("node", F.xxhash64("node", "key", F.lit(i))).alias(f"other{i}") for i in range(OTHERS)]
    members = materialize(central.join(central.groupBy("key").agg(head, *others), "key"), "members")
    discard(crowds)

    links = verified(members.select("head", "node"), documents, classes, s)
    found = materialize(connected_components(links), "components")
    for last in (False, True):
        named = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        of_head = found.select(F.col("node").alias("head"), F.col("component").alias("head_component"))
        apart = materialize(named.join(of_head, "head", "left").withColumn("apart", F.col("component") != F.coalesce("head_component", "head")), "apart")
        if last:
            more = links_of_strays(apart.select("key", "node", "component", "apart"), documents, classes, s)
        else:
            tried = apart.where("apart").select(F.col("node").alias("s"), F.explode(F.array(*(f"other{i}" for i in range(OTHERS)))).alias("m"))
            more = verified(tried, documents, classes, s)
        discard(apart)
        if not more.isEmpty():
            joined = materialize(links.union(more), "links")
            for t in (links, more, found):
                discard(t)
            links = joined
            found = materialize(connected_components(links), "components")
    for t in (members, links, classes):
        discard(t)
    of_class = least.join(found, "node", "left").select("fingerprint", "n", F.coalesce("component", "node").alias("component"))
    out = rows.select("doc_id", "n_shingles", "fingerprint")
    # classes of more than a share of all rows are at most 1 / HOT_SHARE, and are looked up by a broadcast
    n_rows = rows.count()
    hot = of_class.where(F.col("n") > HOT_SHARE * n_rows).select("fingerprint", F.col("component").alias("hot"))
    marked = out.join(F.broadcast(hot), "fingerprint", "left")
    rest = marked.where(F.col("hot").isNull()).drop("hot").join(of_class.where(F.col("n") <= HOT_SHARE * n_rows).select("fingerprint", "component"), "fingerprint", "left")
    named = rest.unionByName(marked.where(F.col("hot").isNotNull()).withColumnRenamed("hot", "component"))
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.col("component")).otherwise(F.col("doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id"), "fingerprint").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(documents: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per row of ``documents``."""
    return judged(documents, settings or Settings()).select("doc_id", "n_shingles", "component_id", "kept")


def deduplicated(documents: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One document of each group of near-duplicates, the one of least id; all columns.

    Where several rows have one doc_id, each is judged by its own text; of those whose sets are equal
    one stays. Rows without a doc_id stay.
    """
    s = settings or Settings()
    marks = materialize(judged(documents, s).where(F.col("doc_id").isNotNull()).groupBy("doc_id", "fingerprint").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n")), "marks")
    ids = marks.groupBy("doc_id").agg(F.sum("n").alias("n"), F.bool_or("kept").alias("kept"))
    key, at = F.col("doc_id").cast("long"), free_name(documents, "_set")
    other_id, other_set = free_name(documents, "_id"), free_name(documents, "_mark")
    same_id = key == F.col(other_id)
    single = documents.join(ids.where("n = 1 and kept").select(F.col("doc_id").alias(other_id)), same_id, "left_semi").unionByName(documents.where(key.isNull()))
    repeated = ids.where("n > 1").select(F.col("doc_id").alias(other_id))
    if repeated.isEmpty():
        return single
    several = documents.join(repeated, same_id, "left_semi")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)

    def sets(batches):
        for batch in batches:
            found = [xxhash.xxh3_128_digest(shingle_set(t.as_py(), s.shingle).tobytes()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, at])

    held = map_arrow(several, sets, f"{kinds}, `{at}` binary").dropDuplicates(["doc_id", at])
    kept = marks.where("kept").select(F.col("doc_id").alias(other_id), F.col("fingerprint").alias(other_set))
    return single.unionByName(held.join(kept, same_id & (F.col(at) == F.col(other_set)), "left_semi").drop(at))
