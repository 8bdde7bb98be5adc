import os
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ravelin.llm import common, packing, token_counts, token_files
from ravelin.llm.tokens import encoder, vocabulary_path

BYTE, WORD = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("word_bpe_49k.json")
TEXT = st.text(alphabet=st.sampled_from("abEé'sİß²½٣ \n\t\r\u00a0\u2028\u0301.,!<|3_-語ſK"), max_size=40)
DOCS = [
    (1, "Hello, world's  end.\n\nIt's 42.", 7), (2, None, 7), (3, "", 7), (4, "a b c " * 3000, 7), (4, "twice", 7), (5, "x" * 3000, 7), (None, "no id", 7), (6, "Hello, world's  end.\n\nIt's 42.", 7), (7, "naïve Ünï\u0301code \U0001f600 ok", 7),
]


def documents(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id bigint, text string, length int")


@pytest.mark.parametrize(("path", "kind"), [(BYTE, "byte"), (WORD, "word")])
@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_chunked_ids_are_the_librarys(path, kind, text):
    e = encoder(path, kind)
    assert np.frombuffer(e.encode(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(text=TEXT)
def test_chunked_spans_are_the_librarys(text):
    e = encoder(BYTE, "byte")
    starts, ends = e.token_spans(text)
    assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == e.tokenizer.encode(text, add_special_tokens=False).offsets


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_plan_places_every_piece_once(counts):
    plan = packing.plan_sequences(counts, 64)
    placed = Counter()
    for times, items in plan:
        assert sum(x * k for x, k in items) <= 64
        placed.update({x: times * k for x, k in items})
    assert placed == Counter(counts)
    total = sum(x * n for x, n in counts.items())
    assert -(-total // 64) <= sum(t for t, _ in plan) <= 2 * -(-total // 64)


def test_exact_complements_are_used_up():
    assert packing.plan_sequences({40: 3, 24: 3}, 64) == [(3, [(40, 1), (24, 1)])]
    assert sum(t for t, _ in packing.plan_sequences({30: 2, 20: 2, 14: 2}, 64)) == 2
    assert packing.plan_sequences({}, 64) == []


def expected_ids(path, text, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


def test_pack_round_trip(spark):
    rows = packing.pack(documents(spark)).collect()
    want = Counter()
    for doc_id, text, _ in DOCS:
        ids = expected_ids(BYTE, text, 0)
        cut = list(range(len(ids), 0, -2048))[::-1]
        for piece, (a, b) in enumerate(zip([0, *cut], cut, strict=False)):
            want[doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) == -(-sum(r.length for r in rows) // 2048)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert packing.pack(none).collect() == []
    assert token_counts.section_token_counts(none).collect() == []
    assert token_files.write_token_files(none).read().collect() == []


def test_token_counts_against_whole_encoding(spark):
    rows = token_counts.section_token_counts(documents(spark)).collect()
    got, want = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        got[r.doc_id][r.section] += r.n_tokens
    t = encoder(BYTE, "byte").tokenizer
    for doc_id, text, _ in DOCS:
        text = text or ""
        bounds = token_counts.line_bounds(text)
        for section in range(len(bounds) - 1):
            want[doc_id][section] += 0
        for a, _ in t.encode(text, add_special_tokens=False).offsets:
            want[doc_id][int(np.searchsorted(bounds[:-1], a, "right")) - 1] += 1
    assert got == want


def test_allocation_rules_and_given_sections(spark):
    starts, ends = np.array([0, 3, 7]), np.array([3, 7, 9])
    begins, stops = np.array([0, 4]), np.array([4, 8])
    assert token_counts.allocate(starts, ends, begins, stops, "first")[0].tolist() == [0, 0, 1]
    assert token_counts.allocate(starts, ends, begins, stops, "last")[0].tolist() == [0, 1, -1]
    assert token_counts.allocate(starts, ends, begins, stops, "larger")[0].tolist() == [0, 1, 1]
    sections = spark.createDataFrame([(1, 5, 0, 5)], "doc_id bigint, section int, begin bigint, end bigint")
    rows = token_counts.section_token_counts(documents(spark, DOCS[:2]), sections).collect()
    assert {(r.doc_id, r.section): r.n_tokens for r in rows} == {(1, -1): len(expected_ids(BYTE, DOCS[0][1], 0)) - 2, (1, 5): 1}


def sections_brute(text, sections, rule):
    """One owner per character, in the order of (begin, end, section); then tokens by their characters."""
    owner = [-1] * len(text)
    given = sorted((b, e, s is not None, s) for s, b, e in sections if b is not None and e is not None and 0 <= max(b, 0) <= e)
    for b, e, _, s in given:
        for i in range(max(0, b), min(e, len(text))):
            owner[i] = s if owner[i] == -1 else owner[i]
    counts = Counter()
    for a, b in encoder(BYTE, "byte").tokenizer.encode(text, add_special_tokens=False).offsets:
        held = owner[a : max(b, a + 1)]
        if rule == "larger":
            most = max(Counter(held).values())
            counts[next(x for x in held if held.count(x) == most)] += 1
        else:
            counts[held[0 if rule == "first" else -1]] += 1
    return counts


@pytest.mark.parametrize("rule", ["first", "last", "larger"])
def test_odd_sections_against_brute_force(spark, rule):
    text = "The quick brown fox jumps over the lazy dog; überall – and runs home."
    odd = [(1, 0, 9), (2, 5, 20), (3, 5, 8), (4, None, 30), (5, 30, None), (6, 50, 40), (7, 40, 500), (8, 20, 20), (9, -5, -1)]
    sections = spark.createDataFrame([(1, *s, "x") for s in odd] + [(None, 1, 0, 50, "x")], "doc_id bigint, section int, begin bigint, end bigint, text string")
    docs = [(1, text, None), (None, text, None), (2, text, None), (1, "short", None)]
    rows = token_counts.section_token_counts(documents(spark, docs), sections, rule=rule).collect()
    got = {(r.doc_id, r.section): r.n_tokens for r in rows if r.n_tokens and not (r.doc_id == 1 and r.section == 1 and r.end < 9)}
    whole = sum(sections_brute(text, [], rule).values())
    ours, short = sections_brute(text, odd, rule), sections_brute("short", odd, rule)
    total = Counter({s: n for s, n in ours.items()}) + Counter(short)
    summed = Counter()
    for r in rows:
        if r.doc_id == 1:
            summed[r.section] += r.n_tokens
    assert +summed == total and got[None, -1] == got[2, -1] == whole


def test_token_files_round_trip_and_access(spark):
    files = token_files.write_token_files(documents(spark))
    rows = sorted(files.read().collect(), key=lambda r: r.start)
    want, start = [], 0
    order = sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0))
    for doc_id, text, _ in order:
        ids = expected_ids(WORD, text, 2)
        want.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter(want)
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    assert [r.doc_id for r in rows] == [d[0] for d in order]
    found = []
    for s in files.shards.collect():
        found += token_files.ShardReader(bytes(s.blob), files.dictionary, files.width).find(1)
    assert [f.tolist() for f in found] == [expected_ids(WORD, DOCS[0][1], 2)]
    with pytest.raises(ValueError):
        token_files.ShardReader(bytes(s.blob), b"other", 2)


def test_token_files_are_opened_again(spark, tmp_path):
    path = f"file://{tmp_path}/files"
    written = token_files.write_token_files(documents(spark), path=path)
    opened = token_files.open_token_files(spark, path)
    assert sorted(map(str, opened.read().collect())) == sorted(map(str, written.read().collect()))
    assert [x.tolist() for x in opened.document(1)] == [expected_ids(WORD, DOCS[0][1], 2)] and opened.document(10**9) == []
    other = spark.createDataFrame([(bytearray(b"0" * 32), bytearray(b"abc"), 2)], "hash binary, dictionary binary, width int")
    other.write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(ValueError):
        token_files.open_token_files(spark, path)


def test_parts_follow_the_size_of_the_input(spark, monkeypatch):
    df = spark.range(100_000).selectExpr("id as doc_id", "repeat('word ', 20) as text")
    few = token_files.n_parts(df)
    monkeypatch.setattr(token_files, "PART_BYTES", 10_000)
    assert few == int(spark.conf.get("spark.sql.shuffle.partitions")) < token_files.n_parts(df) <= token_files.MOST_PARTS


def test_operators_run_in_a_session_started_elsewhere(tmp_path):
    """A plain session in another folder, without this package on its path: the package comes with the function, no setting changes."""
    code = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from ravelin.llm import common, packing
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
before = dict(spark.sparkContext.environment), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), spark.conf.get("spark.checkpoint.dir", None)
rows = packing.pack(spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")).collect()
assert sorted(r.doc_id for r in rows) == [1, 2], rows
assert before == (dict(spark.sparkContext.environment), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), spark.conf.get("spark.checkpoint.dir", None))
import os
paths = [p.removeprefix("file://") for p in common._written[spark.sparkContext.applicationId]]
assert paths and all(map(os.path.exists, paths))
common.release(spark)
assert not any(map(os.path.exists, paths))
print("fine")
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    plain = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code, root], cwd=tmp_path, env=plain, capture_output=True, text=True, timeout=300)
    assert said.returncode == 0 and "fine" in said.stdout, said.stderr[-2000:]


def test_a_cluster_must_name_its_shared_folder():
    session = lambda master: SimpleNamespace(conf=SimpleNamespace(get=lambda key, other=None: other), sparkContext=SimpleNamespace(master=master, applicationId="none"))
    with pytest.raises(ValueError):
        common.shared_dir(session("spark://host:7077"))
    assert common.shared_dir(session("local[2]")).startswith("file://")


def test_scratch_deletes_what_was_written_inside(spark):
    kept = common.materialize(spark.range(3), "kept")
    with common.scratch(spark) as keep:
        inner = common.materialize(spark.range(3), "inner")
        result = keep(common.materialize(spark.range(4), "result"))
        assert inner.count() == 3
    assert kept.count() == 3 and result.count() == 4
    common.discard(result)
    with pytest.raises(Exception):
        spark.read.parquet(inner._ravelin_path).count()
    common.discard(kept)
