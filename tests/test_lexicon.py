"""Loads of a lexicon against a recount."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from ravelin.operators import lexicon, terms

DOCS = [(1, "The cat. The dog"), (2, "the the cat"), (3, None), (4, ""), (5, "a dog a cat"), (6, "The cat")]


def recount(docs):
    words, bigrams, found = Counter(), Counter(), Counter()
    for _, text in docs:
        w = "".join(c if "a" <= c <= "z" else " " for c in (text or "").lower()).split()
        words.update(w)
        found.update(set(w))
        bigrams.update(map(" ".join, zip(w, w[1:], strict=False)))
    return {k: (n, found[k]) for k, n in words.items()}, {k: (n, None) for k, n in bigrams.items()}


def stored(spark, path):
    return tuple({r.term: (r.n, r.n_docs) for r in lexicon.counts(spark, path, kind).collect()} for kind in ("word", "bigram"))


def test_loads_add_up_replace_themselves_and_merge(spark, tmp_path):
    path, df = str(tmp_path / "lexicon"), lambda docs: spark.createDataFrame(docs, "doc_id long, text string")
    lexicon.store(df(DOCS[:2]), path, "a")
    lexicon.store(df(DOCS[4:5]), path, "b")
    lexicon.store(df(DOCS[2:4]), path, "b")  # stored again with other documents: these take the place of those
    assert stored(spark, path) == recount(DOCS[:4])
    lexicon.compact(spark, path)
    assert stored(spark, path) == recount(DOCS[:4])
    lexicon.store(df(DOCS[4:]), path, "c")
    lexicon.store(df(DOCS[4:]), path, "c")
    assert stored(spark, path) == recount(DOCS)


def test_counts_of_heavy_and_rare_terms(spark, monkeypatch):
    monkeypatch.setattr(lexicon, "HEAVY", 3)
    counted = spark.createDataFrame([("the", 50), ("cat", 40), ("dog", 3), ("a", 1)], "term string, n long")
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(["the", "the", "cat", "dog", "zz", None, "a"])], "i long, word string")
    assert [r.n for r in lexicon.with_counts(rows, counted, "word").orderBy("i").collect()] == [50, 50, 40, 3, 0, 0, 1]
    assert [r.n for r in lexicon.with_counts(rows, counted.where(F.lit(False)), "word").collect()] == [0] * 7


@pytest.mark.parametrize("block", [1, 40, 1 << 22])
def test_terms_as_in_sql(spark, tmp_path, monkeypatch, block):
    """Rows without doc_id counted as a document; of rows that share a doc_id each must not; capitals beyond ASCII have small letters in it."""
    monkeypatch.setattr(terms, "BLOCK", block)
    odd = [(None, "the cat"), (None, "The"), (7, "the the cat"), (7, "a cat"), (8, ""), (9, None), (10, "İstanbul 5Kelvin é the"), (11, "the"), (12, "THE"), (13, "cat-cat cat"), (14, "[a]`b{c@d"), (15, "x" * 99)]
    spark.createDataFrame(odd, "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("word_frequency", "bigram_frequency", "lexicon_loads"):
        found = __spark_entry__.queries()[name](spark, str(tmp_path))
        sql = con.execute(f"SELECT {', '.join(found.columns)} FROM ({__spark_entry__.oracle_sql()[name]}) x").fetchall()
        assert sorted(map(repr, sql)) == sorted(repr(tuple(r)) for r in found.collect())


def test_a_block_counts_each_term_once():
    """Each word went through a shuffle with its doc_id, and each place of a bigram was a row."""
    texts = ["the cat and the dog " * 50] * 40
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.arange(41) * len(texts[0])
    rows = [r for b in terms.block_counts(data, offsets, np.ones(40, bool), True, True) for r in b.to_pylist()]
    assert len(rows) == 4 + 5 and {"term": "the", "n": 4000, "n_docs": 40} in rows and {"term": "dog the", "n": 49 * 40, "n_docs": None} in rows


def test_compacting_writes_the_table_once_and_leaves_no_copy(spark, tmp_path):
    path = str(tmp_path / "lexicon")
    for load in ("a", "b"):
        lexicon.store(spark.createDataFrame(DOCS, "doc_id long, text string"), path, load)
    lexicon.compact(spark, path)
    assert [p.name for p in tmp_path.iterdir()] == ["lexicon"] and [p.name for p in (tmp_path / "lexicon").glob("load=*")] == ["load=merged"]
