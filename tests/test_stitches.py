import difflib
import random

from ravelin.functions import repairs
from ravelin.operators import spelling, stitches
from ravelin.plans import transcripts

DDL = "document long, page_num long, block_idx long, type string, timestamp string, speaker string, location string, text string"


def stitch(spark, *rows, **k):
    df = spark.createDataFrame([(1, 1, i, *r) for i, r in enumerate(rows)], DDL)
    return [(r.type, r.speaker, r.text) for r in stitches.stitched(df, **k).orderBy("block_idx").collect()]


def plain(*rows):
    return [dict(zip(("type", "timestamp", "speaker", "location", "text"), r, strict=True)) for r in rows]


def test_stitched(spark):
    assert stitch(spark, ("comm", "t1", "CC", None, "Houston we have"), ("annotation", None, None, None, "GARBLED"), ("continuation", None, None, None, "a problem here.")) == [("comm", "CC", "Houston we have GARBLED a problem here.")]
    assert stitch(spark, ("comm", "01 02 03 04", "CC", None, "-- BEGIN LUNAR REV 4"), ("comm", "t2", "CDR", None, "Go."), ("continuation", None, None, None, "Pnrc 107"), ("annotation", None, None, None, " ")) == [("meta", None, "BEGIN LUNAR REV 4"), ("comm", "CDR", "Go.")]
    assert stitch(spark) == []


def test_twins():
    near = lambda n, *rows: [(b["speaker"], b["text"]) for b in stitches.twins(n)(plain(*rows))]
    a, b, c = ("comm", "t", "CC", None, "we go now"), ("comm", "t", None, "EAGLE", "we go now to it"), ("comm", "u", "CC", None, "other")
    assert near(1, a, b) == [("CC", "we go now to it")]
    assert near(1, a, c, b) == [("CC", "we go now"), ("CC", "other"), (None, "we go now to it")]
    assert near(4, a, c, b) == [("CC", "we go now to it"), ("CC", "other")]
    assert near(1, a, ("comm", "t", "CDR", None, "we go")) == [("CC", "we go now"), ("CDR", "we go")]
    assert near(4, a, ("comm", "t", "CC", None, "quite another thing")) == [("CC", "we go now"), ("CC", "quite another thing")]


def test_repeats():
    assert repairs.without_repeats("a b c d e f a b c d e f g") == "a b c d e f g"
    assert repairs.without_repeats("a b c d e a b c d e") == "a b c d e a b c d e"
    assert repairs.without_repeats("") == ""


def test_speller(spark):
    words = {"roger": 50, "rover": 20, "go": 90, "going": 30, "we": 70, "command": 10}
    s = spelling.Speller(words, {"we going": 40})
    for w in ("rogr", "goin", "comand", "zzz", "rov", "wx"):
        assert set(s.candidates(w)) == set(difflib.get_close_matches(w, list(words), n=20, cutoff=0.5 if len(w) <= 3 else 0.6))
        assert s.candidates(w) == difflib.get_close_matches(w, list(words), n=20, cutoff=0.5 if len(w) <= 3 else 0.6)
    assert [s.suggest(x) for x in ("Rogr", "COMAND", "roger", "don't", "12", "wx", "qqqqq")] == ["Roger", "COMMAND", None, None, None, None, None]
    docs = spark.createDataFrame([("we goin",), (None,), ("we goin rogr",)], "text string")
    got = {(r.word, r.before, r.n, r.suggestion) for r in spelling.suggestions(spelling.word_pairs(docs), s).collect()}
    assert got == {("goin", "we", 2, "going"), ("rogr", "goin", 1, "roger")}


def test_speller_of_tables(spark):
    rng = random.Random(3)
    made = lambda: "".join(rng.choices("aeinrst", k=rng.randint(2, 7)))
    words = {made(): rng.randint(1, 40) for _ in range(400)} | {"o'neil": 1, "once": 1, "going": 2}
    told = [rng.choice([w, w.title(), w.upper(), "don't", "I"]) for w in [*(made() for _ in range(300)), *list(words)[:60], "goin", "o'neal", "onc"] for _ in range(2)]
    bigrams = {f"{rng.choice(told).lower()} {w}": rng.randint(1, 90) for w in [*words] * 6}
    docs = spark.createDataFrame([(" ".join(told[i : i + 7]),) for i in range(0, len(told), 7)] + [(None,), ("",)], "text string")
    pairs, s = spelling.word_pairs(docs), spelling.Speller(words, bigrams)
    got = spelling.table_suggestions(pairs, spark.createDataFrame([*words.items()], "word string, n long"), spark.createDataFrame([*bigrams.items()], "bigram string, n long"))
    expected = {(r.word, r.before, r.n, x) for r in pairs.collect() if (x := s.suggest(r.word, r.before))}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(expected) > 200 and set(rows) == expected


def test_spelling_knows_every_word_of_the_documents(spark, tmp_path):
    spark.createDataFrame([(1, "roger tranquility base roger", "en"), (2, "roger", "en")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, "user", "tranquility rogar")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.word, r.suggestion) for r in transcripts.spelling_suggestions(spark, str(tmp_path)).collect()}
    assert got == {("rogar", "roger")}
    spark.createDataFrame([(1, 1, "user", "tranquillity")], "conv_id long, turn long, role string, text string").write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    assert [r.suggestion for r in transcripts.spelling_suggestions(spark, str(tmp_path)).collect()] == ["tranquility"]
