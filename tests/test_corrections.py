from ravelin.functions import lines, similarity
from ravelin.operators.corrections import Clock, corrected_speakers

from pyspark.sql import functions as F


def at(text):
    d, h, m, s = map(int, text.split())
    return ((d * 24 + h) * 60 + m) * 60 + s


def test_clock():
    def run(last, now, begun=True, stable=False, hint=None):
        clock = Clock()
        clock.last, clock.begun = at(last) if last else None, begun
        return *clock.corrected(at(now) if now else None, hint, stable), clock.last

    a = at("04 22 45 30")
    assert run("04 22 45 30", "04 12 46 15") == (at("04 22 46 15"), "corrected_hour", at("04 22 46 15"))
    assert run("04 22 45 30", "04 12 46 15", begun=False)[:2] == (at("04 12 46 15"), "sequence_reset")
    assert run("04 22 45 30", "04 12 46 15", stable=True)[1] == "sequence_reset"
    assert run("04 22 45 30", "04 22 45 30") == (a, "out_of_order", a)
    assert run("04 22 45 12", "04 22 45 10")[:2] == (at("04 22 45 50"), "inferred_tens")
    assert run("04 22 45 30", None)[:2] == (a + 1, "inferred_missing")
    assert run("04 22 45 30", "04 22 30 30")[:2] == (a + 1, "inferred_monotonic")
    assert run("04 02 45 30", "04 22 30 30")[:2] == (at("04 02 45 31"), "corrected_jump")
    assert run("04 22 45 32", "04 22 45 00", hint="5")[:2] == (at("04 22 45 35"), "inferred_suffix")
    assert run(None, None) == (None, None, None)


def test_similarity(spark):
    book = similarity.SpeakerBook()
    assert [book.correct(x) for x in ("CDF", "IMP", "CC?", "CNP", "12", "zzzz", None)] == ["CDR", "LMP", "CC", "CMP", "", "", ""]
    assert book.in_text("04: CDR go") == "CDR" and book.in_text("SWIM 1 go") == "SWIM 1"
    assert [similarity.place(x) for x in ("EAGLE", "LAUGHTER", "04 08", "EAGIE", None)] == ["EAGLE", "", "", "EAGLE", ""]
    assert all(map(similarity.is_goss_net, ("GOSS NET 1", "GO.05 NOT 1)", "G0SS N3T 1", "(60.000 NI'1 1)", "(000, NI\" 1)"))) and not similarity.is_goss_net("Roger, go ahead")
    assert similarity.is_footer("THREE ASTERISKS DENOTE CLIPING OF WORDS AND PHRASES") and similarity.is_header("AIR-T0-GROUND VOICE TRANSCRIPTION")
    df = spark.createDataFrame([("EAGIE",), (None,)], "x string")
    assert sorted(r[0] for r in df.select(similarity.near_place(F.col("x"))).collect()) == ["", "EAGLE"]


def test_speakers(spark):
    rows = [(1, 1, i, "comm", s, t) for i, (s, t) in enumerate([("CDF", "CDR. go"), (None, "fine"), ("12", "yes"), (None, "LMP here"), ("CC", "CCX"), (None, None)])]
    df = spark.createDataFrame(rows, "document long, page_num long, block_idx long, type string, speaker string, text string")
    got = [(r.speaker, r.text) for r in corrected_speakers(df).orderBy("block_idx").collect()]
    assert got == [("CDR", "go"), ("CC", "fine"), ("CDR", "yes"), ("LMP", "here"), ("CC", "CCX"), ("LMP", "")]
    assert corrected_speakers(df.limit(0)).count() == 0


def test_lines(spark):
    df = spark.createDataFrame([("CC: go", "Roger,", "now"), ("x", "Done.", "Now"), (None, None, None)], "a string, b string, c string")
    got = [tuple(r) for r in df.select(lines.named_speaker(F.col("a"), ["CC", "CDR"]), lines.continues(F.col("b"), F.col("c"), F.lit(False))).collect()]
    assert got == [("CC", True), (None, False), (None, False)]
