"""Rules of texts one by one: what is read, and what stands for it."""

import re
import tomllib

import pytest
from pyspark.sql import functions as F

from ravelin import config
from ravelin.functions import lines, repairs, stations, texts
from ravelin.operators import spelling


@pytest.mark.parametrize(
    ("read", "said"),
    [
        ("a · b 5°", "a . b 5"), ("commu- nication on", "communication on"), ("c t-off", "ct-off"), ("minus 4. go", "minus 4.0 go"), ("Plus 12.", "Plus 12.0"), ("minus 4.5", "minus 4.5"), ("Apollo:o 1:2", "Apolloo 1:2"),
        ("G() at", "GO at"), ("G()O now", "GO now"), ("a|b~c_d", "abcd"), ("don't 'x it ' y", "don't x it y"), ("( word here", "word here"), ("word ) on", "word on"), ("a  ) b", "a b"), ("", ""),
    ],
)
def test_noise(read, said):
    assert " ".join(repairs.without_noise(read).split()) == " ".join(said.split())


@pytest.mark.parametrize(
    ("read", "said"),
    [
        ("Try PSZ in ACCEPT now", "Try P52 in ACCEPT now"), ("is in  POO data", "is in P00 data"), ("Houston,  P6 is up", "Houston,  P60 is up"), ("PO1, Houston", "P01, Houston"), ("PAGE, Houston", "PAGE, Houston"),
        ("(7 12 1234, go", "007 12 1234, go"), ("(123 12 1234 go", "123 12 1234 go"), ("(7 12 123, go", "(7 12 123, go"), ("delta-cup and DELTA-UP", "DELTA-P and DELTA-P"), ("the IM/CM and im", "the LM/CM and LM"), ("H-band Is-IVB His-TP", "S-band S-IVB S-TP"),
        ("minus Two plus one Minus-Zero", "minus-X plus-Y Minus-Z"), ("equal Bravo", "quad Bravo"), ("a little e weak", "a little weak"), ("in tie background", "in the background"), ("question or that", "question on that"),
        ("hit the PASS light", "hit the PRESS light"), ("the PASS light", "the PASS light"), ("go and HAWAII (REV 4)", "HAWAII (REV 4)"), ("ELSEWHERE (REV 4)", "ELSEWHERE (REV 4)"),
    ],
)
def test_structured(read, said):
    assert repairs.structured(read, ["HAWAII"]) == said


@pytest.mark.parametrize(
    ("read", "said"),
    [
        ("we are at (TRANQ) base", "We are at base"), ("(MIN) now then, all of it", "Now then, all of it"), ("tell him go", "Tell I'm go"), ("had a look", "I'd a look"), ("one (only of it is here", "One only of it is here"), ("go) on", "go on"), ("(both) stay here", "(both) stay here"),
        ("(roger.) ROGER) (copy it", "ROGER. ROGER COPY it"), ("short", "short"), ("...go on with it", "...go on with it"), ("a b c d e f a b c d e f", "A b c d e f"), ("", ""),
    ],
)
def test_cleaned(read, said):
    assert repairs.cleaned(read, ["TRANQ"]) == said


def repeats_brute(text):
    w = text.split()
    if len(w) < 12:
        return text
    for n in range(12, 5, -1):
        found = [(i, j) for i in range(len(w)) for j in range(i + n, i + n + 20) if j + n <= len(w) and w[i : i + n] == w[j : j + n]]
        if found:
            j = min(found)[1]
            return " ".join(w[:j] + w[j + n :])
    return text


def test_repeated_phrases(spark):
    import random

    rng = random.Random(1)
    said = [" ".join(rng.choices("ab", k=rng.randint(5, 60))) for _ in range(60)] + ["x " * 300, "", "a b  c"]
    assert [repairs.without_repeats(t) for t in said] == [repeats_brute(t) for t in said]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(said)], "i int, t string").withColumn("w", texts.words_of(F.col("t")))
    assert [r[0] for r in df.select(texts.without_repeats(F.col("t"), F.col("w")), "i").orderBy("i").collect()] == [repeats_brute(t) for t in said]


def speller(**more):
    top = {"houston": 50, "the": 900, "engine": 40, "is": 500, "go": 300, "ceiling": 5, "receiving": 9, "we": 400, "roger": 100, "stage": 30}
    return spelling.lexicon_speller(top, ["over", "landing", "off"], {"the engine": 9, "we go": 3}, **more)


def test_text_corrector():
    c = repairs.TextCorrector(speller(keywords=["MADRID", "S-IVB DELTA"]), ["MADRID"], {r"\bRFV\b": "REV"})
    assert c.speller.frequency["madrid"] == 100 and "s-ivb" in c.speller.known and "off" in c.speller.known
    assert c.text("Houstom, teh engin is go.") == "Houston, the engine is go."
    assert c.text("HOUSTUN is over") == "HOUSTON is over"
    assert c.word("re'ceiling", None) is not None and c.word("don't", None) is None and repairs.without_apostrophe("it's") is None
    assert c.text("DELTA-P stage-2") == "DELTA-P stage-2"
    assert c.text("AIR TO GR0UND VOICE TRANSCIPTION") == "AIR-TO-GROUND VOICE TRANSCRIPTION" and c.text("GOSS NET 1") == "(GOSS NET 1)"
    assert c.text("G0 over RFV go (0") == "GO over REV go GO"
    assert c.words("landig-stage") == "landing-stage" and c.words("") == "" and c.words(" go  we ") == " go  we "


def test_lexicon_without_vocabulary_knows_keywords_only():
    s = spelling.lexicon_speller({"a": 1}, [], {}, ["Merritt Island"])
    assert s.known == {"merritt", "island"} and s.frequency["island"] == 100


def test_stations():
    known = ["HAWAII", "GRAND BAHAMA ISLANDS"]
    assert stations.variants("and over the HAWAII!") == ["OVER THE HAWAII", "HAWAII"] and stations.variants("") == [] == stations.variants("the")
    assert stations.matched("go at GRAND BAHAMA ISLANDS", known) == "GRAND BAHAMA ISLANDS" and stations.matched("GRAND BAHAMA", known) is None
    assert stations.near("GRAND BAHAMA", known) is None and stations.likeness("GRAND BAHAMA X", known[1]) == pytest.approx(0.17)
    assert stations.without_stations("HAWAII (REV 4) now, ELSE (PASS 2)", known) == ("now, ELSE (PASS 2)", ["HAWAII (REV 4)"])
    assert stations.taken_from_page_text("HAWAII (RFV 4) and HAWAII (pass 2) go", known) == ("go", ["HAWAII (REV 4)", "HAWAII (PASS 2)"])
    assert stations.taken_from_page_text("ELSE (REV 1) HAWAII (REV 4)", known) == ("ELSE (REV 1) HAWAII (REV 4)", [])
    assert stations.taken_from_page_text("ANY ONE (REV 1) x", []) == ("x", ["ANY ONE (REV 1)"])
    assert stations.is_station_line("HAWAII. (REV 4)", known) and not stations.is_station_line("ELSE (REV 4)", known)


def test_replacement_tables(spark):
    """The shipped tables give the same in the JVM as by the standard library, groups, signs and all."""
    tables = {**config.TEXT_REPLACEMENTS, r"(\w+)'11\b": r"\1'll", r"x\$": "$y\\\\"}
    said = ["at O5 RFV 3", "re  id it", "twelve  seen it", "R'id", "we'11 go x$", "(GOST NET 1)", "Air two ground voice transposition", "GRAINED BEAM"]
    df = spark.createDataFrame([(t,) for t in said], "t string")
    assert [r[0] for r in df.select(lines.replaced_by_patterns(F.col("t"), tables)).collect()] == [repairs.ruled(t, tables.items()) for t in said]
    assert repairs.ruled("at O5", tables.items()) == "at 05"


def test_settings_are_layered():
    default = tomllib.loads('dpi = 200\nocr_dual_pass = true\n[lexicon]\npath = "l.json"\nmission_keywords = ["A", "B"]\n[parser.text_replacements]\na = "b"\nc = "d"\n[correctors.speaker_ocr_fixes]\nX = "CC"')
    mission = {"mission_keywords": ["B", "C"], "text_replacements": {"c": "e"}, "ocr_dual_pass": False, "page_offset": -2, "footer_text_overrides": {"7": "foot"}, "post_merge": {"text_replacements": {"p": "q"}}, "valid_speakers": ["CC"], "col1_end": 0.2}
    s = config.layered(default, mission)
    assert s.mission_keywords == ["A", "B", "C"] and s.text_replacements == {"a": "b", "c": "e"} and s.speaker_ocr_fixes == {"X": "CC"}
    assert s.readings == ["raw", "faint_fallback", "textcol"] and (s.dpi, s.page_offset, s.lexicon, s.valid_speakers) == (200, -2, "l.json", ["CC"])
    assert s.footer_text_overrides == {7: "foot"} and s.post_merge == {"p": "q"}
    shipped = config.layered({})
    assert "HAWAII" in shipped.mission_keywords and shipped.readings == ["raw", "raw_fallback", "faint_fallback", "textcol"] and all(re.compile(p) for p in shipped.text_replacements)


def test_prompts_and_paths(tmp_path):
    (tmp_path / "p.toml").write_text('plain_ocr_prompt = """\nRead it.\n"""\ntext_column_prompt = "Column."')
    told = config.prompts(str(tmp_path / "p.toml"))
    assert (told["plain"], told["text_column"], told["column"]) == ("Read it.", "Column.", config.PROMPTS["column"])
    assert config.source_path("a", "in") == "in/a.pdf" and config.source_path("a.PDF", "in") == "in/a.PDF" and config.source_path(str(tmp_path), "in") == str(tmp_path)
