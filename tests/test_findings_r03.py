"""Cases of the reviewer's third round."""

import duckdb
import pytest

import __spark_entry__

#: Texts in which engines see other words, blanks, ends and cases.
ODD = ["élos sol", "par losé", "ñet page", "voilà los", "goß net", "ﬁn los", "a goſs b", "Lacſ 12", "lacK 12", "page\u000b12", "TIG\u000b1 02 03 04 05", "ab\ncd\n", "abc\n", "go bur-\n", "it's\u000bso", "été", "Éte", "page 12\n", "0veré O5é", "é0ver", "RFVé éRFV", "x ı2 NOT 1", "straße:33 NOT 1", "los", "", " ", "\n"]


@pytest.mark.parametrize("name", ["line_predicates", "footer_strip", "pattern_replacements", "column_lines"])
def test_odd_texts_as_in_sql(spark, tmp_path, name):
    rows = [(i * 12 + 11 - t, t, "user", x) for i, x in enumerate(ODD) for t in (0, 4)] + [(i * 12 + 5, 2, "assistant", x) for i, x in enumerate(ODD)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = __spark_entry__.queries()[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS FROM '{tmp_path}/conversations.parquet/*.parquet'")
    sql = con.execute(f"SELECT {', '.join(found.columns)} FROM ({__spark_entry__.oracle_sql()[name]}) x").fetchall()
    assert sorted(map(repr, sql)) == sorted(repr(tuple(r)) for r in found.collect())


def test_reaches_is_ratio():
    import random

    from ravelin.functions.similarity import ratio, reaches

    rng = random.Random(3)
    words = ["", "a", "END OF TAPE", "TRANSCRIPTION", *("".join(rng.choices("AEINOPRTF ", k=rng.randint(1, 30))) for _ in range(120)), *("ab" * k for k in (90, 110, 300))]
    for a in words:
        for b in words:
            for least in (0.6, 0.72, 0.9, 1.0):
                assert reaches(a, b, least) == (ratio(a, b) >= least)


def test_a_page_works_out_few_ratios(monkeypatch):
    """Each word of each line was matched with each keyword by the sequence matcher, thousands of times a page."""
    from ravelin.functions import similarity
    from ravelin.operators import building

    met, real = [], similarity.ratio
    monkeypatch.setattr(similarity, "ratio", lambda a, b: met.append(a) or real(a, b))
    line = "04 05 06 07 CC and then there are these windows of the lower panel that were open before the others stood "
    text = "\n".join(line + " ".join(f"w{i}q{j}" for j in range(60)) for i in range(20))
    header, blocks = building.read_page(text, 4, building.Building())
    assert len(blocks) > 0 and header["page"] == 4
    assert len(met) < 60


def test_nearest_words_try_few_of_many(monkeypatch):
    """Bounds leave few pairs of words of the same letters to the sequence matcher; candidates stay those of all pairs."""
    import random
    from difflib import SequenceMatcher

    from ravelin.operators import similar

    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["th", "er", "an", "on", "tion", "ou", "he", "nd", "é"]) for _ in range(rng.randint(3, 6)))
    asked, known = {word() for _ in range(12)}, sorted({word() for _ in range(3000)} | {"anon" * 20, "th" * 31 + "t", "q"})
    tried, real = [], SequenceMatcher.ratio
    monkeypatch.setattr(SequenceMatcher, "ratio", lambda self: tried.append(1) or real(self))
    near = similar.Nearest([*asked, "anon" * 19], 20, lambda w: 0.6)
    for k in range(0, len(known), 700):
        near.meet(similar.KnownWords(known[k : k + 700]))
    assert len(tried) < 0.2 * len(asked) * len(known)
    for low, best in near.best.items():
        pairs = sorted(((real(SequenceMatcher(None, w, low)), w) for w in known), reverse=True)
        assert sorted(best, reverse=True) == [x for x in pairs if x[0] >= 0.6][:20]


def test_texts_without_repeats_are_read_once(monkeypatch):
    """Spans were tried one by one in every text; none is where no phrase of the shortest comes twice."""
    import random

    from ravelin.functions import repairs

    tried, real = [], repairs.first_repeat
    monkeypatch.setattr(repairs, "first_repeat", lambda words, n: tried.append(n) or real(words, n))
    assert repairs.without_repeats(" ".join(f"w{i}" for i in range(90))) and tried == []
    rng = random.Random(2)
    for _ in range(300):
        words = rng.choices(["a", "b", "c"], k=rng.randint(10, 40))
        found = next(((n, j) for n in repairs.SPANS if (at := real(words, n)) for j in at[1:]), None) if len(words) >= repairs.LEAST_WORDS else None
        assert repairs.without_repeats(" ".join(words)) == " ".join(words[: found[1]] + words[found[1] + found[0] :] if found else words)


@pytest.fixture
def ratios(monkeypatch):
    from ravelin.functions import similarity

    met, real = [], similarity.ratio
    monkeypatch.setattr(similarity, "ratio", lambda a, b: met.append(a) or real(a, b))
    return met


def test_parsed_pages_work_out_few_ratios(ratios):
    from ravelin.operators import pages

    text = "\n".join(f"04 05 06 {i:02} CC " + " ".join("r" + chr(97 + i) + "k" + chr(97 + j) + "w" for j in range(26)) for i in range(20))
    rows, _ = pages.PageReader().read(text)
    assert len(rows) == 20 and len(ratios) < 60


def test_stitched_pages_work_out_few_ratios(ratios):
    from ravelin.operators import pages, stitches

    blocks, _ = pages.PageReader().read("\n".join(f"04 05 06 {i:02} {('CC', 'CDR')[i % 2]} " + " ".join("m" + chr(97 + i) + "v" + chr(97 + j) + "w." for j in range(26)) for i in range(20)))
    for step in stitches.STEPS:
        blocks = step(blocks)
    assert len(blocks) == 20 and len(ratios) < 60


def test_headers_work_out_few_ratios(ratios):
    from ravelin.operators import building

    header = building.page_header("\n".join(" ".join(f"h{i}p{j}" for j in range(200)) for i in range(9)) + "\nTape 1/4", 4)
    assert header["tape"] == "1/4" and not header["is_apollo_title"] and len(ratios) < 20


def test_known_words_read_the_documents_once(spark):
    """The counts were made anew for their total, for the heavy words and for the join, by word and document each time."""
    found = __spark_entry__.queries()["known_words"](spark, "/root/testdata/sf0.001")
    assert not [f for f in found.inputFiles() if "documents.parquet" in f] and found.count() > 0
