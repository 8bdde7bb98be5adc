import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ravelin.llm import decontamination, language_id, license_scan, queries, toxicity, url_filter

SF = "/root/testdata/sf0.01"
EN = "the quick brown fox jumps over the lazy dog and runs home"
DE = "der schnelle braune fuchs springt über den faulen hund und läuft"


def table(spark, rows, extra=True):
    return spark.createDataFrame([(*r, "x", 1.5) for r in rows], "doc_id bigint, text string, lang string, score string, held_out double")


def test_language_edges(spark):
    rows = [(i, EN if i % 2 else DE, "en" if i % 2 else "de") for i in range(40)]
    rows += [(100, None, None), (101, "", "en"), (102, "123 ²", "en"), (103, EN * 2000, None), (None, DE, "de"), (1, EN, "en"), (104, "fox", None)]
    got = language_id.identify(table(spark, rows)).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: (r.lang_pred, round(r.score, 3)) for r in got}
    assert [found[i] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert found[103][0] == found[104][0] == "en" and found[None][0] == "de"
    assert language_id.identify(table(spark, [])).collect() == []
    assert {r.lang_pred for r in language_id.identify(table(spark, [(1, EN, None)])).collect()} == {"und"}
    kept = language_id.accepted(table(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "score", "held_out"] and kept.count() == len(rows) - 3


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, n = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right >= 0.97 * n > 0


def test_backoff_uses_the_longest_known_gram():
    t = language_id.Table.of(["a", "b"], [("a", "^xy", 5), ("b", "y$", 5)])
    s = language_id.Scorer(language_id.Model(["a", "b"], language_id.Table.of(["a", "b"], []), t))
    assert s("xy")[0] in "ab" and s("") == ("und", 0.0)
    assert s.backed_off("xy").tolist() == pytest.approx(((t.logs("^xy") + t.logs("y$")) / language_id.MAX_GRAM).tolist())


def language_brute(rows, text):
    """Totals by language from counts alone, without tables, caches or vectors."""
    words, grams = Counter(), Counter()
    for lang, t in rows:
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            words[lang, w] += 1
            marked = f"^{w}$"
            grams.update((lang, marked[i : i + n]) for n in range(1, 5) for i in range(len(marked) - n + 1))
    words = Counter({k: n for k, n in words.items() if n >= language_id.LEAST_WORD})
    grams = Counter({k: n for k, n in grams.items() if n >= language_id.LEAST_GRAM})
    languages = sorted({l for l, _ in rows})

    def logs(counts, feature):
        features = {f for _, f in counts}
        if feature not in features:
            return None
        each = [math.log((counts[l, feature] + 0.5) / (sum(n for (m, _), n in counts.items() if m == l) + 0.5 * len(features))) for l in languages]
        return [x - sum(each) / len(each) for x in each]

    total = [0.0] * len(languages)
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        found = logs(words, w)
        if found is None:
            found, marked = [0.0] * len(languages), f"^{w}$"
            for i in range(len(marked)):
                held = next((g for n in range(4, 0, -1) if i + n <= len(marked) and (g := logs(grams, marked[i : i + n])) is not None), None)
                found = [a + b / 4 for a, b in zip(found, held or [0.0] * len(languages), strict=True)]
        total = [a + b for a, b in zip(total, found, strict=True)]
    odds = [math.exp(x - max(total)) for x in total]
    return languages[total.index(max(total))], max(odds) / sum(odds)


def test_language_against_brute_force(spark):
    rng = random.Random(6)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(2, 7)))
    rows = [(i, " ".join(word(letters) for _ in range(12)), lang) for i in range(30) for lang, letters in (("xa", "abcde"), ("xb", "cdefg"), ("xc", "éüßabd"))]
    rows = [(i, *r[1:]) for i, r in enumerate(rows)] + [(500 + i, " ".join(word("abcdefgéü") for _ in range(3)), None) for i in range(12)]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    trained = [(lang, t) for i, t, lang in rows if lang and not held(i)]
    for r in language_id.identify(table(spark, rows)).collect():
        lang, score = language_brute(trained, next(t for i, t, _ in rows if i == r.doc_id))
        assert (r.lang_pred, r.held_out) == (lang, held(r.doc_id)) and r.score == pytest.approx(score, abs=1e-5)


def test_language_ties_and_repeated_ids(spark):
    """Equal totals go to the first language; a repeated id is learned from once per text, and the sample stays bounded."""
    learned = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    same = [(i, "same words here", lang) for i, lang in zip(learned, ["zz", "aa"] * 20, strict=False)]
    got = language_id.identify(table(spark, [*same, (99, "other", None)])).collect()
    assert {r.lang_pred for r in got} == {"aa"}
    rows = table(spark, [(7, EN, "en")] * 50 + [(7, DE, "de")] * 50 + [(8, EN + " x", "en")])
    assert language_id.sample_of(rows, 3).count() <= 6
    assert {(r.text[:3], r.lang) for r in language_id.sample_of(rows, 60).collect()} == {("the", "en"), ("der", "de")}
    many = table(spark, [(i, f"text{i} words{i}", f"l{i:03}") for i in range(120)] * 2)
    model = language_id.fit(many.select("doc_id", "text", "lang"), F.lit(True), in_all=50)
    assert len(model.languages) == 120 and len(model.grams.count) < 120 * 60


def labelled(n=300):
    rng = random.Random(3)
    words = ["stone", "river", "cloud", "meadow", "winter", "candle", "harbor", "silver", "garden", "window"]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) + rng.choice(["", "s", "ly"]) for _ in range(30)]
        if i % 5 == 0:
            text[rng.randrange(15)] = "idiot"
            text[rng.randrange(15, 30)] = "moron"
        docs.append((i, " ".join(text), "en"))
        labels.append((i, int(i % 5 == 0)))
    return docs, labels


def test_toxicity(spark):
    docs, labels = labelled()
    hidden = ["you 1d10t", "m o r o n", "idiiiiot", "i.d.i.o.t", "mor0n!"]
    docs += [(1000 + i, f"stone river {t} cloud", "en") for i, t in enumerate(hidden)]
    docs += [(2000, None, None), (2001, "", None), (2002, "a b c d e", "en"), (2003, "stone " * 20000, "en"), (None, "idiot", "en"), (0, docs[0][1], "en")]
    marks = spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id bigint, toxic int")
    got = toxicity.toxicity(table(spark, docs), marks).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    found = {r.doc_id: r.predicted for r in got}
    assert [(i, y) for i, y in labels if found[i] != y] == []
    assert [found[1000 + i] for i in range(len(hidden))] == [1] * len(hidden) and found[None] == 1
    assert all(found[i] == 0 for i in (2000, 2001, 2002, 2003))
    kept = toxicity.clean(table(spark, docs), marks)
    assert kept.columns == ["doc_id", "text", "lang", "score", "held_out"] and kept.where(F.col("doc_id") < 1000).count() == 240
    assert toxicity.toxicity(table(spark, []), marks).collect() == []
    assert {r.predicted for r in toxicity.toxicity(table(spark, docs[:3]), marks.limit(0)).collect()} == {0}


def test_decoding_against_all_paths():
    """The cheapest path of small lattices, by enumeration."""
    rng = random.Random(11)
    counts = np.array([rng.random() ** 6 + 1e-4 for _ in range(28**3)]).reshape(28, 28, 28)
    logs = np.log(counts / counts.sum(2, keepdims=True)).reshape(-1).tolist()

    def cost(symbols, channel):
        x = y = 0
        for s in [*symbols, 0]:
            if s or y:
                channel -= logs[(x * 28 + y) * 28 + s]
            x, y = (y, s) if s else (0, 0)
        return channel

    for _ in range(150):
        noisy = "".join(rng.choices("aabid013@!$*. -", k=rng.randint(1, 7)))
        if rng.random() < 0.3:
            noisy += noisy[-1] * rng.randint(1, 2)
        paths = [([s for o in p for s in o[0]], "".join(o[1] for o in p), sum(o[2] for o in p)) for p in itertools.product(*toxicity.lattice(noisy))]
        best = min(cost(symbols, channel) for symbols, _, channel in paths)
        assert toxicity.decode(noisy, logs) in {written for symbols, written, channel in paths if cost(symbols, channel) <= best + 1e-9}


def test_toxicity_channel(spark):
    docs, labels = labelled()
    hidden = ["idiiot", "!d!ot", "i  d  i  o  t", "m o r o n", "m  o  r  o  n", "mooron", "1 d i 0 t", "MORON!!", "idi0t!"]
    docs += [(1000 + i, f"stone river {t} cloud meadow", "en") for i, t in enumerate(hidden)]
    clean = ["a b c d", "!stone", "riiver", "x y z", "winnter", "the 1 2 3 of 4 5 6", "a | b | c"]
    docs += [(2000 + i, f"stone river {t} cloud meadow", "en") for i, t in enumerate(clean)]
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = {r.doc_id: r.predicted for r in toxicity.toxicity(table(spark, docs), marks).collect()}
    assert [t for i, t in enumerate(hidden) if not found[1000 + i]] == [] == [t for i, t in enumerate(clean) if found[2000 + i]]


def test_toxicity_learns_beginnings_and_bounds_its_sample(spark):
    rng = random.Random(2)
    docs, labels = labelled(150)
    ends = ["ung", "heit", "lich", "bar", "sam", "los", "chen", "lein", "haft", "ig"]
    for i in range(100):
        words = rng.choices(["garten", "fenster", "winter", "licht"], k=12) + [f"w{rng.randrange(10**6)}x"]
        docs.append((500 + i, " ".join([*words, *([f"scheusal{rng.choice(ends)}{rng.choice(ends)}"] * (i % 3 == 0))]), "de"))
        labels.append((500 + i, int(i % 3 == 0)))
    docs += [(900, "garten scheusalkeitlich winter", "de"), (901, "garten scheinen winter", "de")]
    docs += [(0, f"another text number {i}", "en") for i in range(40)]
    marks = spark.createDataFrame([*labels, *labels[:9]], "doc_id bigint, toxic int")
    found = {r.doc_id: r.predicted for r in toxicity.toxicity(table(spark, docs), marks).collect()}
    assert (found[900], found[901]) == (1, 0)
    logs = toxicity.character_model(table(spark, docs))
    assert toxicity.labelled_words(table(spark, docs), marks, F.lit(True), logs, 20).count() == 20


def edits(x, t):
    before = [0] * (len(t) + 1)
    for i, c in enumerate(x, 1):
        now = [i]
        for j, e in enumerate(t, 1):
            now.append(min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (c != e)))
        before = now
    return min(before)


def leak_brute(item, text):
    """Fewest edits within the budget; short items verbatim between blanks, or as the whole text."""
    if not item:
        return None
    if len(item) < decontamination.Q:
        return 0 if item == text else None
    if len(item) < decontamination.EXACT_BYTES:
        return 0 if b" " + item + b" " in b" " + text + b" " else None
    e = edits(item, text)
    return e if e <= decontamination.budget(len(item)) else None


@pytest.mark.parametrize(("letters", "hot", "pairs"), [(b"abcdef ", 256, 1 << 22), (b"abcdef ", 1, 50), (b"ab ", 256, 1 << 22), (b"ab ", 0, 7), (b"a ", 256, 1 << 22)])
def test_leaks_against_edit_distance(monkeypatch, letters, hot, pairs):
    """Also with thinned places (texts of few letters) and hot q-grams."""
    monkeypatch.setattr(decontamination, "HOT_ITEMS", hot)
    monkeypatch.setattr(decontamination, "PAIRS", pairs)
    rng = random.Random(5)
    piece = lambda n: b" ".join(bytes(rng.choices(letters, k=n)).split())
    items = [(i, piece(rng.choice([5, 12, 20, 30, 60, 110]))) for i in range(9)]
    index = decontamination.build_index(items, 0.1)
    positive = 0
    for _ in range(60):
        y = bytearray(rng.choice(items)[1])
        for _ in range(rng.randint(0, len(y) // 8)):
            if p := rng.randrange(len(y)) if y else 0:
                rng.choice([lambda: y.__setitem__(p, rng.choice(letters)), lambda: y.pop(p), lambda: y.insert(p, rng.choice(letters))])()  # noqa: B023
        text = b" ".join((piece(rng.randint(0, 50)) + b" " + bytes(y) + b" " + piece(rng.randint(0, 50))).split())
        got = {(d, k): e for d, k, _, _, e, _ in decontamination.find([b"zz", text, b"", items[0][1]], index)}
        want = {(d, i): e for d, t in enumerate([b"zz", text, b"", items[0][1]]) for i, x in items if (e := leak_brute(x, t)) is not None}
        assert got == want
        positive += len(want)
    assert positive > 20


def test_repeated_text_takes_no_square():
    item = b"abcdefgh " * 700
    index = decontamination.build_index([(1, item)], 0.1)
    began = time.time()
    at = np.arange(24_000)
    cells, counts = decontamination.cell_counts(at, np.zeros(len(at), np.int64), index)
    assert len(cells) and counts.sum() <= 12 * len(at)
    assert decontamination.find([item * 4], index)[0][:5] == (0, 0, 0, len(item), 0) and time.time() - began < 20


def test_leaks_edges(spark, monkeypatch):
    item = "What is the boiling point of water at sea level in degrees Celsius?"
    docs = [(1, f"Intro. {item} More.", "en"), (2, item.upper().replace(" ", "  "), "en"), (3, None, "en"), (4, "", "en"), (5, "clean text of no concern at all", "en"), (6, "pad " * 30000 + item, "en"), (None, item, "en"), (1, item, "en"), (9, "is it too, SHORT or not", "en"), (10, "too shorty", "en"), (11, "Why", "en"), (12, "why not", "en")]
    bench = spark.createDataFrame([(7, item, 0), (8, None, 0), (9, "too short", 0), (7, item, 1), (10, "why?", 0), (11, "?!", 0), (None, "", 0)], "item_id bigint, text string, doc_id int")
    want = Counter({(1, 7): 4, (2, 7): 2, (6, 7): 2, (None, 7): 2, (9, 9): 1, (11, 10): 1})
    for sizes in ((32 << 20, 4 << 20, 16 << 20), (150, 80, 1)):
        for name, n in zip(("PASS_BYTES", "BLOCK_BYTES", "HELD_BYTES"), sizes, strict=True):
            monkeypatch.setattr(decontamination, name, n)
        got = decontamination.leaks(table(spark, docs), bench).collect()
        assert Counter((r.doc_id, r.item_id) for r in got) == want and all(r.edits == 0 for r in got)
    clashing = table(spark, docs).withColumn("_row", F.lit(5))
    kept = decontamination.uncontaminated(clashing, bench)
    assert kept.columns == clashing.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 10, 12]
    assert decontamination.leaks(table(spark, []), bench).collect() == [] == decontamination.leaks(table(spark, docs), bench.limit(0)).collect()


def licence_brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    at = {p: [i for i in range(len(words)) if words[i : i + len(p.split())] == p.split()] for p in license_scan.BASE}
    starts = sorted(i for x in at.values() for i in x)
    base = sorted(label for p, label in license_scan.BASE.items() if at[p])
    own, score = set(), 0.0
    for t in license_scan.TEMPLATES:
        of, half = dict(t.words), max(1, t.drift // 2)
        for window in range(-200, len(words), half):
            stands = {s: {i for i, w in of.items() if 0 <= s + i < len(words) and words[s + i] == w} for s in range(window, window + t.drift)}
            share = len(set().union(*stands.values())) / len(of)
            if share >= license_scan.LEAST and all(any(set(p) <= held for held in stands.values()) for p in t.phrases):
                own.add(t.label)
                score = max(score, share)
    return (len(words), len(starts), starts[0] if starts else None, starts[-1] if starts else None, ",".join(base), ",".join(sorted({*base, *own})), score)


def by_sql(name, rows):
    import duckdb

    connection = duckdb.connect()
    connection.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}))
    return Counter(connection.execute(queries.ORACLES[name]).fetchall())


def test_licenses_against_brute_force_and_sql(spark):
    texts = [
        None, "", " ", "Licensed under CC BY-NC 4.0.", "cc by cc BY", "ALL rights\nreserved. All Rights Reserved", "GNU General Public License, version 3", "under the Apache License, Version 2.0 here", "Licensed under the Apache License, Version 2.0.",
        "Released under the MIT License. Released under the MIT License", "occ by", "éall rights reserved", "license " * 5000, "general public licenseé", "x 3 y GNU Lesser General Public License", "İcc by", "Redistribution and use in source and binary forms",
    ]
    docs = [(i, t, None) for i, t in enumerate(texts)] + [(None, texts[3], None), (3, texts[3], None)]
    got = Counter(map(tuple, license_scan.scan(table(spark, docs)).collect()))
    assert got == Counter((i, *licence_brute(t)) for i, t, _ in docs) == by_sql("op8_license_scan", docs)
    assert license_scan.scan(table(spark, [])).collect() == []


def test_licenses_of_a_text_with_all_templates(spark):
    notices = [t[1].replace("_", "x") for t in license_scan.LINES]
    whole = [t[1] for t in license_scan.NOTICES]
    texts = [". ".join(notices), ". ".join(reversed(notices)), " ".join(license_scan.VOCABULARY) + " license", "the ".join(f"{n} all free use by " for n in notices), " ".join(whole)]
    rng = random.Random(4)
    for notice in whole:
        words = notice.split()
        texts += [" ".join(words[: len(words) // 2]), " ".join(f"{i} {w}" if i % 20 == 0 else w for i, w in enumerate(words)), " ".join(w for w in words if rng.random() > 0.02)]
    docs = [(i, t, None) for i, t in enumerate(texts)] + [(100 + i, f"license {w}", None) for i, w in enumerate(license_scan.VOCABULARY[::2])]
    rows = license_scan.scan(table(spark, docs)).collect()
    assert Counter(map(tuple, rows)) == Counter((i, *licence_brute(t)) for i, t, _ in docs) == by_sql("op8_license_scan", docs)
    labels = {t.label for t in license_scan.TEMPLATES}
    assert {r.doc_id: labels - {"isc"} <= set(r.labels.split(",")) for r in rows if r.doc_id < 2} == {0: True, 1: True}
    assert {t[0] for t in license_scan.NOTICES} <= set(next(r.labels for r in rows if r.doc_id == 4).split(","))


def test_a_phrase_over_and_over_takes_no_square(spark):
    began = time.time()
    got = license_scan.scan(table(spark, [(1, "cc by " * 16_000, None), (2, "licensed under cc by 4 0 " * 4000, None)])).collect()
    assert {(r.doc_id, r.n_base, r.last_word, r.labels) for r in got} == {(1, 16_000, 31_998, "cc-by"), (2, 4000, 23_996, "cc-by,cc-by-4.0")}
    assert time.time() - began < 60


def rank_brute(edges, seed, rounds=600, damping=url_filter.DAMPING):
    """Ranks with what hosts without steps hold going back to the seeds."""
    total = Counter()
    for a, _, n in edges:
        total[a] += n
    now = dict(seed)
    for _ in range(rounds):
        lost = sum(r for h, r in now.items() if not total[h])
        ahead = Counter()
        for a, b, n in edges:
            ahead[b] += damping * now.get(a, 0) * n / total[a]
        for h, r in seed.items():
            ahead[h] += (1 - damping + damping * lost) * r
        now = ahead
    return now


def url_brute(rows, rules):
    """page_id -> (host, path, rule, verdict), from the contract's words and converged ranks."""
    lower = lambda x: "".join(c.lower() if c.isascii() else c for c in x)
    judged, edges = [], Counter()
    for page, url, html in rows:
        _, sep, rest = (url or "").partition("://")
        host = lower(re.match("[^/?#]*", rest)[0]) if sep else ""
        path = re.match("[^/?#]*([^?#]*)", rest)[1] if sep else ""
        fits = [(len(r), [-ord(c) for c in r], r, v) for v, r in rules for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        judged.append((page, host, path, *(max(fits)[2:] if fits else (None, None))))
        for target in re.findall(r"""(?i)href\s*=\s*["']?(?:https?:)?//([^"'\s>]+)""", html or ""):
            to = lower(re.match("[^/?#]*", target)[0])
            if host and to and to != host:
                edges[host, to] += 1
    for host in {j[1] for j in judged if j[1]}:
        labels = host.split(".")
        for i in range(len(labels) - 2):
            a, b = ".".join(labels[i:]), ".".join(labels[i + 1 :])
            edges[a, b] += 0 if (a, b, "t") in edges else 1
            edges[b, a] += 0 if (a, b, "t") in edges else 1
            edges[a, b, "t"] = 0
    held = [(*k, n) for k, n in edges.items() if len(k) == 2 and n]
    seeds = [Counter(j[1] for j in judged if j[4] == v and j[1]) for v in ("allow", "block")]
    seeds = [{h: n / sum(c.values()) for h, n in c.items()} for c in seeds]
    trust, distrust = rank_brute(held, seeds[0]), rank_brute([(b, a, n) for a, b, n in held], seeds[1])
    out = []
    for page, host, path, rule, verdict in judged:
        t, d = trust.get(host, 0), distrust.get(host, 0)
        out.append((page, host, path, rule, verdict or ("block" if host and d > 0 and d / (t + d) >= 0.5 else "allow")))
    return Counter(out)


def test_url_filter(spark):
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
    link = '<a href="https://bad.net/es/x">x</a><a HREF=\'//hub.org/y\'>y</a><a href="/own">o</a>'
    rows = [
        (1, "https://A.Example.com/en/x?q#f", link), (2, "http://www.example.com/en/", None), (3, "http://bad.net/es/1", ""), (4, "http://bad.net/de/1", link), (5, None, None), (6, "no-scheme.com/x", link), (7, "x://hub.org", '<a href="http://bad.net/">b</a>'),
        (8, "http://lone.org/é?x", None), (9, "http://comx/", None), (10, "http://example.com", None), (1, "https://A.Example.com/en/x?q#f", link), (None, "http://bad.net/fr/" + "x" * 100_000, None),
    ]
    rng = random.Random(8)
    hosts = [f"{a}{i}.{b}" for i in range(8) for a in ("", "w.", "v.w.") for b in ("org", "com", "net")]
    for i in range(120):
        links = "".join(f'<a href="http{rng.choice(["", "s"])}://{rng.choice(hosts)}/{rng.choice("xyz")}">l</a>' for _ in range(rng.randint(0, 3)))
        rows.append((100 + i, f"https://{rng.choice(hosts)}/{rng.choice(['es', 'fr', 'en', 'de'])}/{i}", links))
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, host string")
    got = url_filter.judge(pages, rules).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == url_brute(rows, rules)
    of = {r.page_id: r for r in got}
    assert (of[1].host, of[1].path, of[1].rule, of[1].verdict) == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert (of[2].rule, of[2].verdict) == ("www.example.com/en/", "allow") and (of[4].rule, of[4].verdict) == (None, "block")
    assert url_filter.judge(pages.limit(0), rules).collect() == []


def test_url_filter_ties_are_settled_alike(spark):
    """A host as near to one good as to one bad seed has a share of one half, which blocks, whatever the order of rows."""
    link = lambda host: f'<a href="https://{host}/">x</a>'
    rows = [(i, f"https://good{i}.org/", link("mid.org")) for i in range(7)] + [(10 + i, "https://mid.org/", link(f"bad{i}.net")) for i in range(7)] + [(20 + i, f"https://bad{i}.net/", None) for i in range(7)]
    rules = [*(("allow", f"good{i}.org/") for i in range(7)), *(("block", f"bad{i}.net/") for i in range(7))]
    shares = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(order, "page_id bigint, url string, html string").repartition(5), rules).collect()}
        shares.add(got[10].distrust_share)
        assert {got[10 + i].verdict for i in range(7)} == {"block"}
    assert shares == {0.5}


def test_url_filter_settles(spark):
    """Every rank against a solution of many rounds, on cycles and on chains longer than any fixed count of rounds."""
    rng = random.Random(5)
    edges = [(f"h{i}", f"h{j}", rng.randint(1, 3)) for i in range(60) for j in rng.sample(range(60), 2) if i != j]
    edges += [(f"c{i}", f"c{i + 1}", 1) for i in range(20)] + [(f"d{i + 1}", f"d{i}", 1) for i in range(20)]
    trust, distrust = {"h0": 0.5, "c0": 0.5}, {"h1": 0.5, "d0": 0.5}
    seeds = spark.createDataFrame([(h, trust.get(h, 0.0), distrust.get(h, 0.0)) for h in {**trust, **distrust}], "host string, trust double, distrust double")
    got = {r.host: r for r in url_filter.propagate(spark.createDataFrame(edges, "src string, dst string, n bigint"), seeds).collect()}
    good = rank_brute(edges, trust)
    bad = rank_brute([(b, a, n) for a, b, n in edges], distrust)
    assert set(got) == {*good, *bad}
    for h in got:
        assert got[h].trust == pytest.approx(good.get(h, 0), rel=1e-5, abs=0) and got[h].distrust == pytest.approx(bad.get(h, 0), rel=1e-5, abs=0)
    assert got["c20"].trust > 0 and got["d20"].distrust > 0


def test_url_filter_blocks_far_hosts(spark):
    link = lambda host: f'<a href="https://{host}/">x</a>'
    rows = [(i, f"https://h{i}.org/", link(f"h{i + 1}.org" if i < 20 else "bad.net")) for i in range(21)] + [(21, "https://bad.net/", None)]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id bigint, url string, html string"), [("block", "bad.net/")]).collect()}
    assert {r.verdict for r in got.values()} == {"block"} and min(r.distrust_share for r in got.values()) == 1.0
