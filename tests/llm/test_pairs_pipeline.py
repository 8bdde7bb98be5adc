import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ravelin.llm import components, near_dedup, top_k


def reach(nodes, links):
    near = defaultdict(set)
    for u, v in links:
        near[u].add(v)
        near[v].add(u)
    out = {}
    for n in nodes:
        seen, todo = {n}, [n]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        out[n] = min(seen)
    return out


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(200 + i, 201 + i) for i in range(30)] + [(500, 600 + i) for i in range(40)]
    got = components.connected_components(spark.createDataFrame([*links, (5, None)], "u bigint, v bigint")).collect()
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in got} == reach(nodes, links) and len(got) == len(nodes)
    assert components.connected_components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def jaccard_components(docs, k, top):
    def shingles(text):
        w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
        return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    sets = {i: shingles(t) for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= top * len(sets[a] | sets[b])]
    found = reach(sets, links)
    return {(i, len(sets[i]), found[i], found[i] == i) for i in sets}


@pytest.mark.parametrize(("k", "top", "bands", "rows"), [(3, 85, 36, 7), (5, 80, 42, 6)])
def test_near_duplicates_against_brute_force(spark, k, top, bands, rows):
    rng = random.Random(k)
    vocabulary = [f"w{i}" for i in range(300)]
    docs, base = [], []
    for i in range(260):
        if i % 4 == 0 or not base:
            base.append([rng.choice(vocabulary) for _ in range(rng.randint(20, 90))])
            words = base[-1]
        else:
            words = list(base[rng.randrange(len(base)) if i % 8 else 0])
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        docs.append((1000 - i, " ".join(words)))
    docs += [(2000, None), (2001, " \n"), (2002, "One two"), (2003, "one\ttwo"), (2004, "One"), (2005, "a b " * 20000), (2006, "É x y"), (2007, "é x y")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, node string")
    got = near_dedup.near_duplicates(df, near_dedup.Settings(k, (top, 100), bands, rows)).collect()
    assert Counter(map(tuple, got)) == Counter(jaccard_components(docs, k, top))


def test_near_duplicate_edges(spark):
    text = "some words that make a longer text for shingles of five"
    rows = [(1, text), (1, text), (2, text), (3, "other words"), (None, text), (None, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect())
    assert got == Counter({(1, 1, True): 2, (2, 1, False): 1, (3, 3, True): 1, (None, None, True): 2})
    assert Counter(tuple(r) for r in near_dedup.deduplicated(df).collect()) == Counter([(1, text), (3, "other words"), (None, text), (None, "z")])
    assert near_dedup.near_duplicates(df.limit(0)).collect() == []


def test_rows_that_share_an_id_are_judged_one_by_one(spark):
    a, b, c = ("some words that make a longer text for shingles of five", "quite another text that is like none of the other ones here", "a third text of its own with no part of it found elsewhere")
    rows = [(5, a, 1), (5, b, 2), (3, b, 3), (7, c, 4), (7, c, 5), (8, a, 6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _id int").selectExpr("*", "'x' as fingerprint", "1 as _set", "2 as kept")
    kept = near_dedup.deduplicated(df)
    assert kept.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(5, a), (3, b), (7, c)])


def test_large_buckets_are_cut_into_units(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "UNIT_ROWS", 3)
    sets = [near_dedup.shingle_set(t, 1) for t in ("a b c d", "a b c d e", "x y", "x y z q r s")]
    s = near_dedup.Settings(1, (80, 100), 2, 2)
    assert near_dedup.unit_links([1, 2, 3, 4], [1, 2, 3, 4], sets, np.array([1, 3]), s) == [(1, 2)]


def top_brute(rows, k, divisor):
    """Whole numbers of any size; scores as the nearest signed 64-bit ones."""
    scaled = [(i, [64 * float(x) if x is not None else None for x in v] if v is not None else None, r) for r, (i, v) in enumerate(rows)]
    valid = [(i, [int(np.floor(x)) for x in v], r) for i, v, r in scaled if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for q, v, r in valid:
        if q % divisor == 0:
            score = lambda w: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w, strict=False))))  # noqa: B023, E731
            best = sorted((-score(w), i) for i, w, o in valid if o != r)[:k]
            out.update((q, n, i, -s) for n, (s, i) in enumerate(best, 1))
    return out


def top_got(df, **settings):
    return Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k.exact_top_k(df, **settings).collect())


def test_top_k_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8).round(1)]) for i in range(130)]
    rows += [(3, rows[3][1]), (20, rows[20][1]), (500, None), (501, [None] * 8), (520, [float("nan")] * 8), (540, [float("inf")] + [0.0] * 7), (560, [1.0, 2.0]), (None, rows[0][1]), (580, [])]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id bigint, embedding array<float>, part int")
    want = top_brute(rows, 20, 20)
    for group, summary, together in ((16_384, 256, 64), (40, 2, 1)):
        monkeypatch.setattr(top_k, "GROUP_ROWS", group)
        monkeypatch.setattr(top_k, "SUMMARY_ROWS", summary)
        monkeypatch.setattr(top_k, "ASKED_RANGES", together)
        monkeypatch.setattr(top_k, "BLOCK_ROWS", 16)
        assert top_got(df) == want
    assert top_k.exact_top_k(df.limit(0)).collect() == []
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in top_k.exact_top_k(few).collect()] == [(0, 1, 1, 64 * 128)]


def test_top_k_of_very_large_values(spark, monkeypatch):
    monkeypatch.setattr(top_k, "GROUP_ROWS", 8)
    monkeypatch.setattr(top_k, "BLOCK_ROWS", 4)
    rng = random.Random(3)
    rows = [(i, [rng.choice([1e10, -1e10, 1e300, 1.7e308, 3.0, 2.0**40]), rng.uniform(-2, 2)]) for i in range(24)] + [(40, []), (60, [0.0, -0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert top_got(df, k=5, query_divisor=2) == top_brute(rows, 5, 2)


def test_queries_are_sent_to_ranges_that_can_matter_only(spark, monkeypatch):
    monkeypatch.setattr(top_k, "GROUP_ROWS", 50)
    monkeypatch.setattr(top_k, "BLOCK_ROWS", 10)
    rows = [(i, [1.0 if i // 50 == j else 0.0 for j in range(4)]) for i in range(200)]
    sent, ranged = [], top_k.sent_on
    monkeypatch.setattr(top_k, "sent_on", lambda *a: sent.append(ranged(*a)) or sent[-1])
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert top_got(df, k=5) == top_brute(rows, 5, 20)
    assert (sent[0].agg({"n": "sum"}).first()[0] or 0) <= 10  # of 10 queries by 3 other ranges; range edges may cut


def test_large_sums_are_exact():
    big = float(2**30)
    blocks = [(0, 0, np.array([1, 2]), np.array([[big, 1.0], [big, 2.0]]), np.array([big, 2.0]), np.array([big, 1.0]))]
    found = top_k.search(np.array([[big, 1.0]]), np.array([[0, 1, 0]]), blocks, 2)
    assert found[0][1].tolist() == [2, 1] and [int(x) for x in found[0][2]] == [2**60 + 2, 2**60 + 1]


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    words = ["stone", "river", "cloud", "meadow", "winter", "candle", "harbor", "silver", "garden", "window"]
    docs, labels = [], []
    for i in range(200):
        text = [rng.choice(words) + rng.choice(["", "s", "ly", "ing", "ed"]) for _ in range(40)]
        if i % 5 == 0:
            text[3] = text[9] = "idiot"
        docs.append((i, " ".join(text), "en", "s", 1))
        labels.append((i, 1, int(i % 5 == 0)))
    item = "Which planet of the solar system has the largest number of known moons today?"
    docs += [(300, docs[1][1], "en", "s", 1), (301, "123 456", "en", "s", 1), (302, docs[2][1] + " " + item, "en", "s", 1), (303, None, None, "s", 1)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = {i for i in range(200) if i % 5}
    want = [clean | {300, 301, 302, 303}, clean | {300, 302}, clean | {302}, clean]
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for (_, stage), ids in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        now = stage(spark, now, str(tmp_path))
        assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"] and {r.doc_id for r in now.collect()} == ids
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == clean and len({r.sequence_id for r in packed}) == -(-sum(r.length for r in packed) // 2048)


def write_tables(spark, path, docs, labels, items):
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").selectExpr("*", "'q' as scored", "1 as _row", "2 as _mark", "3 as `toxicity`").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    write_tables(spark, tmp_path, [], [], [])
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert len(now.columns) == 9 and now.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_pipeline_cases(spark, tmp_path):
    """Nulls, repeated ids and rows, very long texts and clashing names pass through every stage as the docstring says."""
    import corpus_pipeline
    from ravelin.llm import common

    rng = random.Random(4)
    words = ["stone", "river", "cloud", "meadow", "winter", "candle", "harbor", "silver", "garden", "window", "valley", "forest"]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(["", "s", "ly", "ing", "ed"]) for _ in range(n))
    one, two, long, free = text(40), text(40), text(30_000), text(40)
    docs = [(1, one, "en", "s", 1), (1, one, "en", "s", 1), (1, two, "en", "s", 1), (2, two, "en", "s", 1), (3, None, None, "s", 1), (4, "", "en", None, None), (5, "12 34", "en", "s", 1), (None, free, None, None, 1), (None, free, None, None, 1), (6, long, "en", "s", 1), (7, text(30), None, "s", 1)]
    write_tables(spark, tmp_path, docs, [(1, 1, 0), (None, 1, 1), (2, None, None)], [(1, None), (None, ""), (2, "no such passage stands anywhere in these texts at all")])
    now, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        ahead = stage(spark, now, str(tmp_path))
        assert ahead.columns == now.columns
        now = common.materialize(ahead, "now")
        left.append(Counter((r.doc_id, r.text) for r in now.collect()))
    rows = Counter((d[0], d[1]) for d in docs)
    gone = {(3, None), (4, ""), (5, "12 34")}
    assert left[0] == rows and left[1] == Counter({k: n for k, n in rows.items() if k not in gone})
    assert left[2] == left[3] == Counter({(1, one): 1, (1, two): 1, (None, free): 2, (6, long): 1, (7, docs[-1][1]): 1})
    before = set(common._written[spark.sparkContext.applicationId])
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(r.doc_id for r in packed.collect() if r.piece == 0) == Counter([1, 1, None, None, 6, 7])
    assert len(set(common._written[spark.sparkContext.applicationId]) - before) == 1
