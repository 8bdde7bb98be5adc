"""The band join and the conversation trie against plain Python."""

import hashlib
import math
import random
import zlib

from ravelin.llm import conversation_trie as trie
from ravelin.llm.band_join import Band, band_join, nearest_first
from ravelin.llm.prefix import running

LINES = "sale_id long, line_no int, item_id long, quantity int, amount double, extra string, price double"
ITEMS = "item_id long, price double, quantity string, extra int"


def band_brute(lines, items, k, least, share, per):
    out = []
    for item, price, *_ in items:
        found = []
        p = math.floor(100 * price + 0.5) if price is not None and math.isfinite(price) else None
        for sale, no, other, q, amount, *_ in lines:
            if None in (sale, other, q, amount, item, p) or not q or not math.isfinite(amount) or other == item:
                continue
            u = (2 * math.floor(100 * amount + 0.5) + q) // (2 * q)
            if abs(u - p) <= least or per * abs(u - p) <= share * max(u, p):
                found.append((abs(u - p), u, sale, -1 if no is None else no, other, zlib.crc32(f"{sale},{'' if no is None else no},{other}".encode())))
        found.sort()
        totals = (len(found), sum(x[0] for x in found), sum(x[5] for x in found))
        for rank, x in enumerate(found[:k], 1):
            out.append((item, rank, x[0], x[1], x[2], None if x[3] < 0 else x[3], x[4], *totals))
        if not found:
            out.append((item, 0, None, None, None, None, None, 0, 0, 0))
    return sorted(out, key=str)


def run_band(spark, lines, items, k=2, band=Band()):
    return sorted((tuple(r) for r in band_join(spark.createDataFrame(lines, LINES), spark.createDataFrame(items, ITEMS), k, band).collect()), key=str)


def test_band_join_equals_all_pairs(spark):
    rnd = random.Random(11)
    prices = [0.0, 0.01, 1.0, 2.0, 2.005, 99.99, 655.35, 655.36, 999.0, 1000.0, 1310.72, 5000.0, 123456.78, 1e7]
    for k, band in ((2, Band()), (3, Band(5, 3, 100)), (1, Band(0, 0, 1))):
        lines = [(rnd.choice([1, 2, 3, None]), rnd.choice([None, 1, 2]), rnd.choice([7, 7, 7, 7, 8, 9, None]), q := rnd.choice([1, 1, 2, 3, 50, -2, 0, None]), rnd.choice([None, float("nan"), float("inf"), -3.0, rnd.choice(prices) * (q or 1) * (1 + rnd.uniform(-1, 1) * rnd.choice([0, 1e-4, 1e-3, 1e-2]))]), "x", 1.0) for _ in range(300)]
        lines += lines[:40]
        items = [(rnd.choice([7, 8, 9, 10, None]), rnd.choice([*prices, None, float("nan"), 1e20]), "q", 1) for _ in range(60)]
        assert run_band(spark, lines, items, k, band) == band_brute(lines, items, k, *band)


def test_band_join_passes_a_long_run_of_own_lines(spark):
    lines = [(s, 1, 7, 1, 10 + s / 100, "", 0.0) for s in range(80)] + [(900, 1, 8, 1, 10.9, "", 0.0), (901, 2, 8, 1, 9.1, "", 0.0)]
    items = [(7, 10.0, "", 0), (7, 10.0, "", 0), (8, 10.0, "", 0)]
    assert run_band(spark, lines, items) == band_brute(lines, items, 2, *Band())


def test_band_join_of_empty_tables(spark):
    items = [(1, 2.0, "", 0), (None, 1.0, "", 0)]
    assert run_band(spark, [], items) == band_brute([], items, 2, *Band())
    assert run_band(spark, [(1, 1, 1, 1, 1.0, "", 0.0)], []) == []


def test_nearest_first_keeps_k_of_an_item_and_2k_in_all():
    rows = [{"item_id": i, "n": n} for n, i in enumerate([1, 1, 1, 2, 3, 3])]
    assert [x["n"] for x in nearest_first(rows[:2], rows[2:], 2)] == [0, 1, 3, 4]


def test_running_sums_over_many_digits(spark):
    rnd = random.Random(3)
    keys = sorted(rnd.sample(range(5_000_000), 400))
    rows = [(g, k, rnd.randrange(-9, 9)) for g in ("a", "b") for k in keys]
    df = spark.createDataFrame(rows, "g string, k long, n long")
    for down in (False, True):
        got = {(r.g, r.k): r.n for r in running(df, "k", ["n"], 5_000_000, ("g",), down).collect()}
        assert got == {(g, k): sum(n for h, j, n in rows if h == g and (j >= k if down else j <= k)) for g, k, _ in rows}


TURNS = "conv_id long, turn long, role string, text string, n_convs int, depth string"


def rebuilt_brute(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))

    def key(t):
        return t[0], hashlib.sha256(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).hexdigest()

    own = {c: [t[1:] for t in sorted(ts, key=key)] for c, ts in own.items()}
    cut = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - int(math.fmod(c, 5)), [])[: cut[c]] + own[c][cut[c] :] for c in own}


def trie_brute(paths):
    nodes = {}
    for c, ts in paths.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    kids = {p: [q for q in nodes if len(q) == len(p) + 1 and q[: len(p)] == p] for p in nodes}
    out = []

    def walk(p):
        below = [walk(q) for q in kids[p]]
        leaves = sum(b[0] for b in below) or 1
        saved = sum(b[1] for b in below) + (len(nodes[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        ends = ",".join(map(str, sorted(c for c in nodes[p] if len(paths[c]) == len(p))))
        out.append((min(nodes[p]), len(p), min(nodes[p[:-1]]) if p else None, len(nodes[p]), len(kids[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if nodes:
        walk(())
    return sorted(out)


def run_trie(spark, rows):
    turns = spark.createDataFrame(rows, TURNS)
    ordered = trie.in_order(trie.digested(turns))
    return sorted(tuple(r) for r in trie.prefix_trie(trie.rebuilt(ordered), ordered.select("conv_id")).collect())


def test_trie_of_random_conversations(spark):
    rnd = random.Random(12)
    rows = [(c, rnd.choice([None, *range(6)]), rnd.choice(["user", "assistant", None, ""]), rnd.choice(["a", "aé", "", None, "b"]), 1, "x") for c in [*range(-7, 40), None] for _ in range(rnd.randrange(9))]
    rows += rows[:30]
    assert run_trie(spark, rows) == trie_brute(rebuilt_brute(rows))


def test_trie_of_long_conversations_and_chains_upon_chains(spark):
    rows = [(c, t, "user", "same" if t < 290 - 7 * c else f"{c}-{t}", 0, "") for c in range(6) for t in range(300)]
    rows += [(c, t, "user", "same", 0, "") for c in range(10, 30) for t in range(c)]
    assert run_trie(spark, rows) == trie_brute(rebuilt_brute(rows))


def test_trie_of_no_conversations(spark):
    assert run_trie(spark, [(None, 1, "user", "x", 0, "")]) == []


def test_ends_are_hashed_across_pieces(spark, monkeypatch):
    ids = list(range(-20, 10_000, 3))
    df = spark.createDataFrame([("p", i) for i in ids] + [("q", 5)], "prefix string, conv_id long").repartition(5)
    want = {"p": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), "q": hashlib.sha256(b"5").hexdigest()}
    assert {r.prefix: r.ends_sha256 for r in trie.ends_hashes(df).collect()} == want
