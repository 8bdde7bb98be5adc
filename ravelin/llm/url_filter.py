"""URL filters: host and path rules, then link-graph propagation for what no rule decides.

Host edges are the absolute links in the pages' HTML, counted per pair of hosts before any shuffle,
and the ties between a host and its parent domain (both ways, down to two labels). Trust is
personalised PageRank from the hosts of allowed pages along the edges; distrust is the same from the
hosts of blocked pages along reversed edges. Rounds go on until no host's rank changes by more than
``SETTLED`` of itself over ``WRITE_EVERY`` rounds, so every host that can be reached has been. What a
host without steps onward holds goes back to the seeds: for each kind that is the same as scaling its
ranks to a sum of one, which is done once, at the end. A host's distrust share, distrust / (trust +
distrust), at or above ``threshold`` blocks its pages that no rule fits; a host reached by neither is
allowed.

Ranks are summed as decimals of ``DIGITS`` places, so sums do not depend on the order of their parts and
equal runs give equal verdicts; a change below a millionth of a millionth of a millionth of a millionth (six places
above the last, where it could no longer be told from rounding) counts as none. A share that
ties with the threshold blocks.

Defined cases: a null url or one without ``://`` has empty host and path, fits no rule and is allowed;
null HTML has no links; of rules of equal length the first in the alphabet wins; equal rows are
judged each; a null page_id stays null; a very long url or page is taken whole; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ravelin.llm.common import discard, materialize

DAMPING = 0.85
THRESHOLD = 0.5
#: Rounds between two written tables.
WRITE_EVERY = 4
#: Places of a rank behind the point.
DIGITS = 30
#: Largest change of a host's rank between two written tables, as a share of the rank, that counts as none.
SETTLED = 1e-6

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(rest: Column) -> Column:
    """The host of what follows ``://``."""
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def parsed(pages: DataFrame) -> DataFrame:
    """``pages`` with ``host`` and ``path``."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    return pages.withColumn("_rest", rest).withColumns({"host": F.coalesce(host_of(F.col("_rest")), F.lit("")), "path": F.coalesce(F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1), F.lit(""))}).drop("_rest")


def rule_verdict(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null if none; rules are (verdict, host/path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n) without self-links."""
    links = pages.where(F.col("host") != "").select("host", F.explode(F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?(?:https?:)?//([^"'\s>]+)"""), F.lit(1))).alias("target"))
    linked = links.select(F.col("host").alias("src"), host_of(F.col("target")).alias("dst")).where((F.col("dst") != "") & (F.col("src") != F.col("dst"))).groupBy("src", "dst").agg(F.count("*").alias("n"))
    hosts = pages.where(F.col("host") != "").select("host").distinct()
    labels = F.split("host", r"\.")
    above = hosts.where(F.size(labels) > 2).select("host", F.explode(F.sequence(F.lit(1), F.size(labels) - 2)).alias("i"))
    tail = lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    ties = above.select(tail(F.col("i")).alias("src"), tail(F.col("i") + 1).alias("dst")).distinct()
    both = ties.union(ties.select("dst", "src")).select("src", "dst", F.lit(1).cast("long").alias("n"))
    return linked.union(both).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def _exact(c: Column) -> Column:
    return c.cast(f"decimal(38,{DIGITS})")


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust), each summing to one; ``seeds`` are (host, trust, distrust) shares that each sum to one.

    ``rounds`` of None goes on until the ranks are settled. A change of at most a share of each rank stays
    one in later rounds, as these are linear and no share is negative; a host just reached changes by all of it.
    """
    out = edges.groupBy("src").agg(F.sum("n").alias("total"))
    into = edges.groupBy("dst").agg(F.sum("n").alias("total"))
    forward = edges.join(out, "src").select(F.lit(1).alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), (F.col("n") / F.col("total")).alias("share"))
    back = edges.join(into, "dst").select(F.lit(2).alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), (F.col("n") / F.col("total")).alias("share"))
    steps = materialize(forward.union(back), "host-steps")
    start = seeds.select(F.lit(1).alias("kind"), F.col("host").alias("a"), F.col("trust").alias("r")).union(seeds.select(F.lit(2), "host", "distrust")).where("r > 0")
    start = materialize(start, "host-seeds")
    none = _exact(F.lit(0))
    state, written = start, None
    for i in itertools.count(1) if rounds is None else range(1, rounds + 1):
        moved = steps.join(state, ["kind", "a"]).select("kind", F.col("b").alias("a"), _exact(F.col("share") * F.col("r").cast("double") * damping).alias("r"))
        moved = moved.union(start.select("kind", "a", _exact(F.col("r") * (1 - damping)))).withColumn("was", none)
        if i % WRITE_EVERY == 0 or i == rounds:
            last = start if written is None else written
            moved = moved.union(last.select("kind", "a", none.alias("r"), _exact(F.col("r")).alias("was")))
            state = materialize(moved.groupBy("kind", "a").agg(F.sum("r").alias("r"), F.sum("was").alias("was")), "host-ranks")
            discard(written)
            written = state
            change = F.abs(F.col("r").cast("double") - F.col("was").cast("double"))
            if rounds is None and state.where(change > F.greatest(SETTLED * F.col("r").cast("double"), F.lit(SETTLED**-1 * 10.0**-DIGITS))).isEmpty():
                break
        else:
            state = moved.groupBy("kind", "a").agg(F.sum("r").alias("r"))
    discard(steps)
    total = {r["kind"]: float(r["r"]) for r in state.groupBy("kind").agg(F.sum("r").alias("r")).collect()}  # two rows
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("r"))).cast("double"), F.lit(0.0)) / (total.get(kind) or 1.0)
    return state.groupBy(F.col("a").alias("host")).agg(of(1).alias("trust"), of(2).alias("distrust"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's distrust share."""
    rows = parsed(pages.select(F.col("page_id").cast("long"), "url", "html"))
    rule, verdict = rule_verdict(rules)
    judged = rows.withColumns({"rule": rule, "by_rule": verdict})
    counts = judged.where(F.col("host") != "").groupBy("host").agg(F.count_if(F.col("by_rule") == "allow").alias("good"), F.count_if(F.col("by_rule") == "block").alias("bad"))
    counts = materialize(counts, "hosts")
    sums = counts.agg(F.coalesce(F.sum("good"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    good, bad = (max(1, x) for x in sums)
    seeds = counts.select("host", (F.col("good") / good).alias("trust"), (F.col("bad") / bad).alias("distrust"))
    ranks = propagate(materialize(host_edges(rows), "host-edges"), seeds)
    share = F.when(F.col("trust") + F.col("distrust") > 0, F.col("distrust") / (F.col("trust") + F.col("distrust"))).otherwise(0.0)
    out = judged.drop("html", "url").join(ranks.select("host", share.alias("distrust_share")), "host", "left")
    distrust = F.coalesce("distrust_share", F.lit(0.0))
    by_host = F.when(distrust >= threshold, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_host).alias("verdict"), distrust.alias("distrust_share"))
