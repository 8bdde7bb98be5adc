"""Numeric band join: each item with all lines of other items whose unit price is near its own.

The join is inverted: a line's unit price u pairs with one range of prices, so no pair is ever made. Two separate steps
share nothing but the lines:

* *Sums.* Lines are added up by u. Each u then adds its count, its count times u and its crc at the first price of its
  range and takes them off behind the last, in difference arrays over the sorted distinct prices, one for the prices
  below u and one for those from u on, as the gap is u - p there and p - u here. The running sums (``prefix.running``)
  give every price its totals; what an item's own lines added is taken off by a join on the item.
* *Ranks.* Of the lines of one u only the first can be wanted: the first k of each item, of these the first 2k (an item
  leaves out its own lines, at most k of them). Prices and these candidates are dealt out by blocks of the price axis,
  each candidate to the one or two blocks its range touches, and swept outward from both sides; what a sweep carries
  is again at most 2k lines, at most k of an item. A block holds a bounded number of distinct prices while the band is
  absolute, and its sweep streams, so no memory grows with it.

Cases: lines null in sale_id, item_id, quantity or amount, with quantity 0, or with an amount or price that is not finite
or from 2**53 cents on, pair with nothing, nor do items null in item_id or price; such items have the row of an item
without pairs. A null line_no is empty in the crc's text and comes first among ties. Repeated lines count each; repeated
items have their rows each. Empty tables give no pairs, or no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ravelin.llm.common import map_arrow, materialize
from ravelin.llm.prefix import running

#: Rows of prices are repeated so often that many items of one price are joined by several tasks.
SALTS = 16
#: Cents from here on are not whole numbers in doubles.
EXACT = 1 << 53
WIDE = "decimal(38,0)"
SUMS = ["above_n", "above_u", "above_crc", "from_n", "from_u", "from_crc"]


class Band(NamedTuple):
    """A gap is near if it is at most ``least``, or ``per`` times it at most ``share`` times the larger price."""

    least: int = 100
    share: int = 1
    per: int = 1000


def cents(x: Column) -> Column:
    """Whole cents of a price in doubles; null where they would not be exact."""
    raw = F.floor(F.lit(100.0) * x + F.lit(0.5))
    return F.when(~F.isnan(x) & (F.abs(x) < EXACT / 100), raw).cast("long")


def floored(n: Column, d: Column) -> Column:
    """The largest whole number not above n / d, for d > 0."""
    return F.call_function("div", n - F.pmod(n, d), d)


def _lowest(u: Column, band: Band) -> Column:
    return u - F.greatest(F.lit(band.least), floored(F.lit(band.share) * u, F.lit(band.per)))


def _highest(u: Column, band: Band) -> Column:
    return F.greatest(u + band.least, floored(F.lit(band.per) * u, F.lit(band.per - band.share)))


def unit_prices(lines: DataFrame) -> DataFrame:
    """(u, item_id, sale_id, line_no, crc) of the lines that can pair: u in cents, rounded half up, exact."""
    q, a = F.col("quantity").cast("long"), F.col("a")
    known = lines.select("sale_id", "line_no", "item_id", "quantity", cents(F.col("amount")).alias("a")).dropna(subset=["sale_id", "item_id", "quantity", "a"]).where("quantity <> 0")
    u = floored(F.signum("quantity").cast("long") * (2 * a + q), 2 * F.abs(q))
    text = F.concat(F.col("sale_id").cast("string"), F.lit(","), F.coalesce(F.col("line_no").cast("string"), F.lit("")), F.lit(","), F.col("item_id").cast("string"))
    return known.select(u.alias("u"), F.col("item_id").cast("long"), F.col("sale_id").cast("long"), F.col("line_no").cast("long"), F.crc32(text.cast("binary")).alias("crc"))


def _totals(by_u: DataFrame, prices: DataFrame, band: Band) -> DataFrame:
    """(p, n, gaps, crc) of each distinct price, over the lines of all items."""
    u, zero = F.col("u"), F.lit(0).cast(WIDE)
    whole = [F.col("n").cast(WIDE), (F.col("n") * u.cast(WIDE)).cast(WIDE), F.col("c").cast(WIDE)]
    off = [(-c).cast(WIDE) for c in whole]

    def end(at: Column, above: list[Column], start: list[Column]) -> Column:
        return F.struct(at.alias("p"), *(c.alias(name) for c, name in zip(above + start, SUMS, strict=True)))

    ends = by_u.select(F.inline(F.array(end(_lowest(u, band), whole, [zero] * 3), end(u, off, whole), end(_highest(u, band) + 1, [zero] * 3, off))))
    points = ends.withColumn("price", F.lit(0)).unionByName(prices.select("p", *(zero.alias(c) for c in SUMS), F.lit(1).alias("price")))
    points = materialize(points.groupBy("p").agg(*(F.sum(c).cast(WIDE).alias(c) for c in SUMS), F.max("price").alias("price")), "band-points")
    least, most = points.agg(F.min("p"), F.max("p")).first()
    if least is None:
        return points.select("p", *(F.lit(0).cast(WIDE).alias(c) for c in ("n", "gaps", "crc")))
    at = running(points.withColumn("at", F.col("p") - least), "at", SUMS, most - least).where("price = 1")
    p = F.col("p").cast(WIDE)
    gaps = F.col("above_u") - p * F.col("above_n") + p * F.col("from_n") - F.col("from_u")
    return at.select("p", (F.col("above_n") + F.col("from_n")).cast(WIDE).alias("n"), gaps.cast(WIDE).alias("gaps"), (F.col("above_crc") + F.col("from_crc")).cast(WIDE).alias("crc"))


def _block(p: Column, band: Band) -> Column:
    """Blocks of the price axis, wide enough for the range of a u to touch two at most; wider where the band is relative."""
    width = (8 * (band.least + 1) - 1).bit_length()
    turn = max((band.least * band.per // band.share).bit_length() - 1, width) if band.share else 62
    scale = F.when((p > 0) & (F.shiftright(p, turn) > 0), F.length(F.bin(F.shiftright(p, turn)))).otherwise(0)
    return F.struct(scale.alias("scale"), F.call_function("shiftright", p, F.lit(width) + scale).alias("place"))


def nearest_first(new: list, held: list, k: int) -> list:
    """The first 2k of ``new`` and then ``held``, at most k of an item."""
    out, of = [], {}
    for x in (*new, *held):
        n = of.get(x["item_id"], 0)
        if n < k:
            of[x["item_id"]] = n + 1
            out.append(x)
            if len(out) == 2 * k:
                break
    return out


def _sweep(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, where = [], None
        for batch in batches:
            p, found = [], []
            for row in batch.select(["block", "side", "p", "near"]).to_pylist():
                if where != (place := (row["side"], row["block"]["scale"], row["block"]["place"])):
                    held, where = [], place
                if row["near"] is not None:
                    held = nearest_first(row["near"], held, k)
                else:
                    p.append(row["p"])
                    found.append(held)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(found, NEAR)], ["p", "near"])

    return run


LINE = "struct<u:bigint,sale_id:bigint,line_no:bigint,item_id:bigint>"
NEAR = pa.list_(pa.struct([(c, pa.int64()) for c in ("u", "sale_id", "line_no", "item_id")]))


def _candidates(lines: DataFrame, prices: DataFrame, band: Band, k: int) -> DataFrame:
    """(p, near): for each distinct price the lines of which its items' first k are among, 2k of either side at most."""
    order = [F.col("sale_id"), F.col("line_no").asc_nulls_first(), F.col("item_id")]
    own = F.row_number().over(Window.partitionBy("u", "item_id").orderBy("sale_id", F.col("line_no").asc_nulls_first()))
    few = lines.select("u", "item_id", "sale_id", "line_no").withColumn("own", own).where(F.col("own") <= k)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("u").orderBy(*order))).where(F.col("rank") <= 2 * k)
    by_u = few.groupBy("u").agg(F.array_sort(F.collect_list(F.struct("rank", F.struct("u", "sale_id", "line_no", "item_id").alias("line")))).alias("near")).select("u", F.col("near.line").alias("near"))
    blocks = F.explode(F.array_distinct(F.array(_block(_lowest(F.col("u"), band), band), _block(_highest(F.col("u"), band), band))))
    points = by_u.select(blocks.alias("block"), F.col("u").alias("p"), "near").unionByName(prices.select(_block(F.col("p"), band).alias("block"), "p", F.lit(None).cast(f"array<{LINE}>").alias("near")))
    # From below, a line at the price itself comes before the price; from above after it, as it was met already.
    sides = points.select("*", F.explode(F.array(F.lit(1), F.lit(-1))).alias("side")).withColumn("at", F.col("side") * F.col("p"))
    swept = sides.repartition("block", "side").sortWithinPartitions("block", "side", "at", F.col("side") * F.when(F.col("near").isNull(), 1).otherwise(0))
    both = map_arrow(swept.select("block", "side", "p", "near"), _sweep(k), f"p bigint, near array<{LINE}>")
    return both.groupBy("p").agg(F.flatten(F.collect_list("near")).alias("near"))


def band_join(lines: DataFrame, items: DataFrame, k: int = 2, band: Band = Band()) -> DataFrame:
    """Each item's first ``k`` pairs by gap, u, sale_id, line_no and the line's item, and its number of pairs, the sum of
    their gaps and the sum of their lines' crc32: one row for each rank, or one of rank 0 for an item without pairs."""
    if not 0 <= band.share < band.per or band.least < 0 or k < 1:
        raise ValueError("the band's share must lie below 1, its least gap and k must not be negative")
    all_items = items.select(F.col("item_id").cast("long"), cents(F.col("price")).alias("p")).groupBy("item_id", "p").agg(F.count("*").alias("copies"))
    named = all_items.where("item_id IS NOT NULL AND p IS NOT NULL")
    prices = named.select("p").distinct()
    found = unit_prices(lines)

    by_u = found.groupBy("u").agg(F.count("*").alias("n"), F.sum("crc").alias("c"))
    by_price = materialize(_totals(by_u, prices, band).join(_candidates(found, prices, band, k), "p"), "band-prices")

    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    per_item = found.groupBy("item_id", "u").agg(F.count("*").alias("n"), F.sum("crc").alias("c")).withColumn("salt", F.pmod(F.xxhash64("u"), F.lit(SALTS)).cast("int"))
    inside = F.col("p").between(_lowest(F.col("u"), band), _highest(F.col("u"), band))
    gap = F.abs(F.col("u") - F.col("p")).cast(WIDE)
    own = per_item.join(named.select("item_id", "p", salts), ["item_id", "salt"]).where(inside).groupBy("item_id", "p")
    own = own.agg(F.sum("n").alias("own_n"), F.sum((F.col("n") * gap).cast(WIDE)).alias("own_gaps"), F.sum("c").alias("own_crc"))

    salted = named.withColumn("salt", F.pmod(F.xxhash64("item_id"), F.lit(SALTS)).cast("int")).join(by_price.select("*", salts), ["p", "salt"]).join(own, ["item_id", "p"], "left")
    zero = F.lit(0).cast(WIDE)
    left = lambda c: (F.col(c) - F.coalesce(F.col(f"own_{c}"), zero)).cast("long")
    wanted = F.filter("near", lambda x: (x.item_id != F.col("item_id")) & F.col("p").between(_lowest(x.u, band), _highest(x.u, band)))
    rows = F.transform(wanted, lambda x: F.struct(F.abs(x.u - F.col("p")).alias("gap"), x.u.alias("u"), x.sale_id.alias("sale_id"), x.line_no.alias("line_no"), x.item_id.alias("line_item_id")))
    judged = salted.select("item_id", "copies", F.slice(F.array_sort(rows), 1, k).alias("pairs"), left("n").alias("n_pairs"), left("gaps").alias("gap_sum"), left("crc").alias("lines_crc"))
    judged = judged.unionByName(all_items.where("item_id IS NULL OR p IS NULL").select("item_id", "copies", F.array().cast(judged.schema["pairs"].dataType).alias("pairs"), *(F.lit(0).cast("long").alias(c) for c in ("n_pairs", "gap_sum", "lines_crc"))))
    ranked = judged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("item_id", "n_pairs", "gap_sum", "lines_crc", F.posexplode_outer("pairs").alias("place", "pair"))
    return ranked.select("item_id", F.coalesce(F.col("place") + 1, F.lit(0)).cast("int").alias("rank"), "pair.gap", "pair.u", "pair.sale_id", "pair.line_no", "pair.line_item_id", "n_pairs", "gap_sum", "lines_crc")
