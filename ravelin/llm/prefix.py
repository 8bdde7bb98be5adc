"""Running sums over a sorted integer key, exact and without a task that sees all rows.

The key is read as digits of ``BITS`` bits: rows are summed by the key without its last digit, these sums again without
the next, until one group is left. A window then never holds more than ``2 ** BITS`` distinct keys of a group, and what
stands before a row is one partial sum for each digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ravelin.llm.common import materialize

#: Bits of a digit.
BITS = 10


def _up(key: Column) -> Column:
    return F.shiftright(key, BITS)


def running(df: DataFrame, key: str, sums: list[str], span: int, within: tuple[str, ...] = (), descending: bool = False) -> DataFrame:
    """``df`` with each column of ``sums`` replaced by its sum over the rows of the same ``within`` whose key is not larger
    (not smaller, if ``descending``).

    Keys are whole numbers from 0 to ``span``, one row each within a group; ``sums`` hold no nulls. An empty table stays empty.
    """
    order = F.col(key).desc() if descending else F.col(key)
    frame = Window.partitionBy(*within, _up(F.col(key))).orderBy(order)
    if span < 1 << BITS:
        return df.withColumns({c: F.sum(c).over(frame.rowsBetween(Window.unboundedPreceding, 0)) for c in sums})
    block, held = f"{key}_block", {c: f"{c}_before" for c in sums}
    blocks = df.groupBy(*within, _up(F.col(key)).alias(block)).agg(*(F.sum(c).cast(df.schema[c].dataType).alias(c) for c in sums))
    through = running(blocks, block, sums, span >> BITS, within, descending)
    before = through.select(*within, block, *(F.col(c).alias(held[c]) for c in sums)).join(blocks, [*within, block])
    before = before.select(*within, block, *((F.col(held[c]) - F.col(c)).alias(held[c]) for c in sums))
    inside = df.withColumns({c: F.sum(c).over(frame.rowsBetween(Window.unboundedPreceding, 0)) for c in sums}).withColumn(block, _up(F.col(key)))
    return inside.join(before, [*within, block]).select(*(((F.col(c) + F.col(held[c])).cast(df.schema[c].dataType).alias(c)) if c in held else F.col(c) for c in df.columns))


def ranked(df: DataFrame, group: str, order: list[Column], name: str, label: str) -> DataFrame:
    """``df`` with ``name``, a row's place from 0 within its ``group`` by ``order``; a large group is ranked by many tasks.

    Rows are written in range partitions of (group, order), each ranked by itself; what a group has in the partitions
    before is one count for each. Rows alike in all of ``order`` come in any order.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie, part, before = f"{name}_tie", f"{name}_part", f"{name}_before"
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(tasks, F.col(group), *order, F.col(tie)).withColumn(part, F.spark_partition_id())
    held = materialize(dealt, label)
    counts = held.groupBy(group, part).agg(F.count("*").alias(before))
    counts = counts.withColumn(before, F.coalesce(F.sum(before).over(Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    local = F.row_number().over(Window.partitionBy(group, part).orderBy(*order, tie)) - 1
    return held.withColumn(name, local).join(counts, [group, part]).withColumn(name, F.col(name) + F.col(before)).drop(tie, part, before)
