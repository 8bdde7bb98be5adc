"""Ordered scans: a small machine reads the rows of each key in order and writes rows as it goes.

One shuffle brings the rows of a key together and sorts them (spilling to disk); the machine then sees
them one after another. What a task holds is the machine's own state and one Arrow batch, so a key with
a large part of all rows costs time in one task, not memory, and a lost task is just read again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ravelin.shipping import ship

Row = dict[str, Any]


class Machine:
    """State over the rows of one key: rows written for each row read, and at the end."""

    def push(self, row: Row) -> list[Row]:
        raise NotImplementedError

    def end(self) -> list[Row]:
        return []


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def ordered_scan(df: DataFrame, keys: list[str], order: list[str], machine: Callable[[], Machine], output: str, tasks: int | None = None) -> DataFrame:
    """Rows written by one ``machine`` per distinct ``keys``, fed in ``order``; ``output`` is their DDL.

    ``tasks`` fixes their number where the work, not the size of the rows, asks for it. Pages are such work: scans by page
    have as many tasks as the session has shuffle partitions, which adaptive execution does not put together.
    Null keys are a key of their own; an empty table gives no rows; ties in ``order`` come in any order.
    """
    ship(df.sparkSession)
    schema = _arrow(df.sparkSession, output)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, None
        for batch in batches:
            out: list[Row] = []
            for row in batch.to_pylist():
                here = tuple(row[k] for k in keys)
                if now is None or here != at:
                    out += now.end() if now else []
                    now, at = machine(), here
                out += now.push(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if now and (out := now.end()):
            yield pa.RecordBatch.from_pylist(out, schema)

    tasks = tasks or (page_tasks(df) if "page_num" in keys else None)
    dealt = df.repartition(tasks, *keys) if tasks else df.repartition(*keys)
    return dealt.sortWithinPartitions(*keys, *order).mapInArrow(run, output)


def page_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def row_map(df: DataFrame, each: Callable[[Row], list[Row]], output: str, dealt: bool = False) -> DataFrame:
    """Rows that ``each`` makes of every row, one Arrow batch at a time; rows that are much work are ``dealt`` out evenly first."""
    ship(df.sparkSession)
    df = df.repartition(page_tasks(df)) if dealt else df
    schema = _arrow(df.sparkSession, output)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if out := [made for row in batch.to_pylist() for made in each(row)]:
                yield pa.RecordBatch.from_pylist(out, schema)

    return df.mapInArrow(run, output)
