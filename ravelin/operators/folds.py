"""Order-dependent corrections over a document's rows, as ordered scans: state of a few numbers, one pass."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.functions.timecodes import DAY, canonical_seconds, formatted
from ravelin.operators.scans import Machine, Row, ordered_scan, type_of


def repaired(now: int, last: int) -> int:
    """A time that is not after ``last``: its day, then hour, then minute are raised to it, else one second more."""
    if now > last:
        return now
    day, hour, minute, second = now // DAY, now % DAY // 3600, now % 3600 // 60, now % 60
    day = max(day, last // DAY)
    if day == last // DAY:
        hour = max(hour, last % DAY // 3600)
        if hour == last % DAY // 3600:
            minute = max(minute, last % 3600 // 60)
    tried = day * DAY + hour * 3600 + minute * 60 + second
    return tried if tried > last else last + 1


class Rising(Machine):
    def __init__(self) -> None:
        self.last: int | None = None

    def push(self, row: Row) -> list[Row]:
        self.last = row["at"] if self.last is None else repaired(row["at"], self.last)
        return [{**row, "fixed": self.last}]


def monotonic(blocks: DataFrame, timestamp: str = "timestamp_clean") -> DataFrame:
    """Strictly increasing times of the comm blocks of each document: the original and fixed timestamp.

    Blocks without a parseable timestamp are passed by.
    """
    comm = blocks.where(F.col("type") == "comm").select("document", *(F.col(c).cast("long").alias(c) for c in ("page_num", "block_idx")), canonical_seconds(F.col(timestamp)).cast("bigint").alias("at")).where("at is not null")
    out = ordered_scan(comm, ["document"], ["page_num", "block_idx"], Rising, f"document {type_of(comm, 'document')}, page_num long, block_idx long, at long, fixed long")
    return out.select("document", "page_num", "block_idx", formatted(F.col("at")).alias("timestamp"), formatted(F.col("fixed")).alias("fixed"), (F.col("at") != F.col("fixed")).alias("corrected"))


def read_tape(label: str | None) -> tuple[int, int] | None:
    m = re.fullmatch(r"(\d+)/(\d+)", label or "")
    return (int(m[1]), int(m[2])) if m else None


def one_digit_off(a: int, b: int) -> bool:
    """Whether ``a`` is part of ``b`` as written, or differs from it in one of as many digits."""
    x, y = str(a), str(b)
    return x in y or (len(x) == len(y) and sum(p != q for p, q in zip(x, y, strict=True)) == 1)


def tape_step(x: int, y: int, after_end: bool, label: str | None) -> tuple[int, int, bool]:
    """The next tape and page in it from what was read and what is expected; whether it was corrected."""
    ex, ey = (x + 1, 1) if after_end else (x, y + 1)
    if not label:
        return ex, ey, False
    if (read := read_tape(label)) is None:
        return ex, ey, True
    ox, oy = read
    if after_end:
        trusted = read == (ex, ey) or (oy == 1 and abs(ox - ex) <= 1)
    elif oy == ey and (abs(ox - ex) <= 1 or one_digit_off(ox, ex)):
        trusted = abs(ox - ex) <= 1
    else:
        trusted = oy == ey == 1 and -1 <= ox - ex <= 2
    return (ox, oy, False) if trusted else (ex, ey, True)


class Tapes(Machine):
    """Labels from 1/1 on; pages whose number is below one have none."""

    def __init__(self) -> None:
        self.x, self.y, self.ended, self.started = 1, 1, False, False

    def push(self, row: Row) -> list[Row]:
        self.started = self.started or row["page"] >= 1
        done = {"document": row["document"], "page_num": row["page_num"], "ocr_tape": row["ocr_tape"], "tape": None, "corrected": False}
        if self.started:
            self.x, self.y, done["corrected"] = tape_step(self.x, self.y, self.ended, row["ocr_tape"])
            done["tape"] = f"{self.x}/{self.y}"
        self.ended = bool(row["end_of_tape"])
        return [done]


def tapes(pages: DataFrame) -> DataFrame:
    """Tape label of each page by dead reckoning from 1/1, checked against what was read.

    ``page``, where there is such a column, is the number that a page has in its document; labels begin at 1.
    """
    page = F.col("page") if "page" in pages.columns else F.col("page_num")
    rows = pages.select("document", F.col("page_num").cast("long").alias("page_num"), page.cast("long").alias("page"), "ocr_tape", "end_of_tape")
    return ordered_scan(rows, ["document"], ["page_num"], Tapes, f"document {type_of(rows, 'document')}, page_num long, ocr_tape string, tape string, corrected boolean")
