"""Corrections along one document in parallel: its rows are dealt out in ranges, and ranges meet as functions of the state.

Every range of a document's rows is read twice, by its own task. First, without the state before it, it becomes a function:
for rising times a constant up to a bound, for tapes a step along both numbers with the states named that a label catches.
One pass over these functions, a few values for each range, gives the state that each begins with; then the ranges are read
again, with it. The results are those of the scans in ``folds``, which read a document in one task.
"""

from __future__ import annotations

from array import array

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ravelin.functions.timecodes import canonical_seconds, formatted
from ravelin.operators.folds import Rising, Tapes, read_tape, repaired, tape_step
from ravelin.operators.scans import Machine, Row, ordered_scan, type_of
from ravelin.sources.stored import written


def in_ranges(rows: DataFrame, order: list[str], label: str, ranges: int | None = None) -> DataFrame:
    """``rows`` with ``range``: consecutive numbers of ranges of (document, ``order``), of about as many rows each.

    A document with a large part of all rows lies in as large a part of the ranges.
    """
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(rows.repartitionByRange(n, "document", *order).withColumn("range", F.spark_partition_id()), label)


# Rising times


def bound_of(times: array | list[int]) -> int:
    """The latest time from before with which the times of these rows still end as they do without any.

    ``repaired`` never falls as the time before rises, so those times are all up to a bound; where one is not after what was
    reached before, the rows behind it are the same for all.
    """
    bound = times[-1] - 1
    for now in reversed(times[:-1]):
        low, high = now, bound - 1  # times from now on stay below the bound of the rows behind if what they become does
        while low <= high:
            if repaired(now, high) <= bound:
                break
            middle = (low + high) // 2
            low, high = (middle + 1, high - 1) if repaired(now, middle) <= bound else (low, middle - 1)
        bound = max(now - 1, high) if low <= high else max(now - 1, low - 1)
    return bound


class RisingFunction(Machine):
    """The last time of a range without a time before, and the bound up to which any gives the same."""

    def __init__(self) -> None:
        self.key, self.times = None, array("q")

    def push(self, row: Row) -> list[Row]:
        self.key = self.key or {k: row[k] for k in ("document", "range")}
        self.times.append(row["at"])
        return []

    def end(self) -> list[Row]:
        last = self.times[0]
        for now in self.times[1:]:
            last = repaired(now, last)
        return [{**self.key, "last": last, "bound": bound_of(self.times)}]


class RisingStarts(Machine):
    """The time that each range begins with, as far as it is known; ``out`` is what a range past its bound was read to give."""

    def __init__(self) -> None:
        self.last, self.known = None, True

    def push(self, row: Row) -> list[Row]:
        done = {"document": row["document"], "range": row["range"], "start": self.last if self.known else None, "state": "open"}
        if self.known:
            if self.last is None or self.last <= row["bound"]:
                self.last, done["state"] = row["last"], "done"
            elif row["out"] is not None:
                self.last, done["state"] = row["out"], "done"
            else:
                self.known, done["state"] = False, "asked"
        return [done]


class RisingFrom(Machine):
    """``Rising``, from a time before that comes in a row of its own."""

    def __init__(self, only_last: bool) -> None:
        self.rising, self.only_last, self.row = Rising(), only_last, None

    def push(self, row: Row) -> list[Row]:
        if row["page_num"] is None:
            self.rising.last = row["at"]
            return []
        self.row = row
        done = self.rising.push(row)
        return [] if self.only_last else done

    def end(self) -> list[Row]:
        return [{**self.row, "fixed": self.rising.last}] if self.only_last and self.row else []


def monotonic(blocks: DataFrame, timestamp: str = "timestamp_clean", ranges: int | None = None) -> DataFrame:
    """``folds.monotonic``, with the rows of a document in several tasks.

    A range that begins later than its bound, as behind a time misread as far too late, is read once more from there before
    those behind it: such ranges follow one another, a round for each.
    """
    comm = blocks.where(F.col("type") == "comm").select("document", *(F.col(c).cast("long").alias(c) for c in ("page_num", "block_idx")), canonical_seconds(F.col(timestamp)).cast("bigint").alias("at")).where("at is not null")
    held = in_ranges(comm, ["page_num", "block_idx"], "times", ranges)
    kind = type_of(held, "document")
    key, order = ["document", "range"], ["page_num", "block_idx"]
    functions = written(ordered_scan(held, key, order, RisingFunction, f"document {kind}, range int, last long, bound long"), "time-functions")
    outs = functions.select(*key, F.lit(None).cast("long").alias("out")).limit(0)
    output = f"document {kind}, range int, page_num long, block_idx long, at long, fixed long"

    def read(rows: DataFrame, starts: DataFrame, only_last: bool) -> DataFrame:
        begin = starts.where("start IS NOT NULL").select(*key, F.lit(None).cast("long").alias("page_num"), F.lit(None).cast("long").alias("block_idx"), F.col("start").alias("at"))
        return ordered_scan(rows.select(*key, *order, "at").unionByName(begin), key, order, lambda: RisingFrom(only_last), output)

    while True:
        starts = written(ordered_scan(functions.join(outs, key, "left"), ["document"], ["range"], RisingStarts, f"document {kind}, range int, start long, state string"), "time-starts")
        asked = starts.where("state = 'asked'")
        if asked.isEmpty():
            break
        found = read(held.join(asked.select(*key), key, "left_semi"), asked, True)
        outs = written(outs.unionByName(found.select(*key, F.col("fixed").alias("out"))), "time-outs")
    done = read(held, starts, False)
    return done.select("document", *order, formatted(F.col("at")).alias("timestamp"), formatted(F.col("fixed")).alias("fixed"), (F.col("at") != F.col("fixed")).alias("corrected"))


# Tapes


class TapeFunction:
    """What a run of pages makes of any (tape, page in it) before it.

    Most states take the same steps: a page further, or a new tape. Where a label is trusted that says something else,
    the states that it catches go on from there. Kept are, by where they are now, the states before the run that were caught:
    points, or whole tapes once an end of tape has made all pages in it alike. Places are kept less the steps
    that all take, so a step without a catch moves nothing.
    """

    def __init__(self) -> None:
        self.x = self.y = 0  # steps that all took
        self.level: int | None = None  # the page in the tape, less ``y``, of all that a tape's end made alike
        self.points: set[tuple[int, int]] = set()
        self.tapes: set[int] = set()
        self.level_at: dict[int, list] = {}
        self.moved: dict[tuple[int, int], list] = {}

    def caught(self, x: int, y: int) -> list:
        """The states before the run that are at (x, y) now; they leave it."""
        at = (x - self.x, y - self.y)
        found = self.moved.pop(at, [])
        if self.level is None:
            if at not in self.points:
                self.points.add(at)
                found = found + [at]
        elif at[1] == self.level:
            found = found + self.level_at.pop(at[0], [])
            if at[0] not in self.tapes:
                self.tapes.add(at[0])
                found.append((at[0], None))
        return found

    def step(self, after_end: bool, label: str | None) -> None:
        if after_end:
            for (x, _), states in self.moved.items():
                self.level_at.setdefault(x, []).extend(states)
            self.moved, self.x, self.level = {}, self.x + 1, 1 - self.y
        else:
            self.y += 1
        if not label or (read := read_tape(label)) is None:
            return
        arrived = []
        for x in range(read[0] - 3, read[0] + 3):
            before = (x - 1, 0) if after_end else (x, read[1] - 1)
            to = (x, 1) if after_end else (x, read[1])  # where all others go from there
            if to != read and tape_step(*before, after_end, label)[:2] == read:
                arrived += self.caught(*to)
        if arrived:
            self.moved.setdefault((read[0] - self.x, read[1] - self.y), []).extend(arrived)

    def rows(self) -> list[Row]:
        """One row for each caught state, points first, and one for all others, whose ``to_y`` is added if ``adds``."""
        out = [{"x": x, "y": y, "to_x": at[0] + self.x, "to_y": at[1] + self.y} for at, states in self.moved.items() for x, y in states]
        out += [{"x": x, "y": y, "to_x": at + self.x, "to_y": self.level + self.y} for at, states in self.level_at.items() for x, y in states]
        rest = {"x": None, "y": None, "to_x": self.x, "to_y": self.y if self.level is None else self.level + self.y, "adds": self.level is None}
        return [{**r, "adds": False} for r in out] + [rest]


class TapeRange(Machine):
    def __init__(self) -> None:
        self.function, self.key, self.ended, self.started = TapeFunction(), None, False, False

    def push(self, row: Row) -> list[Row]:
        if self.key is None:
            self.key, self.ended, self.started = {k: row[k] for k in ("document", "range")}, row["ended"], row["started"]
        self.started = self.started or row["page"] >= 1
        if self.started:
            self.function.step(self.ended, row["ocr_tape"])
        self.ended = bool(row["end_of_tape"])
        return []

    def end(self) -> list[Row]:
        return [{**self.key, **r} for r in self.function.rows()]


class TapeStarts(Machine):
    """The state that each range begins with; a range's rows come points first, then tapes, then the rest."""

    def __init__(self) -> None:
        self.range, self.state, self.next = None, (1, 1), None

    def push(self, row: Row) -> list[Row]:
        done = []
        if row["range"] != self.range:
            self.state = self.next if self.next is not None else self.state
            self.range, self.next = row["range"], None
            done = [{"document": row["document"], "range": row["range"], "x": self.state[0], "y": self.state[1]}]
        if self.next is None:
            x, y = self.state
            if row["x"] is None:
                self.next = (x + row["to_x"], row["to_y"] + (y if row["adds"] else 0))
            elif row["x"] == x and row["y"] in (None, y):
                self.next = (row["to_x"], row["to_y"])
        return done


class TapesFrom(Machine):
    """``Tapes``, from a state that each row brings."""

    def __init__(self) -> None:
        self.tapes = None

    def push(self, row: Row) -> list[Row]:
        if self.tapes is None:
            self.tapes = Tapes()
            self.tapes.x, self.tapes.y, self.tapes.ended, self.tapes.started = row["x"], row["y"], row["ended"], row["started"]
        return self.tapes.push(row)


def tapes(pages: DataFrame, ranges: int | None = None) -> DataFrame:
    """``folds.tapes``, with the pages of a document in several tasks."""
    page = F.col("page") if "page" in pages.columns else F.col("page_num")
    rows = pages.select("document", F.col("page_num").cast("long").alias("page_num"), page.cast("long").alias("page"), "ocr_tape", F.coalesce("end_of_tape", F.lit(False)).alias("end_of_tape"))
    held = in_ranges(rows, ["page_num"], "pages", ranges)
    kind, key = type_of(held, "document"), ["document", "range"]
    # What a range has to know of those before but for the state: a row for each range.
    flags = held.groupBy(*key).agg(F.max_by("end_of_tape", "page_num").alias("ends"), F.max(F.col("page") >= 1).alias("starts"))
    before = Window.partitionBy("document").orderBy("range")
    flags = flags.select(*key, F.coalesce(F.lag("ends").over(before), F.lit(False)).alias("ended"), F.coalesce(F.max("starts").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)).alias("started"))
    flagged = held.join(flags, key)
    functions = ordered_scan(flagged, key, ["page_num"], TapeRange, f"document {kind}, range int, x int, y int, to_x int, to_y int, adds boolean")
    kinds = functions.withColumn("kind", F.when(F.col("x").isNull(), 2).when(F.col("y").isNull(), 1).otherwise(0))
    starts = ordered_scan(kinds, ["document"], ["range", "kind"], TapeStarts, f"document {kind}, range int, x int, y int")
    return ordered_scan(flagged.join(starts, key), key, ["page_num"], TapesFrom, f"document {kind}, page_num long, ocr_tape string, tape string, corrected boolean")
