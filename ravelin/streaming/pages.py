"""Corrections that go along a document, as streams: mission time and tapes, equal to the scans over stored tables.

Both keep their state by document with ``transformWithState``, which needs the RocksDB state store
(``STATE_STORE`` in the session that starts the query). Time is that of the rows' ``arrived`` column, which the stream must
have a watermark on: a page (or a gap) is closed by a timer as soon as the watermark has passed its last row by ``patience``
seconds. What has a state is small: a cursor, and the rows of pages that are still open. A row without page_num only tells
the time. Rows that are older than the watermark are left out by Spark, as in any stream; its delay says how late rows may be.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ravelin.functions.timecodes import formatted, parsed_seconds
from ravelin.operators.corrections import Clock
from ravelin.operators.folds import Tapes
from ravelin.operators.scans import Row, type_of
from ravelin.shipping import ship

#: The setting that both streams need.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
#: What the correction of a row says whose page was closed before it came.
LATE = "late"

ROW = ["page_num", "block_idx", "type", "at", "hint"]
ROW_DDL = "page_num long, block_idx long, type string, at long, hint string"
PAGE = ["page_num", "page", "ocr_tape", "end_of_tape"]
PAGE_DDL = "page_num long, page long, ocr_tape string, end_of_tape boolean"


def plain(value):
    """A value as Python has it: pandas' missing ones are None, and whole numbers beside them are none of its floats."""
    value = value.item() if hasattr(value, "item") else value
    return None if pd.isna(value) else int(value) if isinstance(value, float) else value


def rows_of(frames: Iterator[pd.DataFrame], columns: list[str]) -> list[tuple]:
    return [tuple(map(plain, r)) for f in frames for r in f[columns].itertuples(index=False, name=None)]


class Timer:
    """One timer of a key: it is set anew with what came last."""

    def __init__(self, handle: StatefulProcessorHandle, patience: int) -> None:
        self.handle, self.patience = handle, 1000 * patience

    def at(self, arrived: int) -> None:
        for held in list(self.handle.listTimers()):
            self.handle.deleteTimer(held)
        self.handle.registerTimer(arrived + self.patience)


class ClockStream(StatefulProcessor):
    """The time listed last before the open page, and that page's rows; a later page's row or a timer closes it."""

    def __init__(self, patience: int) -> None:
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.timer = Timer(handle, self.patience)
        self.cursor = handle.getValueState("cursor", "listed long, page_num long, closed boolean")
        self.open = handle.getListState("open", ROW_DDL)

    def closed(self, listed: int | None, rows: list[tuple]) -> tuple[int | None, list[Row]]:
        """The rows of a page in order, corrected, and the time listed last after them."""
        clock = Clock()
        clock.last = clock.listed = listed
        for row in sorted(rows, key=lambda r: r[1]):
            clock.push(dict(zip(ROW, row, strict=True)))
        done = clock.end()
        return clock.listed, done

    def written(self, document, rows: list[Row]) -> pd.DataFrame:
        comm = [r for r in rows if r["type"] == "comm"]
        return pd.DataFrame({"document": [document] * len(comm), **{k: pd.Series([r[k] for r in comm], dtype=t) for k, t in (("page_num", "Int64"), ("block_idx", "Int64"), ("at", "Int64"), ("fixed", "Int64"), ("correction", "object"))}})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        frames = list(rows)
        new = sorted((r for r in rows_of(iter(frames), ROW) if r[0] is not None), key=lambda r: r[:2])
        listed, page, closed = self.cursor.get() if self.cursor.exists() else (None, None, True)
        held = list(self.open.get()) if page is not None and not closed and self.open.exists() else []
        grew, done = False, []
        for row in new:
            if page is not None and (row[0] < page or (row[0] == page and closed)):
                done.append({**dict(zip(ROW, row, strict=True)), "fixed": None, "correction": LATE})
                continue
            if page is not None and not closed and row[0] > page:
                listed, rows_ = self.closed(listed, held)
                done, held, grew = done + rows_, [], False
            page, closed = row[0], False
            held.append(row)
            grew = True
        if page is not None and not closed:
            if grew:
                self.open.put(held)
            self.timer.at(int(max(f["arrived"].max() for f in frames).timestamp() * 1000))
        self.cursor.update((listed, page, closed))
        if done:
            yield self.written(key[0], done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        listed, page, closed = self.cursor.get()
        if not closed:
            listed, done = self.closed(listed, list(self.open.get()))
            self.open.clear()
            self.cursor.update((listed, page, True))
            yield self.written(key[0], done)

    def close(self) -> None:
        pass


def corrected_times_stream(blocks: DataFrame, timestamp: str = "timestamp", hint: str | None = None, patience: int = 60) -> DataFrame:
    """``corrections.corrected_times`` of a stream of blocks (document, page_num, block_idx, type, ``timestamp``, ``arrived``).

    The blocks of a document come page by page; how they are cut into micro-batches, and their order within a page, does not
    matter. A row whose page was closed before it came keeps its time, unfixed, with the correction ``late``.
    """
    ship(blocks.sparkSession)
    kind = type_of(blocks, "document")
    rows = blocks.select("document", *(F.col(c).cast("long") for c in ("page_num", "block_idx")), "type", parsed_seconds(F.col(timestamp)).alias("at"), (F.col(hint) if hint else F.lit(None).cast("string")).alias("hint"), "arrived")
    done = rows.groupBy("document").transformWithStateInPandas(ClockStream(patience), f"document {kind}, page_num long, block_idx long, at long, fixed long, correction string", "Append", "EventTime")
    text = lambda c: F.when(F.col(c).isNotNull(), formatted(F.col(c)))
    return done.select("document", "page_num", "block_idx", text("at").alias("timestamp"), text("fixed").alias("fixed"), "correction")


class TapeStream(StatefulProcessor):
    """The tape reached so far, and the pages that came before their predecessor; they go on in page order."""

    def __init__(self, patience: int, first: int) -> None:
        self.patience, self.first = patience, first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.timer = Timer(handle, self.patience)
        self.reached = handle.getValueState("reached", "x int, y int, ended boolean, started boolean, next long")
        self.early = handle.getMapState("early", "page_num long", PAGE_DDL)

    def machine(self) -> tuple[Tapes, int]:
        tapes, due = Tapes(), self.first
        if self.reached.exists():
            tapes.x, tapes.y, tapes.ended, tapes.started, due = self.reached.get()
        return tapes, due

    def released(self, document, gap: bool) -> pd.DataFrame:
        """The pages that are due; over a ``gap`` those behind it, too."""
        tapes, due = self.machine()
        done: list[Row] = []
        held = sorted(k[0] for k in self.early.keys())  # noqa: SIM118
        for page_num in held:
            if page_num != due and not gap:
                break
            row = dict(zip(PAGE, self.early.getValue((page_num,)), strict=True))
            done += tapes.push({**row, "document": document})
            self.early.removeKey((page_num,))
            due = page_num + 1
        self.reached.update((tapes.x, tapes.y, tapes.ended, tapes.started, due))
        return self.written(document, done)

    def written(self, document, rows: list[Row]) -> pd.DataFrame:
        return pd.DataFrame({"document": [document] * len(rows), **{k: pd.Series([r[k] for r in rows], dtype=t) for k, t in (("page_num", "Int64"), ("ocr_tape", "object"), ("tape", "object"), ("corrected", "boolean"))}})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        frames = list(rows)
        _, due = self.machine()
        late = []
        for row in rows_of(iter(frames), PAGE):
            if row[0] is None:
                continue
            if row[0] < due:
                late.append({**dict(zip(PAGE, row, strict=True)), "tape": None, "corrected": None})
            elif not self.early.containsKey((row[0],)):
                self.early.updateValue((row[0],), row)
        done = self.released(key[0], gap=False)
        if any(True for _ in self.early.keys()):
            self.timer.at(int(max(f["arrived"].max() for f in frames).timestamp() * 1000))
        yield pd.concat([done, self.written(key[0], late)]) if late else done

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        yield self.released(key[0], gap=True)

    def close(self) -> None:
        pass


def end_of_tape(blocks: str = "blocks"):
    """Whether a page's blocks, an array with type and text, tell that its tape ends."""
    return F.coalesce(F.exists(blocks, lambda b: (b["type"] == "meta") & F.upper(b["text"]).contains("END OF TAPE")), F.lit(False))


def tapes_stream(pages: DataFrame, first: int = 1, patience: int = 60) -> DataFrame:
    """``folds.tapes`` of a stream of pages (document, page_num, ocr_tape, ``blocks`` or end_of_tape, ``arrived``) in any order.

    A document's pages are numbered one after another from ``first``. A page that comes before its predecessor waits for it,
    ``patience`` seconds after the last one came at most; then it goes on without. One that comes when a later page
    has gone on already, or below ``first``, has no tape and null for ``corrected``; a repeated one is the first of its number.
    """
    ship(pages.sparkSession)
    page = F.col("page") if "page" in pages.columns else F.col("page_num")
    ends = end_of_tape() if "blocks" in pages.columns else F.col("end_of_tape")
    rows = pages.select("document", F.col("page_num").cast("long").alias("page_num"), page.cast("long").alias("page"), "ocr_tape", ends.alias("end_of_tape"), "arrived")
    return rows.groupBy("document").transformWithStateInPandas(TapeStream(patience, first), f"document {type_of(rows, 'document')}, page_num long, ocr_tape string, tape string, corrected boolean", "Append", "EventTime")
