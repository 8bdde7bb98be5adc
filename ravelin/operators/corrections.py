"""Corrections whose result depends on the rows before: mission time, and who speaks."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.functions.similarity import SpeakerBook
from ravelin.functions.timecodes import formatted, parsed_seconds
from ravelin.operators.scans import Machine, Row, ordered_scan, type_of

DAY, HOUR, MINUTE = 86_400, 3600, 60
#: Rows looked at for a new sequence, and the rising times in them that make one.
AHEAD, RUN = 6, 3
#: Seconds back that are late rather than wrong, that are a new sequence, a jump, and a snap's reach.
LATE, RESET, JUMP, REACH = 300, 3600, 43_200, 600
#: The type of a row that stands for the times of a page that is not read.
LISTED = "listed"
#: Speakers who answer the ground.
CREW = ("CDR", "CMP", "LMP")


def snapped(now: int, last: int) -> int | None:
    """The nearest time at most ``REACH`` after ``last``, same day, with its hour or one beside it."""
    if now // DAY != last // DAY:
        return None
    hour = last % DAY // HOUR
    tries = (now // DAY * DAY + h * HOUR + now % HOUR for h in (hour - 1, hour, hour + 1) if 0 <= h <= 23)
    return min((t for t in tries if 0 < t - last <= REACH), default=None)


def suffixed(now: int, hint: str | None, last: int) -> int | None:
    """A time read without seconds, with the tens of ``last`` and the digit that stood behind it."""
    if not hint or not hint.isdigit() or now % MINUTE or now // MINUTE != last // MINUTE:
        return None
    second = last % MINUTE // 10 * 10 + int(hint)
    tried = now + second
    return tried if second <= 59 and 0 < tried - last <= 20 else None


class Clock(Machine):
    """Mission time of the comm blocks of one document, in page order; a page's rows are held until it ends.

    ``last`` is the cursor; a page begins with the time listed last before it. Each correction says its
    kind, whether the cursor follows, and whether the page counts as begun. A row of type ``listed`` stands for a page
    that is not read again: its time is the last one listed there.
    """

    def __init__(self) -> None:
        self.last = self.listed = None
        self.begun = False
        self.rows: list[Row] = []

    def corrected(self, now: int | None, hint: str | None, stable: bool) -> tuple[int | None, str | None]:
        last = self.last
        if now is None:
            if last is None:
                return None, None
            self.last, self.begun = last + 1, True
            return last + 1, "inferred_missing"
        if last is None:
            self.last, self.begun = now, True
            return now, None
        kind = None
        if (told := suffixed(now, hint, last)) is not None:
            now, kind = told, "inferred_suffix"
        ahead = now - last
        if ahead < -RESET and (not self.begun or stable):
            self.last, self.begun = now, True
            return now, "sequence_reset"
        if (ahead > RESET or ahead < -LATE) and not self._tens(now, last) and (near := snapped(now, last)) is not None:
            self.last = near
            return near, "corrected_hour"
        if ahead <= 0 and self._tens(now, last):
            self.last = now + 40
            return now + 40, "inferred_tens"
        self.begun = True
        if ahead < -LATE:
            now, kind = last + 1, "inferred_monotonic"
        elif ahead <= 0:
            return now, "out_of_order"
        elif ahead > JUMP and now // DAY == last // DAY:
            now, kind = last + 1, "corrected_jump"
        self.last = now
        return now, kind

    @staticmethod
    def _tens(now: int, last: int) -> bool:
        """Both in the first 20 seconds of one minute, so that a 5 or 6 may have been lost."""
        return now // MINUTE == last // MINUTE and now <= last and max(now, last) % MINUTE < 20 and now % MINUTE + 40 <= 59 and 0 < now + 40 - last <= 60

    def push(self, row: Row) -> list[Row]:
        done = self.end() if self.rows and row["page_num"] != self.rows[0]["page_num"] else []
        self.rows.append(row)
        return done

    def end(self) -> list[Row]:
        """The rows of the page that is held, comm blocks with ``fixed`` seconds and ``correction``."""
        rows, self.rows = self.rows, []
        self.last, self.begun = self.listed, False
        if rows and rows[0]["type"] == LISTED:
            self.listed = rows[0]["at"]
            return []
        times = [r["at"] if r["type"] == "comm" else None for r in rows]
        for i, row in enumerate(rows):
            row["fixed"] = row["correction"] = None
            if row["type"] == "comm":
                row["fixed"], row["correction"] = self.corrected(row["at"], row["hint"], rises(times[i : i + AHEAD]))
                self.listed = row["fixed"] if row["fixed"] is not None else self.listed
        return rows


def rises(times: list[int | None]) -> bool:
    """Whether the first ``RUN`` times there are rise, by ``REACH`` seconds at most."""
    run = [t for t in times if t is not None][:RUN]
    return len(run) == RUN and all(0 < b - a <= REACH for a, b in pairwise(run))


def timed_blocks(blocks: DataFrame, timestamp: str = "timestamp", hint: str | None = None, listed: DataFrame | None = None) -> DataFrame:
    """All ``blocks`` with ``at`` and ``fixed``, the seconds read and corrected of comm blocks, and ``correction``.

    The next rows of a page that tell a new sequence are counted over blocks of all kinds. ``listed`` has the times of pages
    that may not be among the blocks, as a timestamp index does: (document, page_num, timestamps), null or empty where a page
    has none. The last time of such a page is what the pages behind it begin with.
    """
    rows = blocks.withColumns({"page_num": F.col("page_num").cast("long"), "block_idx": F.col("block_idx").cast("long"), "at": parsed_seconds(F.col(timestamp)), "hint": F.col(hint) if hint else F.lit(None).cast("string")})
    output = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    if listed is not None:
        last = listed.where(F.size("timestamps") > 0).select(F.col("document").cast(rows.schema["document"].dataType), F.col("page_num").cast("long"), parsed_seconds(F.element_at("timestamps", -1)).alias("at")).where("at IS NOT NULL")
        absent = last.join(rows.select("document", "page_num").distinct(), ["document", "page_num"], "left_anti")
        rows = rows.unionByName(absent.withColumns({"type": F.lit(LISTED), "block_idx": F.lit(-1).cast("long")}), allowMissingColumns=True)
    return ordered_scan(rows, ["document"], ["page_num", "block_idx"], Clock, f"{output}, fixed long, correction string")


def corrected_times(blocks: DataFrame, timestamp: str = "timestamp", hint: str | None = None, listed: DataFrame | None = None) -> DataFrame:
    """(document, page_num, block_idx, timestamp, fixed, correction) of the comm blocks.

    Null, blank and unreadable timestamps are inferred from the time before; without one they stay null.
    """
    kept = blocks.select("document", "page_num", "block_idx", "type", timestamp, *([hint] if hint else []))
    text = lambda c: F.when(F.col(c).isNotNull(), formatted(F.col(c)))
    return timed_blocks(kept, timestamp, hint, listed).where(F.col("type") == "comm").select("document", "page_num", "block_idx", text("at").alias("timestamp"), text("fixed").alias("fixed"), "correction")


def without_name(text: str, name: str) -> str:
    """The text without the speaker's name in front, where a delimiter follows or nothing."""
    rest = text[len(name) :]
    if not name or not text.upper().startswith(name.upper()) or (rest and rest[0] not in " .:"):
        return text
    return rest.lstrip(" .:")


class Voices(Machine):
    """Who speaks on one page: corrected names, else a name in the text, else whose turn it is."""

    def __init__(self, book: SpeakerBook) -> None:
        self.book, self.before, self.crew = book, None, None

    def turn(self) -> str | None:
        """Who is due; an acknowledgement or a question after the crew is due to the ground as well."""
        if self.before == "CC":
            return self.crew
        return "CC" if self.before in CREW else None

    def told(self, speaker: str | None, text: str | None) -> Row:
        """The speaker, blank if unknown, and the text without that name in front."""
        name, text = (speaker or "").strip(), (text or "").strip()
        if not name or self.book.is_garbage(name):
            found = self.book.in_text(text) or self.turn() or ""
        else:
            found = self.book.correct(name)
        if found:
            self.before = found
            self.crew = found if found in CREW else self.crew
        return {"speaker": found, "text": without_name(text, found)}

    def push(self, row: Row) -> list[Row]:
        return [{**{k: row[k] for k in ("document", "page_num", "block_idx")}, **self.told(row["speaker"], row["text"])}]


def corrected_speakers(blocks: DataFrame, keywords: Iterable[str] = (), valid: list[str] | None = None, fixes: dict[str, str] | None = None) -> DataFrame:
    """(document, page_num, block_idx, speaker, text) of the comm blocks; unknown speakers are blank."""
    book = SpeakerBook(valid, fixes, tuple(keywords))
    comm = blocks.where(F.col("type") == "comm").select("document", *(F.col(c).cast("long") for c in ("page_num", "block_idx")), "speaker", "text")
    return ordered_scan(comm, ["document", "page_num"], ["block_idx"], lambda: Voices(book), f"document {type_of(comm, 'document')}, page_num long, block_idx long, speaker string, text string")
