"""Whole documents for export: blocks cleaned in the light of those before, also across pages, and three renderings.

Two ordered scans by document. The first may still add to the last named block, so it holds that one and the
newest, and writes all others; the second takes stations out, drops repeated annotations, makes times rise and
joins neighbours of one time and speaker.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ravelin.functions import lines, stations
from ravelin.operators.building import FIELDS
from ravelin.operators.folds import repaired
from ravelin.operators.scans import Machine, Row, ordered_scan, type_of

#: Who counts as crew here; events that end what is said; what the ground says first.
CREW = ("CDR", "CMP", "LMP", "SC", "MS", "SWIM 1", "HORNET", "PAO", "PRESIDENT NIXON")
EVENTS = ("BEGIN LUNAR REV", "END LUNAR REV", "REST PERIOD - NO COMMUNICATIONS")
ROGER, GO_AHEAD, ASIDE = re.compile(r"(ROGER|Roger)\b"), re.compile(r"(Go ahead|GO AHEAD)\b"), re.compile(r"\([^\W\d_]")
_tape_end = re.compile(lines.END_OF_TAPE)
_foot = [re.compile(p) for p in lines.FOOTER_REST]
OUT = [*(c for c in FIELDS if c != "hint"), "continuation_from_prev"]
DDL = ", ".join([*(f"{c} string" for c in OUT[:-1]), "continuation_from_prev boolean"])


def split_event(text: str) -> tuple[str, str | None]:
    """What stands before the first kind of event in a text, and the event with the rest; null without one."""
    at = next((m.start() for e in EVENTS if (m := re.search(e, text, re.IGNORECASE))), None)
    return (text, None) if at is None else (text[:at].rstrip(" -\t"), text[at:].strip())


def event_before(c: Column) -> Column:
    """``split_event``'s first part as a column expression."""
    return F.when(event_of(c).isNull(), c).otherwise(F.regexp_replace(F.substring(c, F.lit(1), _event_at(c) - 1), r"[ \t-]+$", ""))


def event_of(c: Column) -> Column:
    """``split_event``'s second part as a column expression."""
    return F.when(_event_at(c) > 0, F.trim(F.substring(c, _event_at(c), F.length(c))))


def _event_at(c: Column) -> Column:
    places = [F.regexp_instr(c, F.lit(f"(?i){e}")) for e in EVENTS]
    return F.coalesce(*(F.when(p > 0, p) for p in places), F.lit(0))


def is_event(c: Column) -> Column:
    """Whether a text begins with a lunar revolution, or tells a rest period."""
    upper = F.upper(c)
    return upper.startswith(EVENTS[0]) | upper.startswith(EVENTS[1]) | upper.contains(EVENTS[2])


def without_footer_rest(text: str) -> str:
    for pattern in _foot:
        text = pattern.sub("", text)
    return text.strip()


def goes_on(text: str) -> bool:
    return text[0].islower() or text.startswith("...")


class Spoken(Machine):
    """Cleans the blocks of a document in order; ``before`` is the last named comm block, ``crew`` who of the crew spoke last."""

    def __init__(self, replacements: dict[str, str], speakers: list[str]) -> None:
        self.replacements, self.speakers = replacements, speakers
        self.page = self.before = self.crew = self.newest = None
        self.open: list[Row] = []

    def settled(self) -> list[Row]:
        """Rows that nothing can be added to any more."""
        done = [r for r in self.open if r is not self.before and r is not self.newest]
        self.open = [r for r in self.open if r is self.before or r is self.newest]
        return done

    def add(self, row: Row) -> None:
        self.open.append(row)
        self.newest = row

    def due(self, text: str) -> str | None:
        """Who says a nameless text, by what it begins with and who spoke before."""
        last = self.before["speaker"] if self.before else None
        if ROGER.match(text):
            if last in CREW:
                return "CC"
            if last == "CC" and self.crew:
                return self.crew
            return "CC" if "11" in text or "APOLLO" in text.upper() else None
        if GO_AHEAD.match(text):
            return "CC"
        return self.crew if last == "CC" and ASIDE.match(text) else None

    def replaced(self, text: str) -> str:
        for old, new in self.replacements.items():
            text = text.replace(old, new)
        return text

    def comm(self, row: Row) -> None:
        text = _tape_end.sub("", self.replaced((row["text"] or "").strip())).strip()
        speaker = row["speaker"]
        name = next((s for s in self.speakers if text.startswith((s + " ", s + ":"))), None)
        if name and (not speaker or speaker == name):
            speaker, text = name, text[len(name) + 1 :].strip()
        text, event = split_event(text)
        if event:
            kind = "rest_period" if EVENTS[2] in event.upper() else "lunar_rev"
            self.add({**row, **dict.fromkeys(OUT), "type": "meta", "text": event, "meta_type": kind, "part": 0})
        if not text:
            return
        nameless = not (speaker or "").strip()
        target = self.newest if self.newest and self.newest["type"] == "comm" else self.before
        if nameless and goes_on(text) and target:
            target["text"] = f"{target['text'] or ''} {text}".strip()
            return
        if nameless:
            speaker = self.due(text) or speaker
            if self.before and self.before["speaker"] == "CC" and text[0].isdigit():
                self.before["text"] = f"{self.before['text'] or ''} {text}".strip()
                return
        self.add({**row, "text": text, "speaker": speaker})
        if (speaker or "").strip():
            self.before = self.newest
            self.crew = speaker if speaker in CREW else self.crew

    def push(self, row: Row) -> list[Row]:
        if row["page_num"] != self.page:
            self.page, self.newest = row["page_num"], None
        row = {**row, "part": 1}
        text = row["text"] or ""
        if row["type"] == "comm":
            self.comm(row)
        elif row["type"] == "footer":
            if rest := without_footer_rest(text):
                self.add({**row, **dict.fromkeys(OUT), "type": "footer", "text": rest})
        elif row["type"] == "annotation":
            self.add({**row, **dict.fromkeys(OUT), "type": "annotation", "text": text} if text else row)
        elif row["type"] == "continuation":
            if text.strip():
                self.add({**row, "text": self.replaced(text.strip())})
        else:
            self.add(row)
        return self.settled()

    def end(self) -> list[Row]:
        return self.open


def comparable(text: str) -> str:
    return " ".join(re.sub("[^a-z0-9 ]+", " ", text.lower()).split())


def seconds_of(timestamp: str | None) -> int | None:
    parts = (timestamp or "").split()
    if len(parts) != 4 or not all(p.lstrip("+-").isdigit() for p in parts):
        return None
    d, h, m, s = map(int, parts)
    return ((d * 24 + h) * 60 + m) * 60 + s


def written(seconds: int) -> str:
    return f"{seconds // 86400:02} {seconds // 3600 % 24:02} {seconds // 60 % 60:02} {seconds % 60:02}"


class Finished(Machine):
    """Stations out of comm texts, no annotation twice in a row, rising times, one block per time and speaker."""

    def __init__(self, keywords: list[str]) -> None:
        self.keywords, self.page, self.said, self.last, self.newest, self.count = keywords, None, None, None, None, 0

    def parts(self, row: Row) -> list[Row]:
        if row["type"] != "comm" or not row["text"] or not self.keywords:
            return [row]
        text, found = stations.without_stations(row["text"], self.keywords)
        if not found:
            return [row]
        marks = [{**row, **dict.fromkeys(OUT), "type": "annotation", "text": t} for t in found]
        return [{**row, "text": text}, *marks] if text else marks

    def next(self, row: Row | None) -> list[Row]:
        done, self.newest = ([self.newest] if self.newest else []), row
        if row:
            row["block_idx"], self.count = self.count, self.count + 1
        return done

    def push(self, row: Row) -> list[Row]:
        out: list[Row] = []
        if row["page_num"] != self.page:
            out, self.page, self.said, self.count = self.next(None), row["page_num"], None, 0
        for b in self.parts(row):
            said = comparable(b["text"]) if b["type"] == "annotation" and b["text"] else None
            if said is not None and said == self.said:
                continue
            self.said = said
            if b["type"] == "comm" and (now := seconds_of(b["timestamp"])) is not None:
                fixed = now if self.last is None else repaired(now, self.last)
                b = {**b, "timestamp": b["timestamp"] if fixed == now else written(fixed)}
                self.last = fixed
            a = self.newest
            if a and a["type"] == b["type"] == "comm" and b["timestamp"] and b["timestamp"] == a["timestamp"] and b["speaker"] and b["speaker"] == a["speaker"]:
                a["text"] = f"{(a['text'] or '').strip()} {(b['text'] or '').strip()}".strip() if (b["text"] or "").strip() else a["text"]
                a["location"] = a["location"] or b["location"]
            else:
                out += self.next(b)
        return out

    def end(self) -> list[Row]:
        return self.next(None)


def displayed(pages: DataFrame) -> DataFrame:
    """Pages whose number in the document, which the header has and which may be less than that of the file, is 1 or more."""
    return pages.where(F.coalesce("header.page", F.lit(0)) > 0)


def exported(blocks: DataFrame, replacements: dict[str, str] | None = None, speakers: Iterable[str] = (), keywords: Iterable[str] = ()) -> DataFrame:
    """(document, page_num, block_idx, ...) of the blocks of whole documents, of which ``displayed`` has chosen the pages; files are counted from 1.

    ``replacements`` are literal; ``speakers`` are names that a text may begin with; ``keywords`` are stations.
    """
    literal, names, known = dict(replacements or {}), list(speakers), list(keywords)
    absent = {c: F.lit(None).cast("boolean" if c == "continuation_from_prev" else "string") for c in OUT if c not in blocks.columns}
    rows = blocks.withColumns(absent).where("page_num > 0").select("document", *(F.col(c).cast("long").alias(c) for c in ("page_num", "block_idx")), *OUT)
    key = f"document {type_of(rows, 'document')}, page_num long, block_idx long"
    spoken = ordered_scan(rows, ["document"], ["page_num", "block_idx"], lambda: Spoken(literal, names), f"{key}, {DDL}, part int")
    return ordered_scan(spoken, ["document"], ["page_num", "block_idx", "part"], lambda: Finished(known), f"{key}, {DDL}")


def block_json(names: Iterable[str]) -> Column:
    """A block as JSON: its members in the order of its kind, blank ones absent, what only serves the reading left out."""
    has = [c for c in OUT if c in set(names) and c != "timestamp_correction"]
    kept = lambda order: F.to_json(F.struct(*(F.col(c) for c in order if c in has)))
    rest = ["continuation_from_prev"]
    comm = kept(["type", "timestamp", "speaker", "location", "text", "meta_type", *rest])
    meta = kept(["type", "meta_type", "timestamp", "text", "speaker", "location", *rest])
    other = kept(["type", "text", "timestamp", "speaker", "location", "meta_type", *rest])
    return F.when(F.col("type") == "comm", comm).when(F.col("type") == "meta", meta).otherwise(other)


def merged_json(blocks: DataFrame, headers: DataFrame) -> DataFrame:
    """(document, page_count, merged): one JSON text per document of its pages in order.

    ``headers`` are (document, page_num, header) and, where the source is known, source; pages without blocks are
    in it too, those that are not ``displayed`` are not. The text of one document is one value by nature.
    """
    member = lambda name, value: F.regexp_extract(F.to_json(F.struct(value.alias(name))), r"(?s)^\{(.*)\}$", 1)
    held = F.transform(F.sort_array(F.collect_list(F.struct("block_idx", block_json(blocks.columns).alias("j")))), lambda x: x["j"])
    paged = blocks.groupBy("document", "page_num").agg(F.array_join(held, ",").alias("blocks"))
    parts = [member("header", F.col("header")), F.concat(F.lit('"blocks":['), F.coalesce("blocks", F.lit("")), F.lit("]"))]
    if "source" in headers.columns:
        parts.append(member("source", F.col("source")))
    page = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    pages = displayed(headers).join(paged, ["document", "page_num"], "left").select("document", F.struct("page_num", page.alias("j")).alias("p"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["j"]), ",")
    grouped = pages.groupBy("document").agg(F.count("*").alias("page_count"), joined.alias("pages"))
    whole = F.concat(F.lit("{"), F.concat_ws(",", member("document", F.col("document")), member("page_count", F.col("page_count")), F.concat(F.lit('"pages":['), F.col("pages"), F.lit("]"))), F.lit("}"))
    return grouped.select("document", "page_count", whole.alias("merged"))
